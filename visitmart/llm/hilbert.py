"""Hilbert keys of integer points, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (rows; coordinates from 0 to 2**bits - 1) on the Hilbert curve through the grid.

    The curve visits neighbouring cells one after another. Coordinates go through the published transform from
    axes to the transposed index, one bit plane after the other; dimensions times bits must not pass 63.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("the key would not fit into 63 bits")
    for plane in range(bits - 1, 0, -1):
        high = 1 << plane
        low = high - 1
        for k in range(dims):
            set_ = (x[k] & high) != 0
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(set_, low, swap)
            if k:
                x[k] ^= swap
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & (1 << plane)) != 0, (1 << plane) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for plane in range(bits - 1, -1, -1):
        for k in range(dims):
            key = (key << 1) | ((x[k] >> plane) & 1)
    return key
