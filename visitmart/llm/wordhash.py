"""Words of a whole Arrow batch of texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's
hash is a polynomial over random 64-bit values of its bytes, taken from running sums,
so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_ROOT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_ROOT, -1, 1 << 64)
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
VALUE = mix((_LOWER + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
#: The hash of the end of a text, where a model counts it as a token.
END = int(mix(np.array([0x656E64], dtype=np.uint64))[0])

_powers = {_ROOT: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, SEGMENT + 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each text starts in them (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    starts = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8), starts


def pieces(starts: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text has a range of its own."""
    low, rows = 0, len(starts) - 1
    while low < rows:
        high = int(np.searchsorted(starts, starts[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


@dataclass
class Words:
    """hash, start and end byte of each word; first[i]: number of the first word of text i."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _segment(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    solid = SOLID[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = solid[:-1]
    before[breaks] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    after[breaks[breaks > 0] - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(VALUE[data] * powers(_ROOT, n), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(_INVERSE, n)[start]), start, end


def words(data: np.ndarray, starts: np.ndarray) -> Words:
    """The words of the texts that ``starts`` delimits in ``data``."""
    parts, low, top = [], int(starts[0]), int(starts[-1])
    while low < top:
        high = min(low + SEGMENT, top)
        if high < top:  # cut where no word is split
            gaps = np.flatnonzero(~SOLID[data[low:high]])
            borders = starts[(starts > low) & (starts <= high)]
            cut = max(low + int(gaps[-1]) + 1 if len(gaps) else low, int(borders[-1]) if len(borders) else low)
            while cut == low:  # one word longer than a segment
                high = min(high + SEGMENT, top)
                gaps = np.flatnonzero(~SOLID[data[low:high]])
                borders = starts[(starts > low) & (starts <= high)]
                found = [low + int(g) + 1 for g in gaps[:1]] + [int(b) for b in borders[:1]]
                cut = min(found) if found else top if high == top else low
            high = cut
        inside = starts[(starts >= low) & (starts < high)] - low
        h, s, e = _segment(data[low:high], inside)
        parts.append((h, s + low, e + low))
        low = high
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(starts), dtype=np.int64))
    h, s, e = (np.concatenate(x) for x in zip(*parts))
    return Words(h, s, e, np.searchsorted(s, starts))


def texts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]]:
    """Each batch in slices of about a segment, with the words, bytes and byte offsets of its texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, starts = text_bytes(batch.column(column))
        for low, high in pieces(starts):
            borders = starts[low : high + 1]
            yield batch.slice(low, high - low), words(data, borders), data, borders


def shingles(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words, and the row of each; a shorter text is one run, an empty one none."""
    count = np.diff(found.first)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), made)
    place = np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made) + found.first[:-1][row]
    left = np.minimum(count[row], n)
    h = np.zeros(len(row), dtype=np.uint64)
    for k in range(n):
        there = k < left
        word = found.hash[np.where(there, place + k, 0)] if len(found.hash) else h
        h = np.where(there, mix(h * np.uint64(0x9FB21C651E98DF25) + word + np.uint64(k + 1)), h)
    return h, row


def unique_in_rows(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, in ascending order within it."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[keep], row[keep]


def crc_text(ids: pa.Array) -> np.ndarray:
    """crc32 of each id written as text (null: of the empty text)."""
    import zlib

    return np.array([zlib.crc32(b"" if x is None else str(x).encode()) for x in ids.to_pylist()], dtype=np.int64)
