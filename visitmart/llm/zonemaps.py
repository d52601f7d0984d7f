"""Centroid clustering in whole numbers over zone maps of Hilbert-ordered blocks.

Vectors are projected on their principal axes and range-partitioned by the Hilbert key of the projection, so the
rows of a block lie close together. A block keeps its vectors, the smallest and greatest value of each component
(its box) and the components' sums. No vector of a block is nearer to a centroid than the box is, nor farther than
the box's farthest corner; a centroid whose nearest distance passes another's farthest one is no candidate.
A block with one candidate adds its sums as they are; the vectors of other blocks are compared exactly with the
block's candidates. All distances and sums are whole numbers, so order and number of tasks change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.hilbert import hilbert_keys
from visitmart.llm.shared import stored

BLOCK = 256  # vectors
AXES, BITS = 6, 8  # of the Hilbert keys
#: Greatest whole number of a component: 64 squared differences then fit into 63 bits.
LIMIT = 1 << 27
_BLOCKS = "ids array<long>, vectors binary, low binary, high binary, sums binary"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_vectors(vectors: DataFrame, size: int = 64, scale: int = 1024, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id and vec (array<int>: floor(scale * component)) of the rows that take part.

    Null vectors, such of another length than ``size`` and such with a null or non-finite component take none, nor
    do components so great (beyond 2**27 after scaling) that a squared distance would not fit into a long.
    """
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LIMIT // scale - 1)
    vec = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"))
    rows = rows.where((F.size("vec") == size) & F.forall("vec", fits))
    return rows.select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("int")).alias("vec"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, size)


def principal_axes(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, the ``AXES`` directions of greatest spread, and the greatest deviation, of all rows."""
    upper = np.triu_indices(size)

    def run(batches):
        first, second, n = np.zeros(size), np.zeros((size, size)), 0
        for batch in batches:
            x = _matrix(batch.column("vec"), size).astype(np.float64)
            first, second, n = first + x.sum(axis=0), second + x.T @ x, n + len(x)
        if n:
            value = np.concatenate([[n], first, second[upper]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value))), pa.array(value)], names=["place", "value"])

    sums = rows.select("vec").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(1 + size + len(upper[0]))
    for place, value in sums.collect():  # one row for each entry of a matrix of fixed size
        total[place] = value
    mean, second = total[1 : size + 1] / total[0], np.zeros((size, size))
    second[upper] = total[size + 1 :] / total[0]
    spread = second + np.triu(second, 1).T - np.outer(mean, mean)
    values, vectors = np.linalg.eigh(spread)
    return mean, vectors[:, ::-1][:, : min(AXES, size)], float(np.sqrt(max(values[-1], 1e-12)))


def hilbert_blocks(rows: DataFrame, size: int) -> DataFrame:
    """The blocks of ``rows`` (id, vec) in Hilbert order. Each vector is in one block; equal vectors may be in several."""
    mean, axes, spread = principal_axes(rows, size)

    def key(batches):
        for batch in batches:
            y = (_matrix(batch.column("vec"), size) - mean) @ axes / (8 * spread) + 0.5
            cells = np.clip(y * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hilbert_keys(cells, BITS)), batch.column("id"), batch.column("vec")], names=["key", "id", "vec"]
            )

    def block(batches):
        for batch in batches:
            x, out = _matrix(batch.column("vec"), size).astype(np.int32), []
            for at in range(0, len(x), BLOCK):
                part = x[at : at + BLOCK]
                sums = part.sum(axis=0, dtype=np.int64)
                ids = batch.column("id").slice(at, len(part)).to_pylist()
                out.append((ids, *(a.tobytes() for a in (part, part.min(axis=0), part.max(axis=0), sums))))
            if out:
                kinds = (pa.list_(pa.int64()), *[pa.binary()] * 4)
                names = ["ids", "vectors", "low", "high", "sums"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    keyed = rows.mapInArrow(key, "key long, id long, vec array<int>")
    # a number of its own parts copies of one vector and id, however many
    ordered = keyed.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("key", "id", "copy")
    return ordered.sortWithinPartitions("key", "id", "copy").select("id", "vec").mapInArrow(block, _BLOCKS)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Ascending numbers of the centroids that may be nearest, or tie, for some point of the box."""
    outside = np.maximum(low - centroids, 0) + np.maximum(centroids - high, 0)
    corner = np.maximum(centroids - low, high - centroids)
    return np.flatnonzero((outside * outside).sum(axis=1) <= (corner * corner).sum(axis=1).min())


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple]:
    """ids, vectors, sums, candidates, and for each vector its place among them (None if there is one) of each block."""
    size = centroids.shape[1]
    rows = (batch.column(c).to_pylist() for c in ("ids", "vectors", "low", "high", "sums"))
    for ids, vectors, low, high, sums in zip(*rows):
        box = (np.frombuffer(b, np.int32).astype(np.int64) for b in (low, high))
        near = candidates(*box, centroids)
        vectors = np.frombuffer(vectors, np.int32).reshape(-1, size)
        place = _distances(vectors, centroids[near]).argmin(axis=1) if len(near) > 1 else None
        yield ids, vectors, np.frombuffer(sums, np.int64), near, place


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for k, centroid in enumerate(centroids):
        apart = x - centroid
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return out


def _summed(made: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by (cluster, place), of which there are clusters times a vector's size."""
    wide = made.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {(r.cluster, r.place): int(r.value) for r in wide.collect()}


def move(blocks: DataFrame, centroids: list[list[int]]) -> tuple[list[list[int]], int]:
    """The centroids after one round: floor(sum / count) of their vectors, as before where they have none; and the number of comparisons made."""
    fixed = np.array(centroids, dtype=np.int64)
    k, size = fixed.shape

    def run(batches):
        sums, count, compared = np.zeros((k, size), np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            for ids, vectors, whole, near, place in _assigned(batch, fixed):
                if place is None:
                    sums[near[0]] += whole
                    count[near[0]] += len(ids)
                    continue
                compared += len(ids) * len(near)
                for n, cluster in enumerate(near):
                    own = vectors[place == n]
                    sums[cluster] += own.sum(axis=0, dtype=np.int64)
                    count[cluster] += len(own)
        value = np.column_stack([sums, count, np.r_[compared, np.zeros(k - 1, np.int64)]])
        cluster, at = np.divmod(np.arange(value.size), size + 2)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cluster, at, value.ravel())], names=["cluster", "place", "value"])

    got = _summed(blocks.mapInArrow(run, "cluster long, place long, value long"))
    moved = []
    for c, old in enumerate(centroids):
        n = got.get((c, size), 0)
        moved.append([got[c, d] // n for d in range(size)] if n else old)
    return moved, got.get((0, size + 1), 0)


def inertias(blocks: DataFrame, centroids: list[list[int]]) -> list[int]:
    """Sum of the squared distances of each centroid's vectors."""
    fixed = np.array(centroids, dtype=np.int64)

    def run(batches):
        total = np.zeros((len(fixed), 2), np.int64)  # of the upper and of the lower 32 bits
        for batch in batches:
            for _, vectors, _, near, place in _assigned(batch, fixed):
                distance = _distances(vectors, fixed[near])
                place = np.zeros(len(vectors), np.int64) if place is None else place
                own = distance[np.arange(len(vectors)), place]
                np.add.at(total, near[place], np.column_stack([own >> 32, own & 0xFFFFFFFF]))
        cluster, at = np.divmod(np.arange(total.size), 2)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cluster, at, total.ravel())], names=["cluster", "place", "value"])

    got = _summed(blocks.mapInArrow(run, "cluster long, place long, value long"))
    return [(got.get((c, 0), 0) << 32) + got.get((c, 1), 0) for c in range(len(centroids))]


def assign(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The columns of ``RESULT`` for every vector of the blocks."""
    fixed, sums = np.array(centroids, dtype=np.int64), inertias(blocks, centroids)
    # a sum beyond a long is null
    long = lambda x: x if x < 1 << 63 else None
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own, whole = pa.array([long(x) for x in sums], pa.int64()), pa.scalar(long(sum(sums)), pa.int64())
    digest = pa.array(named)

    def run(batches):
        for batch in batches:
            for ids, vectors, _, near, place in _assigned(batch, fixed):
                place = np.zeros(len(vectors), np.int64) if place is None else place
                cluster = near[place]
                distance = _distances(vectors, fixed[near])[np.arange(len(vectors)), place]
                at = pa.array(cluster)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance),
                        own.take(at), pa.array([whole.as_py()] * len(ids), pa.int64()), digest.take(at),
                    ],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return blocks.mapInArrow(run, RESULT)


def first_centroids(rows: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors whose id hashes lowest (sha256 of ``<salt>:<id>``; null: no digits); ties by vector."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r.vec) for r in rows.select(digest.alias("digest"), "vec").orderBy("digest", "vec").limit(k).collect()]


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3",
    id_column: str = "vec_id", column: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    ``whole_vectors`` says which do. In each of ``rounds`` every vector goes to its nearest centroid (ties: the smaller
    number), and each centroid that has vectors moves to the floor of their mean; then all are assigned once more.
    With fewer than ``k`` vectors each is a first centroid. Repeated rows and null ids each keep a row; no usable
    rows give no rows. Other columns are not read.
    """
    rows = whole_vectors(vectors, size, scale, id_column, column)
    centroids = first_centroids(rows, k, salt)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], RESULT)
    blocks = stored(hilbert_blocks(rows, size), "blocks")
    for _ in range(rounds):
        centroids, _ = move(blocks, centroids)
    return assign(blocks, centroids)
