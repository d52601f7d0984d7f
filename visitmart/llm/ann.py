"""Approximate nearest neighbours by several shifted Hilbert orderings.

Each curve orders all vectors by the Hilbert key of a rotated, shifted, gridded projection. Spark
range-partitions every ordering, so each vector has a rank on each curve. A query is compared, on the
original vectors, with all rows within a window of ranks around its own on each curve, and the windows'
best are merged. A window is a share of all rows: on data without structure no curve brings neighbours
much closer together than chance, and a window of fixed length would lose recall as rows grow.

Equal vectors are one node, which stands on a curve once with its smallest ids; so a group of copies, however
large, fills no window. What is found for a node goes to each of its queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visitmart.llm.hilbert import hilbert_keys
from visitmart.llm.shared import stored

CURVES, DIMS, BITS = 5, 6, 8
SLOT = 4096  # rows compared at once
PACK = 256  # queries sent to a slot at once; a range of ranks that has more than twice as many is cut
CHUNKS = 64  # of a node's queries
SHARE = 0.3  # of all nodes, in a window
LEAST_HALF = 1024  # ranks to either side of a query at least


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id and vector (array<double>) of the rows that take part.

    Null ids, null, empty and zero vectors, and such with null or non-finite parts take none; nor do vectors of another
    length than the most frequent (of equally frequent ones, the longest).
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vec = F.transform(F.col(column).cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 is 0.0
    good = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)
    )
    lengths = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.where(F.size("vec") == (lengths.n if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _axes(size: int, seed: int) -> list[np.ndarray]:
    """An orthonormal frame of up to ``DIMS`` directions for each curve."""
    rng = np.random.default_rng(seed)
    return [np.linalg.qr(rng.standard_normal((size, size)))[0][:, : min(DIMS, size)] for _ in range(CURVES)]


def _moments(rows: DataFrame, axes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of all rows along each direction."""
    frame = np.concatenate(axes, axis=1)
    count = frame.shape[1]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column("vec")) @ frame
                values = [batch.num_rows, *y.sum(axis=0), *(y * y).sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array([float(v)]) for v in values], names=names)

    names = ["n", *(f"s{k}" for k in range(count)), *(f"q{k}" for k in range(count))]
    sums = rows.select("vec").mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c) for c in names]).first()
    total = np.array(sums, dtype=np.float64)
    mean = total[1 : count + 1] / total[0]
    return mean, np.sqrt(np.maximum(total[count + 1 :] / total[0] - mean * mean, 1e-12))


def _ranked(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """curve, rank, node, ids, asked and vec: each row of ``rows`` once on each curve."""
    axes = _axes(size, seed)
    mean, spread = _moments(rows, axes)
    shifts = np.random.default_rng(seed + 1).random((CURVES, min(DIMS, size)))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, at = _matrix(batch.column("vec")), 0
            for curve, frame in enumerate(axes):
                to = at + frame.shape[1]
                y = (x @ frame - mean[at:to]) / spread[at:to]
                cells = np.clip(((y + 3) / 8 + shifts[curve] / 4) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                key = hilbert_keys(cells, BITS)
                at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), curve, np.int32)), pa.array(key), *(batch.column(c) for c in columns)],
                    names=["curve", "key", *columns],
                )

    columns = ["node", "ids", "asked", "vec"]
    schema = "curve int, key long, node long, ids array<long>, asked boolean, vec array<double>"
    keyed = rows.select(columns).mapInArrow(run, schema)
    ordered = keyed.repartitionByRange("curve", "key", "node").sortWithinPartitions("curve", "key", "node")
    # the partition of a row is in the high bits of ``place``, its number there in the low ones
    placed = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "curves")
    part = F.shiftright("place", 33).alias("part")
    sizes = placed.groupBy("curve", part).agg(F.count("*").alias("n"), F.min("place").alias("low"))
    before = F.sum("n").over(W.partitionBy("curve").orderBy("part")) - F.col("n")
    starts = sizes.select(F.col("curve").alias("c"), F.col("part").alias("p"), "low", before.alias("start"))
    joined = placed.join(starts, (F.col("curve") == F.col("c")) & (F.shiftright("place", 33) == F.col("p")))
    return joined.select("curve", (F.col("start") + F.col("place") - F.col("low")).alias("rank"), *columns)


def _best(distance: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest distinct ids of the nodes at these distances, and their distances; ties to the smaller id."""
    want = k
    while True:
        near = np.arange(len(distance))
        if len(distance) > want:
            near = np.flatnonzero(distance <= np.partition(distance, want - 1)[want - 1])
        id_ = np.concatenate([ids[i] for i in near]) if len(near) else np.zeros(0, np.int64)
        d = np.repeat(distance[near], [len(ids[i]) for i in near])
        order = np.lexsort((id_, d))
        id_, d = id_[order], d[order]
        once = np.sort(np.unique(id_, return_index=True)[1])[:k]
        if len(once) == k or len(near) == len(distance):
            return id_[once], d[once]
        want *= 2  # ids that several nodes hold count once


def _nodes(rows: DataFrame, queries, k: int) -> tuple[DataFrame, DataFrame]:
    """All memberships (id, h1, h2, vec), and a row for each node: node, h1, h2, vec, its k + 1 smallest ids and whether it holds a query.

    A node is named by 128 bits of hash of its vector.
    """
    hashed = rows.select("id", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"), "vec")
    members = stored(hashed.dropDuplicates(["h1", "h2", "id"]), "members")
    # the limit on the row number holds in each task before the shuffle, too
    number = F.row_number().over(W.partitionBy("h1", "h2").orderBy("id"))
    least = members.withColumn("number", number).where(F.col("number") <= k + 1)
    least = least.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))
    asked = members.where(queries).select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    nodes = least.join(asked, ["h1", "h2"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    return members, stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def nearest(
    vectors: DataFrame, queries, k: int = 10, id_column: str = "vec_id", column: str = "embedding", share: float = SHARE, seed: int = 17
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance in doubles) of the ``k`` nearest found of each query.

    ``queries`` is a condition on ``id``; candidates are all rows with another id. Ties go to the smaller id; repeated
    ids count once, at their smallest distance. With fewer than ``k`` candidates all are returned; without usable rows,
    none. Windows reach ``share`` of all distinct vectors, and at least LEAST_HALF ranks to either side. Other columns are
    not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, column)
    first = rows.first()
    schema = "query_id long, rank int, vec_id long, score double"
    if first is None:
        return spark.createDataFrame([], schema)
    members, nodes = _nodes(rows, queries, k)
    ranked = stored(_ranked(nodes, len(first.vec), seed), "ranked")
    sizes = nodes.agg(F.count("*").alias("n"), F.count_if("asked").alias("asked")).first()
    total = sizes.n
    half = max(LEAST_HALF, int(np.ceil(share * total / 2)))
    low = F.greatest(F.lit(0), F.least(F.col("rank") - half, F.lit(total - 1 - 2 * half)))
    # nodes of like rank on a curve go to the same slots; a pack of them meets a slot's rows in one group
    reach = max(SLOT, -(-PACK * total // max(sizes.asked, 1)))
    region = F.floor(F.col("rank") / F.lit(reach)).alias("region")
    asked = ranked.where("asked").select("curve", "node", "vec", low.alias("low"), (low + 2 * half).alias("high"), region)
    many = asked.groupBy("curve", "region").agg(F.ceil(F.count("*") / F.lit(2 * PACK)).alias("parts"))
    slots = F.sequence(F.floor(F.col("low") / SLOT), F.floor(F.least("high", F.lit(total - 1)) / SLOT))
    pack = F.struct("region", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")).alias("pack")
    asked = asked.join(many, ["curve", "region"]).select("curve", "node", "vec", "low", "high", pack, F.explode(slots).alias("slot"))
    packs = asked.select(F.col("curve").alias("c"), F.col("slot").alias("s"), "pack").distinct()
    placed = ranked.withColumn("slot", F.floor(F.col("rank") / SLOT))
    sent = placed.join(packs, (F.col("curve") == F.col("c")) & (F.col("slot") == F.col("s")))
    sent = sent.select(*[F.col(c).alias(f"r_{c}") for c in ("curve", "slot", "pack", "rank", "ids", "vec")])

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, ids, rank = np.stack(left["r_vec"].to_numpy()), left["r_ids"].to_numpy(), left["r_rank"].to_numpy()
            order = np.argsort(rank, kind="stable")
            x, ids, rank = x[order], ids[order], rank[order]
            for q, v, lo, hi in zip(right["node"], right["vec"], right["low"], right["high"]):
                a, b = np.searchsorted(rank, lo), np.searchsorted(rank, hi, side="right")
                difference = x[a:b] - v
                distance = np.sqrt((difference * difference).sum(axis=1))
                best, score = _best(distance, ids[a:b], k + 1)  # one of them may be the query itself
                out.append(pd.DataFrame({"node": q, "vec_id": best, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "vec_id": [], "score": []})

    by = ["curve", "slot", "pack"]
    found = sent.groupBy([f"r_{c}" for c in by]).cogroup(asked.groupBy(by)).applyInPandas(compare, "node long, vec_id long, score double")
    found = found.groupBy("node", "vec_id").agg(F.min("score").alias("score"))
    number = F.row_number().over(W.partitionBy("node").orderBy("score", "vec_id"))
    found = found.withColumn("number", number).where(F.col("number") <= k + 1)
    found = found.groupBy("node").agg(F.collect_list(F.struct("vec_id", "score")).alias("found"))
    # a node's queries come as chunks, which are dealt out again before they are taken apart
    chunk = F.pmod(F.xxhash64("id"), F.lit(CHUNKS)).alias("chunk")
    chunks = members.where(queries).groupBy("h1", "h2", chunk).agg(F.collect_list("id").alias("queries"))
    chunks = chunks.join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).join(found, "node")
    chunks = chunks.repartition("node", "chunk").select(F.explode("queries").alias("query_id"), "found")
    each = chunks.select("query_id", F.explode("found").alias("f")).select("query_id", "f.*").where("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    top = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
