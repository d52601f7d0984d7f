"""How document filters overlap, in every order of applying them, by wide packed counters.

A document's outcome under all orders of ``n`` filters follows from its mask, the set of filters that it fails. Each
mask has one big integer whose 64-bit fields say for every order and step whether the document is removed there, and
whether it would fail there but went before; further fields count the document and the filter that it alone fails.
Tasks add up the integers of their documents for each part and group of labels, the sums are summed, and fields are
cut out of the totals. A field never passes a long, so none carries into the next.
"""

from __future__ import annotations

from functools import cache, reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.llm.shared import stored

BYTES = 8  # of a field
PARTS = 256  # parts a task holds sums of
SALTS = 64  # groups that a part's sums go to before they meet
GAP = "[\\x20\\x09-\\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Name of the filter that compares texts with each other.
REPEATED = "E"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides, by name. ``text`` must not be null."""
    words = F.filter(F.split(text, GAP), lambda x: x != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": 100 * different < 50 * n,
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


@cache
def packed(letters: str) -> list[int]:
    """The integer of each mask; bit k of a mask stands for the k-th of ``letters``."""
    orders = list(permutations(range(len(letters))))
    steps = len(orders) * len(letters)
    made = []
    for mask in range(1 << len(letters)):
        fields = [2 * steps]
        for number, order in enumerate(orders):
            failed = [number * len(letters) + step for step, k in enumerate(order) if mask >> k & 1]
            fields += failed[:1] + [steps + f for f in failed[1:]]
        if mask.bit_count() == 1:
            fields.append(2 * steps + mask.bit_length())
        made.append(sum(1 << 8 * BYTES * f for f in fields))
    return made


def unpacked(value: int, letters: str) -> np.ndarray:
    """The fields: removed and redundant of every order and step, documents, and those failing one letter only."""
    steps = len(list(permutations(letters))) * len(letters)
    count = 2 * steps + 1 + len(letters)
    return np.frombuffer(value.to_bytes(BYTES * count, "little"), "<i8")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic and n: documents counted by source (null: empty), failed filters and labels.

    ``docs``: doc_id, text, source; null texts are empty. A text fails ``E`` if a row with a smaller doc_id has the same; a
    null id is neither smaller nor greater than any, and has no label. A document is good, or toxic, if any row of
    ``labels`` (doc_id, quality, toxic) says so with 1. Of a text that many rows share just one row a task goes to its
    group, so no group holds all its rows.
    """
    text = F.coalesce("text", F.lit(""))
    flags = text_filters(text)
    mask = reduce(lambda a, b: a + b, (F.when(c, 1 << k).otherwise(0) for k, c in enumerate(flags.values())))
    slim = docs.select(
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        mask.cast("int").alias("mask"),
    )
    slim = stored(slim.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")), "masks")
    first = slim.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    placed = slim.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    placed = placed.withColumn("mask", F.col("mask") + F.when(repeated, 1 << len(flags)).otherwise(0))
    # rows without an id have no label, and are spread by their text
    key = F.coalesce("doc_id", F.xxhash64("digest"))
    labelled = (
        labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy(F.col("doc_id").cast("long").alias("key"), F.lit(False).alias("lone"))
        .agg(F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
    )
    joined = placed.withColumns({"key": key, "lone": F.isnull("doc_id")}).join(labelled, ["key", "lone"], "left")
    return joined.select("part", "mask", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")), "n")


_PACKED = "part string, kind int, salt int, value binary"


def _bytes(value: int) -> bytes:
    return value.to_bytes((value.bit_length() + 7) // 8, "little")


def packed_sums(rows: DataFrame, letters: str) -> DataFrame:
    """part, kind (0 all, 1 good, 2 toxic documents) and value: the sum of the documents' integers."""

    def run(batches):
        from pyspark import TaskContext

        table, held, salt = packed(letters), {}, TaskContext.get().partitionId() % SALTS

        def flush():
            rows = [(part, kind, salt, _bytes(value)) for (part, kind), value in held.items()]
            columns = zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["part", "kind", "salt", "value"])

        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(["part", "mask", "good", "toxic"]).aggregate([("n", "sum")])
            for row in counted.to_pylist():
                value = row["n_sum"] * table[row["mask"]]
                for kind in (0, *[1] * row["good"], *[2] * row["toxic"]):
                    at = (row["part"], kind)
                    held[at] = held.get(at, 0) + value
            if len(held) > 3 * PARTS:
                yield flush()
                held.clear()
        if held:
            yield flush()

    def add(group: pa.Table) -> pa.Table:
        value = sum(int.from_bytes(b, "little") for b in group.column("value").to_pylist())
        return group.slice(0, 1).set_column(3, "value", pa.array([_bytes(value)], pa.binary()))

    parts = rows.mapInArrow(run, _PACKED)
    return parts.groupBy("part", "kind", "salt").applyInArrow(add, _PACKED).groupBy("part", "kind").applyInArrow(add, _PACKED)


def report(sums: DataFrame, letters: str) -> DataFrame:
    """The rows of ``RESULT`` from ``packed_sums``."""
    orders = list(permutations(range(len(letters))))
    steps = len(orders) * len(letters)
    at = np.array(orders).ravel()  # the filter of each order and step

    def rows(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        found = dict(zip(group.column("kind").to_pylist(), group.column("value").to_pylist()))
        whole, good, toxic = (unpacked(int.from_bytes(found.get(k, b""), "little"), letters) for k in range(3))
        removed = whole[:steps]
        kept = whole[2 * steps] - removed.reshape(len(orders), -1).cumsum(axis=1).ravel()
        shapley = np.zeros(len(letters), np.int64)
        np.add.at(shapley, at, removed)
        names = ["".join(letters[k] for k in order) for order in orders]
        columns = {
            "part": pa.array([key[0].as_py()] * steps, pa.string()),
            "filter_order": np.repeat(names, len(letters)),
            "step": np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders)),
            "kept": kept,
            "removed": removed,
            "redundant": whole[steps : 2 * steps],
            "unique_fails": whole[2 * steps + 1 + at],
            "good_lost": good[:steps],
            "toxic_lost": toxic[:steps],
            "shapley": shapley[at],
        }
        return pa.table(columns)

    return sums.groupBy("part").applyInArrow(rows, RESULT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part, order of the filters A to E and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``masks`` defines nulls, repeated rows and labels; a null source is the part with the empty name. No documents give
    no rows; without labels nothing good or toxic is lost. Other columns are not read.
    """
    letters = "ABCD" + REPEATED
    return report(packed_sums(masks(docs, labels), letters), letters)
