"""Minimax contiguous partition: shards of near-equal bytes that never split a group of equal texts.

The groups stand in the order of a 60-bit key, the head of their text's SHA-256, so equal texts
are one atomic group and a document's shard follows from its own key. The smallest capacity that
a greedy pass from left to right can meet is found by binary search. The search reads sums of
sizes over ranges of the key: Spark sums 4096 ranges first, and then splits just the ranges in
which a cut may fall into 256 each, until every cut is known to the group. The driver holds a few
thousand sums at any size of the data, and no task holds a group.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.llm.shared import stored

KEY_BITS = 60
FIRST_BITS = 12
STEP_BITS = 8


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one (null: one)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_key(text: Column) -> Column:
    """Leading 60 bits of the SHA-256 of the UTF-8 text (null counts as empty)."""
    digest = F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


class Sums:
    """Sizes of disjoint ascending key ranges, split further where a search needs it."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        # (first key, bits of its range, bytes, one group only)
        self.parts = self._split([(0, KEY_BITS)], FIRST_BITS)
        self._line_up()

    def _split(self, ranges: list[tuple[int, int]], by: int) -> list[tuple[int, int, int, bool]]:
        out = []
        for bits in {b for _, b in ranges}:
            lows = sorted(low for low, b in ranges if b == bits)
            finer = max(bits - by, 0)
            rows = self.rows
            if bits < KEY_BITS:
                rows = rows.where(F.shiftright("key", bits).isin([low >> bits for low in lows]))
            sums = rows.groupBy(F.shiftright("key", finer).alias("part")).agg(
                F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")
            )
            out += [(r.part << finer, finer, r.size, r.low == r.high) for r in sums.collect()]
        return sorted(out)

    def _line_up(self) -> None:
        self.edge = [0]
        for part in self.parts:
            self.edge.append(self.edge[-1] + part[2])

    @property
    def total(self) -> int:
        return self.edge[-1]

    def refine(self, places: set[int]) -> None:
        """Split the ranges with these numbers."""
        found = self._split([self.parts[i][:2] for i in sorted(places)], STEP_BITS)
        self.parts = sorted([p for i, p in enumerate(self.parts) if i not in places] + found)
        self._line_up()

    def below(self, most: int, sure: bool, asked: set[int]) -> int:
        """The largest cut not over ``most``: of the known cuts if ``sure``, else at best; notes the range in doubt."""
        if most >= self.total:
            return self.total
        place = bisect_right(self.edge, most) - 1
        if self.edge[place] == most or self.parts[place][3]:
            return self.edge[place]
        asked.add(place)
        return self.edge[place] if sure else most

    def fits(self, capacity: int, shards: int, start: int = 0) -> bool:
        """Whether a greedy pass from ``start`` needs at most ``shards`` shards of ``capacity``."""
        while True:
            asked: set[int] = set()
            for sure, answer in ((True, True), (False, False)):
                at = start
                for _ in range(shards):
                    at = self.below(at + capacity, sure, asked)
                if (at >= self.total) is answer:
                    return answer
            self.refine(asked)

    def cut(self, most: int) -> int:
        """The largest cut not over ``most``."""
        while True:
            asked: set[int] = set()
            at = self.below(most, True, asked)
            if not asked:
                return at
            self.refine(asked)


def smallest_capacity(sums: Sums, shards: int) -> int:
    low, high = -(-sums.total // shards), max(sums.total, 1)
    while low < high:
        middle = (low + high) // 2
        if sums.fits(middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def cut_points(sums: Sums, shards: int) -> list[int]:
    """First key of each shard after the first.

    No shard passes the smallest capacity. Within it each shard stops at its fair share of what
    is left, if the rest still fits; so one great group does not leave other shards empty.
    """
    capacity, at, cuts = smallest_capacity(sums, shards), 0, []
    for left in range(shards, 1, -1):
        share = -(-(sums.total - at) // left)
        end = sums.cut(at + min(share, capacity))
        if end < sums.total and (end == at or not sums.fits(capacity, left - 1, end)):
            end = sums.cut(at + capacity)
        at = end
        place = bisect_right(sums.edge, at) - 1
        cuts.append(sums.parts[place][0] if at < sums.total else 1 << KEY_BITS)
    return cuts


def shard_documents(docs: DataFrame, shards: int = 16, rows_per_slot_range: int = 20_000) -> DataFrame:
    """Shard and slot of every row of ``docs`` (doc_id, text).

    Returns doc_id, size, text_crc32, law, shard, slot (0, 1, ... in each shard) and grown_shard
    (null: sizes decide, so another shard count is another cut). Null and empty texts are one
    group of size 1 a row; rows with equal or null ids each have a slot; no rows give no rows.
    Other columns of ``docs`` are not read.
    """
    text = F.col("text")
    narrow = stored(
        docs.select(
            "doc_id",
            text_size(text).alias("size"),
            F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
            text_key(text).alias("key"),
        ),
        "sharding",
    )
    sums = Sums(narrow)
    cuts = cut_points(sums, shards)
    shard = sum(((F.col("key") >= F.lit(cut)).cast("int") for cut in cuts), F.lit(0)) if cuts else F.lit(0)
    # A shard's slots are dealt over ranges of about equal row counts, each numbered by itself.
    ranges = max(64, -(-narrow.count() // rows_per_slot_range))
    placed = narrow.select(
        "*",
        shard.cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", "key"), F.lit(ranges)).alias("slice"),
    )
    placed.createOrReplaceTempView(view := f"placed_{id(placed)}")
    spark = docs.sparkSession
    return spark.sql(f"""
        WITH counts AS (SELECT shard, slice, count(*) AS n FROM {view} GROUP BY shard, slice),
        offsets AS (
            SELECT shard, slice, sum(n) OVER (PARTITION BY shard ORDER BY slice) - n AS base FROM counts
        ),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY shard, slice ORDER BY doc_id, key) - 1 AS place FROM {view}
        )
        SELECT doc_id, size, text_crc32, 'bytes' AS law, n.shard, base + place AS slot, cast(NULL AS int) AS grown_shard
        FROM numbered n JOIN offsets o ON n.shard = o.shard AND n.slice = o.slice
    """)
