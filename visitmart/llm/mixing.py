"""Mixing sources to target weights by entropy balancing.

Each source is to give a target number of words. Of all rates at which its documents may be taken, those of greatest
entropy against one copy each, under the constraint on words and a greatest rate, are exponential tilts
``min(most, exp(lambda * size))``. One multiplier per source solves the convex dual; Newton steps for all sources go
side by side, each step one aggregation over the classes of documents of like source and size, of which there are far
fewer than documents. Sums are decimal and thus the same in every order, so a rerun takes the same steps.

Rates become copies class by class, from the greatest size down, each class making up for the rounding of those
before; so a source's words miss their target by about half of its smallest document. Within a class the documents of
lowest hash get the copy more.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visitmart.llm.shared import remove, stored

GAP = "[\\x20\\x09-\\x0D]+"
SOURCE = ["lone", "name"]  # whether the source is null, and its text
CLASS = [*SOURCE, "size"]
PIECE = 256  # documents of a class ranked at once, while it has no more than PIECES of them
PIECES = 65_536
TOLERANCE, STEPS = 1e-9, 100
_EXACT = "decimal(38,9)"


def words(text) -> F.Column:
    """Number of words of a text (null: none)."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda x: x != "")).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source as ``SOURCE``, size and times of the distinct rows of ``docs`` (doc_id, text, source)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.isnull("source").alias("lone"),
        F.coalesce("source", F.lit("")).alias("name"),
        words(F.col("text")).alias("size"),
    )
    return rows.groupBy("doc_id", *CLASS).agg(F.count("*").alias("times"))


def ranked_sources(classes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``SOURCE``, source_size and weight: the weights go round over the sources by code point, null last."""
    sums = classes.groupBy(*SOURCE).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = sums.repartitionByRange(*SOURCE).sortWithinPartitions(*SOURCE)
    # the partition of a source is in the high bits of ``place``, its number there in the low ones
    placed = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))  # a row for each partition
    sizes = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("start"))
    number = F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(number, F.lit(len(weights))) + 1).cast("int"))
    return placed.withColumn("part", part).join(sizes, "part").select(*SOURCE, "source_size", weight.alias("weight"))


def targets(sources: DataFrame, most: int) -> DataFrame:
    """``sources`` with target: shares of all sizes by weight, none above ``most`` times the source's size.

    What a source cannot take is shared among the others by weight, until none is above.
    """
    bound = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > bound
        row = sources.agg(
            F.count_if(above).alias("full"), F.sum(F.when(above, bound)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("free")
        ).first()
        if row.full == full or not row.free:
            break
        full, level = row.full, (total - (row.held or 0)) / row.free
    target = F.least(F.col("weight") * F.lit(level), bound.cast("double"))
    return sources.withColumn("target", target)


def rate(multiplier, scaled_size, most: int):
    """Copies of a document: the tilt, up to ``most``; a null multiplier stands for a source that gives all it may."""
    return F.when(multiplier.isNull(), float(most)).otherwise(F.exp(F.least(multiplier * scaled_size, F.lit(math.log(most)))))


def balanced(classes: DataFrame, aims: DataFrame, most: int) -> DataFrame:
    """``aims`` with multiplier and scale: at ``rate(multiplier, size / scale)`` each source's words meet its target."""
    spark = classes.sparkSession
    bounds = classes.where("size > 0").groupBy(*SOURCE).agg(F.max("size").alias("scale"), F.min("size").alias("least"))
    state = aims.join(bounds, SOURCE, "left")
    open_ = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))
    nearest = F.col("least") / F.col("scale")
    short = F.col("target") < F.col("source_size")
    state = state.select(
        *SOURCE,
        "source_size",
        "target",
        F.coalesce("scale", F.lit(1)).cast("double").alias("scale"),
        # a full source has no multiplier, a source without words any
        F.when(open_ | (F.col("target") <= 0), 0.0).alias("multiplier"),
        F.when(short, F.log(F.col("target") / F.col("source_size")) / nearest).otherwise(0.0).alias("low"),
        F.when(short, 0.0).otherwise(math.log(most) / nearest).alias("high"),
        open_.alias("open"),
    )
    x = F.col("size") / F.col("scale")
    path = None
    for step in range(STEPS):
        state, old, path = stored(state, "multipliers"), path, None
        path = state.inputFiles()[0].rsplit("/", 1)[0] if state.inputFiles() else None
        if old:
            remove(spark, old)
        if step and not state.where("open").limit(1).count():
            break
        at = rate(F.col("multiplier"), x, most)
        taken = F.col("n") * F.col("size") * at
        grown = F.when(at < most * (1 - 1e-12), taken * x).otherwise(0.0)
        sums = (
            classes.join(state.where("open"), SOURCE)
            .groupBy(*SOURCE)
            .agg(F.sum(taken.cast(_EXACT)).cast("double").alias("f"), F.sum(grown.cast(_EXACT)).cast("double").alias("slope"))
        )
        met = F.abs(F.col("f") - F.col("target")) <= TOLERANCE * F.col("target")
        low = F.when(F.col("f") < F.col("target"), F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("f") < F.col("target"), F.col("high")).otherwise(F.col("multiplier"))
        newton = F.col("multiplier") - F.try_divide(F.col("f") - F.col("target"), F.col("slope"))
        inside = (newton > low) & (newton < high)
        moved = F.when(F.coalesce(inside, F.lit(False)), newton).otherwise((low + high) / 2)
        go = F.coalesce(F.col("open") & ~met, F.lit(False))
        state = state.join(sums, SOURCE, "left").select(
            *SOURCE,
            "source_size",
            "target",
            "scale",
            F.when(go, moved).otherwise(F.col("multiplier")).alias("multiplier"),
            F.when(go, low).otherwise(F.col("low")).alias("low"),
            F.when(go, high).otherwise(F.col("high")).alias("high"),
            go.alias("open"),
        )
    return state.select(*SOURCE, "source_size", "target", "multiplier", "scale")


def copies(classes: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """The classes with rate, low and extra: ``extra`` of a class's documents get low + 1 copies, the others low.

    A source's different sizes meet in one task. They are few: k of them take at least k * k / 2 words.
    """
    at = rate(F.col("multiplier"), F.col("size") / F.col("scale"), most).alias("rate")
    rated = classes.join(state, SOURCE).select(*CLASS, "n", "source_size", "target", at)

    def carry(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ascending=False)
        owed, made = 0.0, []
        for size, n, rate_ in zip(group["size"].tolist(), group["n"].tolist(), group["rate"].tolist()):
            number = n
            if size:
                wanted = n * rate_
                number = min(max(round(wanted + owed / size), 0), most * n)
                owed += (wanted - number) * size
            made.append(number)
        made = np.array(made, dtype=np.int64)
        return group.assign(low=made // group["n"], extra=made % group["n"])

    schema = "lone boolean, name string, size long, n long, source_size long, target double, rate double, low long, extra long"
    return rated.groupBy(*SOURCE).applyInPandas(carry, schema)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken (words, repeats counted) of every row of ``docs``.

    ``docs``: doc_id, text, source. Sources share all words by ``weights``, dealt round in the order of their names by code
    point (null last); none gives more than ``most`` times its own. Null, empty and blank texts have size 0 and give
    nothing. Rows equal in id, source and size each have a row; null ids are one id. No rows give no rows. Other
    columns are not read.
    """
    rows = stored(sized(docs), "sized")
    classes = stored(rows.groupBy(*CLASS).agg(F.sum("times").alias("n")), "classes")
    state = balanced(classes, targets(stored(ranked_sources(classes, weights), "weights"), most), most)
    plan = stored(copies(classes, state, most), "plan")
    # the hash cuts a class into pieces in its own order, so that a piece's documents rank after those of the pieces before
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(13)), 33)
    pieces = F.least(F.lit(PIECES), F.ceil(F.col("n") / PIECE))
    placed = rows.join(plan, CLASS).withColumn("u", u).withColumn("piece", F.shiftright(F.col("u") * pieces, 31))
    placed = stored(placed, "placed")  # written as joined, so a class that many rows share may be split
    counted = placed.groupBy(*CLASS, "piece").agg(F.sum("times").alias("held"))
    before = F.sum("held").over(W.partitionBy(*CLASS).orderBy("piece")) - F.col("held")
    starts = counted.select(*CLASS, "piece", before.alias("start"))
    inside = F.sum("times").over(W.partitionBy(*CLASS, "piece").orderBy("u", F.col("doc_id").asc_nulls_last()))
    first = F.col("start") + F.col("inside") - F.col("times")
    more = F.greatest(F.lit(0), F.least(F.col("times"), F.col("extra") - first))
    ranked = placed.withColumn("inside", inside).join(starts, [*CLASS, "piece"]).withColumn("more", more)
    kinds = F.array(
        F.struct((F.col("low") + 1).alias("copies"), F.col("more").alias("rows")),
        F.struct(F.col("low").alias("copies"), (F.col("times") - F.col("more")).alias("rows")),
    )
    each = ranked.withColumn("kind", F.explode(kinds)).where("kind.rows > 0")
    source = F.when(~F.col("lone"), F.col("name")).alias("source")
    each = each.select("doc_id", source, "size", "source_size", "target", "rate", "kind.copies", "kind.rows")
    # repeated rows come as blocks, dealt out before they are written one by one
    if rows.where(F.col("times") > PIECE).limit(1).count():
        blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / PIECE))).alias("block")
        each = each.select("*", blocks).withColumn("rows", F.least(F.lit(PIECE), F.col("rows") - PIECE * F.col("block")))
        each = each.repartition("doc_id", "block").drop("block")
    each = each.withColumn("one", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return each.select("doc_id", "source", "size", "source_size", "target", "rate", F.col("copies").cast("int"), taken)
