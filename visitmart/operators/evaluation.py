"""Splitting, weighting and scoring of a binary classifier, as DataFrame operators.

Inputs have a ``score`` and a 0/1 ``label`` unless named otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions.numbers import ratio, to_float
from visitmart.operators.ordered import running_totals
from visitmart.session import materialise

# Hex digits of the order hash that name a piece: 16 ** 4 pieces per class.
_PIECE_DIGITS = 4


def feature_columns(df: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Drop outcome and technical columns, and the row ids unless they are asked for."""
    return df.drop(*S.LEAKAGE_COLUMNS, *([] if keep_ids else S.UNIQUE_ID_COLUMNS))


def target(df: DataFrame, label: str = S.TARGET) -> Column:
    return F.coalesce(to_float(df, label), F.lit(0.0)).cast("int")


def target_classes(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """One row: number of rows and of classes of the label, missing counted as 0."""
    return df.select(target(df, label).alias("_y")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_y").alias("classes")
    )


def check_target(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """``df`` itself, or an error when there is nothing to tell apart."""
    if label not in df.columns:
        raise ValueError(f"target column {label} is missing")
    if target_classes(df, label).first()["classes"] < 2:
        raise ValueError(f"target column {label} has a single class")
    return df


def balanced_weight(df: DataFrame, label: str = S.TARGET, name: str = "weight") -> DataFrame:
    """Weight n / (2 n_c), so that both classes weigh the same."""
    sizes = df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positive")).alias("s")
    ).scalar()
    out = df.withColumn("_s", sizes)
    of_class = F.when(F.col(label) == 1, F.col("_s.positive")).otherwise(F.col("_s.n") - F.col("_s.positive"))
    weight = F.col("_s.n").cast("double") / (F.lit(2.0) * of_class)
    return out.withColumn(name, weight).drop("_s")


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    parts: dict[str, int],
    seed: int = 42,
) -> DataFrame:
    """Add ``part``: each class is divided by the given percentages, in order of sha256(key|seed).

    ``key`` identifies a row; rows with the same key stay together. No row is moved:
    the classes' hashes are counted by their first digits, only the pieces in which
    a boundary falls are ordered, and the boundary hashes label every row.
    """
    if sum(parts.values()) != 100:
        raise ValueError("the percentages must add up to 100")
    names = list(parts)
    shares = [sum(list(parts.values())[: i + 1]) for i in range(len(names) - 1)]
    hashed = df.withColumn("_h", F.sha2(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")), 256))
    # Read twice below, so evaluated once.
    narrow = materialise(
        hashed.select(F.col(label).alias("_c"), "_h", F.substring("_h", 1, _PIECE_DIGITS).alias("_piece"))
    )

    def quota(share: int) -> Column:
        """Rows of the class up to this boundary."""
        return F.floor(F.col("_total") * F.lit(share) / F.lit(100.0) + F.lit(0.5))

    up_to = Window.partitionBy("_c").orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        narrow.groupBy("_c", "_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(up_to), "_total": F.sum("_n").over(Window.partitionBy("_c"))})
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )
    holds = {
        f"_holds{i}": (F.col("_before") < quota(share)) & (quota(share) <= F.col("_upto"))
        for i, share in enumerate(shares)
    }
    # At most one piece per boundary and class.
    crossed = pieces.withColumns(holds).where(" OR ".join(holds)).drop("_n", "_upto")

    flags = ["_c", "_piece", "_before", "_total", *holds]
    held = crossed.withColumnsRenamed({"_c": "_class", "_piece": "_at"})
    # Rows without a label are a class of their own.
    inside = narrow["_c"].eqNullSafe(held["_class"]) & (narrow["_piece"] == held["_at"])
    counts = narrow.join(F.broadcast(held), inside).groupBy(*flags, "_h").agg(F.count(F.lit(1)).alias("_n"))
    walk = Window.partitionBy("_c", "_piece").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    walked = counts.withColumn("_rank", F.col("_before") + F.sum("_n").over(walk))
    limits = walked.groupBy("_c").agg(
        *[
            expression
            for i, share in enumerate(shares)
            for expression in (
                F.max(F.when(F.col(f"_holds{i}") & (F.col("_rank") <= quota(share)), F.col("_h"))).alias(f"_inside{i}"),
                F.min(F.when(F.col(f"_holds{i}") & (F.col("_rank") > quota(share)), F.col("_h"))).alias(f"_outside{i}"),
            )
        ]
    )
    # One row per class.
    out = hashed.join(F.broadcast(limits), hashed[label].eqNullSafe(limits["_c"]), "left")
    part = F.lit(names[-1])
    for i in reversed(range(len(shares))):
        within = F.coalesce(F.col("_h") < F.col(f"_outside{i}"), F.col("_h") <= F.col(f"_inside{i}"))
        part = F.when(within, F.lit(names[i])).otherwise(part)
    drop = ["_h", "_c", *[f"_{side}{i}" for i in range(len(shares)) for side in ("inside", "outside")]]
    return out.withColumn("part", part).drop(*drop)


def score_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score, counting that score and every higher one as predicted positive."""
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("tp"),
        F.sum(F.lit(1) - F.col(label).cast("long")).alias("fp"),
    )
    totals = running_totals(per_score, "threshold", ["tp", "fp"], descending=True)
    return totals.select(
        "threshold",
        F.col("tp").alias("positives_here"),
        F.col("fp").alias("negatives_here"),
        F.col("tp_upto").alias("tp"),
        F.col("fp_upto").alias("fp"),
        F.col("tp_total").alias("positives"),
        F.col("fp_total").alias("negatives"),
    )


def pr_curve(curve: DataFrame) -> DataFrame:
    """Precision, recall and F1 at every distinct score."""
    precision = ratio("tp", "tp + fp")
    recall = ratio("tp", "positives")
    f1 = F.lit(2.0) * precision * recall / F.greatest(precision + recall, F.lit(1e-12))
    return curve.select("threshold", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def roc_curve(curve: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct score."""
    return curve.select(
        "threshold",
        ratio("fp", "negatives").alias("fpr"),
        ratio("tp", "positives").alias("tpr"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The score with the greatest F1; among equals the lowest score, which comes first in ascending order."""
    best = pr_curve(curve).agg(F.max(F.struct("f1", (-F.col("threshold")).alias("minus"))).alias("best"))
    return best.select((-F.col("best.minus")).alias("threshold"), F.col("best.f1").alias("f1"))


def ranking_quality(curve: DataFrame) -> DataFrame:
    """ROC-AUC, average precision (step sum) and trapezoid PR-AUC in one pass over the curve.

    Each row knows the counts before it, so the trapezoids need no neighbour.
    """
    here, there = F.col("positives_here"), F.col("negatives_here")
    tp_before, fp_before = F.col("tp") - here, F.col("fp") - there
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    seen_before = tp_before + fp_before
    precision_before = F.when(seen_before == 0, F.lit(1.0)).otherwise(
        tp_before.cast("double") / F.nullif(seen_before.cast("double"), F.lit(0.0))
    )
    step = here.cast("double") / F.col("positives")
    area = there.cast("double") * (tp_before.cast("double") + here.cast("double") / F.lit(2.0))
    return curve.agg(
        (F.sum(area) / F.max(F.col("positives").cast("double") * F.col("negatives"))).alias("roc_auc"),
        F.sum(step * precision).alias("average_precision"),
        F.sum(step * (precision + precision_before) / F.lit(2.0)).alias("pr_auc_trapezoid"),
    )


def classification_metrics(
    df: DataFrame, threshold: float | Column, score: str = "score", label: str = "label"
) -> DataFrame:
    """Confusion matrix and the usual ratios at one threshold; a ratio without cases is 0."""
    predicted = F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    actual = F.col(label) == 1
    counts = df.agg(
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(predicted & actual).alias("tp"),
    )
    return with_ratios(counts)


def with_ratios(counts: DataFrame) -> DataFrame:
    out = counts.withColumns(
        {
            "accuracy": ratio("tp + tn", "tn + fp + fn + tp"),
            "precision": ratio("tp", "tp + fp"),
            "recall": ratio("tp", "tp + fn"),
        }
    )
    return out.withColumn("f1", _f1())


def _f1() -> Column:
    return ratio("2D * precision * recall", "precision + recall")


def threshold_sweep(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision, recall and F1 at .05, .10 … .95, from one pass over the rows."""
    steps = [F.lit(0.05) + F.lit(float(i)) * F.lit(0.05) for i in range(19)]
    actual = F.col(label) == 1
    counts = df.agg(
        F.count_if(actual).alias("positives"),
        *[F.count_if((F.col(score) >= step) & actual).alias(f"tp{i}") for i, step in enumerate(steps)],
        *[F.count_if((F.col(score) >= step) & ~actual).alias(f"fp{i}") for i, step in enumerate(steps)],
    )
    rows = [
        F.struct(step.alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, step in enumerate(steps)
    ]
    out = counts.select("positives", F.inline(F.array(*rows)))
    out = out.withColumns(
        {
            "precision": ratio("tp", "tp + fp"),
            "recall": ratio("tp", "positives"),
        }
    )
    return out.select("threshold", "precision", "recall", _f1().alias("f1"))
