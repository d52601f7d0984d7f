"""The two risk formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.functions.numbers import float_sql

# Weight, column, value that counts as 1.
CLINICAL = [
    (0.2, "age_years", 100.0),
    (0.2, "los", 30.0),
    (0.3, "LACE_Score", 19.0),
    (0.2, "chronic_conditions", 15.0),
]
REVISIT_WEIGHT = 0.1
LIVE = [
    (0.35, "LACE_Score", 19.0),
    (0.2, "los", 30.0),
    (0.2, "chronic_conditions", 15.0),
    (0.25, "age", 100.0),
]


def _weighted(df: DataFrame, terms: list[tuple[float, str, float]]) -> str:
    return " + ".join(
        f"{weight}D * greatest(0D, least(1D, coalesce({float_sql(df, name)}, 0D) / {scale}D))"
        for weight, name, scale in terms
    )


def risk_score(df: DataFrame) -> Column:
    """Clinical score of the doctor mart."""
    revisit = f"CAST(coalesce({float_sql(df, 'unitvisitnumber')}, 1D) > 1D AS DOUBLE)"
    return F.expr(f"greatest(0D, least(1D, {_weighted(df, CLINICAL)} + {REVISIT_WEIGHT}D * {revisit}))")


def risk_score_live(df: DataFrame) -> Column:
    """Score computed on the final dataset."""
    return F.expr(f"greatest(0D, least(1D, {_weighted(df, LIVE)}))")
