"""Right-closed binning and the rules that name a band."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    edges: tuple[float, ...]
    labels: tuple[str, ...]
    include_lowest: bool = False


# Fixed values.
RISK_BANDS = Bands((-0.001, 0.35, 0.7, 1.0), ("low", "medium", "high"))
LACE_BANDS = Bands((-1.0, 5.0, 10.0, 15.0, 25.0), ("0-5", "6-10", "11-15", "16+"))
AGE_BANDS = Bands(
    (0.0, 30.0, 45.0, 60.0, 75.0, 90.0, 120.0),
    ("0-30", "31-45", "46-60", "61-75", "76-90", "90+"),
    include_lowest=True,
)
INTERVENTIONS = [
    (0.75, "Intensive Care Transition"),
    (0.5, "Enhanced Follow-up"),
    (0.3, "Standard Follow-up"),
]
HIGH_RISK = 0.7


def cut(name: str, bands: Bands) -> Column:
    """The label of the interval (low, high] holding column ``name``; null outside all of them."""
    below = "<" if bands.include_lowest else "<="
    branches = " ".join(
        f"WHEN `{name}` <= {edge}D THEN '{label}'" for edge, label in zip(bands.edges[1:], bands.labels)
    )
    return F.expr(f"CASE WHEN `{name}` {below} {bands.edges[0]}D THEN NULL {branches} END")


def band_table(spark: SparkSession, bands: Bands, name: str) -> DataFrame:
    """The bands with their order, one row each: a table of fixed size."""
    rows = ", ".join(f"({place}, '{label}')" for place, label in enumerate(bands.labels))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS bands(band_order, {name})")


def intervention_bucket(name: str) -> Column:
    branches = " ".join(f"WHEN `{name}` >= {floor}D THEN '{label}'" for floor, label in INTERVENTIONS)
    return F.expr(f"CASE {branches} ELSE 'Routine Monitoring' END")
