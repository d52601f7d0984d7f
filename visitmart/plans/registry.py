"""The queries the package offers for checking, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.functions.numbers import round_even

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round double columns, since sums of doubles depend on the order of addition."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({name: round_even(F.col(name), digits) for name in names}) if names else df
