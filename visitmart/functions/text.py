"""Text and date cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value.
TIME_OF_DAY = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
DAY_FIRST = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"

# Fixed values, weakest first: a later match replaces an earlier one.
ETHNIC_GROUPS = [
    ("hispanic", "Hispanic"),
    ("asian", "Asian"),
    ("african", "African American"),
    ("black", "African American"),
    ("caucasian", "White"),
    ("white", "White"),
]


def normalize_gender(name: str) -> Column:
    text = f"lower(trim(CAST(`{name}` AS STRING)))"
    return F.expr(
        f"CASE WHEN {text} IN ('male', 'm') THEN 'male' WHEN {text} IN ('female', 'f') THEN 'female' ELSE 'unknown' END"
    )


def normalize_text(name: str) -> Column:
    return F.expr(f"lower(trim(coalesce(CAST(`{name}` AS STRING), '')))")


def sanitize_time(name: str) -> Column:
    text = f"trim(CAST(`{name}` AS STRING))"
    return F.expr(f"CASE WHEN {text} RLIKE '{TIME_OF_DAY}' THEN {text} END")


def parse_day_first(name: str) -> Column:
    """Day-first date text to a zone-free timestamp; anything else is missing.

    The pattern is checked first: a failing parse costs far more than a match.
    """
    text = f"CAST(`{name}` AS STRING)"
    return F.expr(
        f"CASE WHEN {text} RLIKE '{DAY_FIRST}' "
        f"THEN CAST(try_to_timestamp({text}, 'd/M/yyyy') AS TIMESTAMP_NTZ) END"
    )


def utc_date(name: str) -> Column:
    """The UTC calendar date, as text, of a timestamp text."""
    seconds = f"unix_seconds(try_to_timestamp(CAST(`{name}` AS STRING)))"
    return F.expr(f"CAST(date_from_unix_date(CAST(floor({seconds} / 86400) AS INT)) AS STRING)")


def utc_wall_time(name: str) -> Column:
    """A timestamp text as zone-free UTC time."""
    wall = f"CAST(try_to_timestamp(CAST(`{name}` AS STRING)) AS TIMESTAMP_NTZ)"
    return F.expr(f"convert_timezone(current_timezone(), 'UTC', {wall})")


def ethnic_group_sql(text: str) -> str:
    """The strongest matching group. ``caucasian`` contains ``asian``, so order decides."""
    branches = " ".join(
        f"WHEN contains({text}, '{fragment}') THEN '{label}'" for fragment, label in reversed(ETHNIC_GROUPS)
    )
    return f"CASE {branches} ELSE 'Other' END"
