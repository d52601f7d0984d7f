"""Numeric coercion, clipping, rounding and hashing, all as Spark SQL expressions.

Where a rule is easier to read as SQL it is written as SQL text; a ``_sql``
function returns such text, the others return columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

# Fixed pattern: what counts as a number in source text.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def _long_of_double_sql(x: str) -> str:
    return f"CASE WHEN {x} = floor({x}) AND abs({x}) < 9.2e18D THEN try_cast({x} AS BIGINT) END"


def text_to_double_sql(c: str) -> str:
    return f"CASE WHEN {c} RLIKE r'{NUMBER}' THEN try_cast({c} AS DOUBLE) END"


def text_to_long_sql(c: str) -> str:
    """Whole numbers only; ``45.0`` counts, ``45.7`` does not. Long ids keep all their digits."""
    return (
        f"CASE WHEN {c} RLIKE r'{WHOLE}' THEN try_cast({c} AS BIGINT) "
        f"WHEN {c} RLIKE r'{NUMBER}' THEN {_long_of_double_sql(f'try_cast({c} AS DOUBLE)')} END"
    )


def float_sql(df: DataFrame, name: str) -> str:
    """Column ``name`` as double; a missing column counts as all missing, NaN as missing."""
    if name not in df.columns:
        return "CAST(NULL AS DOUBLE)"
    kind, quoted = df.schema[name].dataType, f"`{name}`"
    if isinstance(kind, (DoubleType, FloatType)):
        return f"CASE WHEN NOT isnan({quoted}) THEN CAST({quoted} AS DOUBLE) END"
    if isinstance(kind, IntegralType):
        return f"CAST({quoted} AS DOUBLE)"
    return text_to_double_sql(f"CAST({quoted} AS STRING)")


def int_sql(df: DataFrame, name: str) -> str:
    """Column ``name`` as long; a missing column counts as all missing."""
    if name not in df.columns:
        return "CAST(NULL AS BIGINT)"
    kind, quoted = df.schema[name].dataType, f"`{name}`"
    if isinstance(kind, IntegralType):
        return f"CAST({quoted} AS BIGINT)"
    if isinstance(kind, (DoubleType, FloatType)):
        return _long_of_double_sql(f"CAST({quoted} AS DOUBLE)")
    return text_to_long_sql(f"CAST({quoted} AS STRING)")


def to_float(df: DataFrame, name: str) -> Column:
    return F.expr(float_sql(df, name))


def to_int(df: DataFrame, name: str) -> Column:
    return F.expr(int_sql(df, name))


def clip(col: Column, low=None, high=None) -> Column:
    """Keep ``col`` within the bounds; missing stays missing (``least`` alone would skip the null)."""
    bounded = col
    if high is not None:
        bounded = F.least(F.lit(high), bounded)
    if low is not None:
        bounded = F.greatest(F.lit(low), bounded)
    return F.when(col.isNotNull(), bounded)


def round_even_sql(x: str, digits: int = 0) -> str:
    """Half-even rounding of the binary value, which is what numeric Python arrays do."""
    return f"rint({x})" if digits == 0 else f"rint(({x}) * 1e{digits}D) / 1e{digits}D"


def round_even(col: Column, digits: int = 0) -> Column:
    if digits == 0:
        return F.rint(col)
    scale = F.lit(float(10**digits))
    return F.rint(col * scale) / scale


def percent_sql(part: str, whole: str, digits: int | None = 2) -> str:
    """``part / whole * 100``; null where ``whole`` is zero."""
    value = f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0D) * 100D"
    return value if digits is None else round_even_sql(value, digits)


def percent(part: str, whole: str, digits: int | None = 2) -> Column:
    return F.expr(percent_sql(part, whole, digits))


def ratio_sql(part: str, whole: str) -> str:
    """``part / whole``, zero where ``whole`` is zero."""
    return f"coalesce(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0D), 0D)"


def ratio(part: str, whole: str) -> Column:
    return F.expr(ratio_sql(part, whole))


def unit_interval_sql(key: str, salt: str) -> str:
    """A repeatable number in [0, 1] from the first 8 hex digits of sha256(``key|salt``)."""
    digest = f"sha2(concat(coalesce({key}, ''), '|{salt}'), 256)"
    return f"CAST(conv(substring({digest}, 1, 8), 16, 10) AS DOUBLE) / 4294967295D"


def unit_interval(key: str, salt: str) -> Column:
    return F.expr(unit_interval_sql(key, salt))


def record_hash(df: DataFrame, fields: list[str], whole: set[str]) -> Column:
    """sha256 of the fields joined by ``|``; those in ``whole`` are coerced to long first.

    Missing numbers, missing texts and absent columns each have their own token.
    """
    parts: list[str] = []
    for name in fields:
        if name not in df.columns:
            parts.append("''")
        elif name in whole:
            parts.append(f"coalesce(CAST({int_sql(df, name)} AS STRING), '<NA>')")
        else:
            parts.append(f"coalesce(CAST(`{name}` AS STRING), 'None')")
    joined = ", '|', ".join(parts)
    return F.expr(f"sha2(concat({joined}), 256)")


# Fixed value: longer than a packed hash, and no part of any text.
_OTHER = "unhex(repeat('FF', 33))"


def packed_hash_sql(c: str) -> str:
    """A hash text as its 32 bytes, which take half the room in a shuffle; any other text as its own bytes and a mark."""
    own = f"lower(hex(unhex({c}))) = {c}"
    return f"CASE WHEN octet_length({c}) = 64 AND {own} THEN unhex({c}) ELSE concat(CAST({c} AS BINARY), {_OTHER}) END"


def unpacked_hash_sql(c: str) -> str:
    """The text that ``packed_hash_sql`` was given."""
    text = f"CAST(substring({c}, 1, octet_length({c}) - 33) AS STRING)"
    return f"CASE WHEN octet_length({c}) = 32 THEN lower(hex({c})) ELSE {text} END"
