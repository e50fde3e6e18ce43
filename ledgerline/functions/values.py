"""Value rules of transfers and comparisons, as column expressions."""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_nul(df: DataFrame) -> DataFrame:
    """Without the characters that the target can't store; null stays null and '' stays ''."""
    strings = {
        f.name: F.translate(F.col(f"`{f.name}`"), "\0", "") for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(strings) if strings else df


def as_strings(df: DataFrame) -> DataFrame:
    """Every column cast to a string, as a transfer that types in the target reads them."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def comparable(column: Column, strict_text: bool = False) -> Column:
    """What two values are compared by: themselves (null-safe), or their trimmed text where strict_text is set."""
    if not strict_text:
        return column
    return F.coalesce(F.trim(column.cast("string")), F.lit("NULL"))


def decimal_text(value: object) -> str:
    """A number's canonical text: equal decimals of different scale give one text; null gives NULL."""
    if value is None:
        return "NULL"
    try:
        return str(Decimal(str(value)).normalize())
    except InvalidOperation:
        return str(value)


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Boundaries of a unit crossed between two times (not completed units): truncate both, then subtract."""
    unit = unit.lower().rstrip("s")
    a, b = F.date_trunc(unit, start), F.date_trunc(unit, end)
    if unit in ("month", "quarter", "year"):
        months = F.round(F.months_between(b, a)).cast("bigint")
        return months if unit == "month" else F.round(months / {"quarter": 3, "year": 12}[unit]).cast("bigint")
    return F.timestamp_diff(unit.upper(), a, b)
