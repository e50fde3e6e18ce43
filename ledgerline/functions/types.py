"""Source types to target types and to Spark types, and the roles that columns play in checks."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import types as T

from ..plans.model import Column

# Source type -> target type.
TYPE_MAP = {
    "NUMBER": "NUMERIC",
    "DECIMAL": "DECIMAL",
    "NUMERIC": "NUMERIC",
    "INT": "INTEGER",
    "INTEGER": "INTEGER",
    "BIGINT": "BIGINT",
    "SMALLINT": "SMALLINT",
    "TINYINT": "SMALLINT",
    "BYTEINT": "SMALLINT",
    "FLOAT": "DOUBLE PRECISION",
    "FLOAT4": "REAL",
    "FLOAT8": "DOUBLE PRECISION",
    "DOUBLE": "DOUBLE PRECISION",
    "DOUBLE PRECISION": "DOUBLE PRECISION",
    "REAL": "REAL",
    "VARCHAR": "VARCHAR",
    "CHAR": "CHAR",
    "CHARACTER": "CHAR",
    "STRING": "TEXT",
    "TEXT": "TEXT",
    "BINARY": "BYTEA",
    "VARBINARY": "BYTEA",
    "DATE": "DATE",
    "DATETIME": "TIMESTAMP",
    "TIME": "TIME",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP_LTZ": "TIMESTAMP WITH TIME ZONE",
    "TIMESTAMP_NTZ": "TIMESTAMP",
    "TIMESTAMP_TZ": "TIMESTAMP WITH TIME ZONE",
    "BOOLEAN": "BOOLEAN",
    "VARIANT": "JSONB",
    "OBJECT": "JSONB",
    "ARRAY": "JSONB",
}
# Types that checks treat as dates, and as numbers.
DATE_TYPES = ("DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "TIMESTAMP_LTZ", "TIMESTAMP_TZ")
NUMERIC_TYPES = (
    "NUMBER",
    "DECIMAL",
    "NUMERIC",
    "INT",
    "INTEGER",
    "BIGINT",
    "SMALLINT",
    "TINYINT",
    "FLOAT",
    "FLOAT4",
    "FLOAT8",
    "DOUBLE",
    "REAL",
)
# Parts of a name that mark the date column to prefer.
DATE_HINTS = ("date", "day", "period", "month", "week", "year")

#: Target type -> Spark SQL type in DDL.
SPARK_DDL = {
    "INTEGER": "INT",
    "BIGINT": "BIGINT",
    "SMALLINT": "SMALLINT",
    "DOUBLE PRECISION": "DOUBLE",
    "REAL": "FLOAT",
    "TEXT": "STRING",
    "BYTEA": "BINARY",
    "DATE": "DATE",
    "TIME": "STRING",
    "TIMESTAMP": "TIMESTAMP_NTZ",
    "TIMESTAMP WITH TIME ZONE": "TIMESTAMP",
    "BOOLEAN": "BOOLEAN",
    "JSONB": "STRING",
}


def map_type(column: Column) -> str:
    """The target type of a source column; unknown types become TEXT."""
    base = TYPE_MAP.get(column.data_type.upper())
    if base is None:
        return "TEXT"
    if base in ("NUMERIC", "DECIMAL") and column.numeric_precision:
        scale = f",{column.numeric_scale}" if column.numeric_scale else ""
        return f"{base}({column.numeric_precision}{scale})"
    if base in ("VARCHAR", "CHAR") and column.character_maximum_length:
        return f"{base}({column.character_maximum_length})"
    return base


def spark_ddl_type(column: Column, json_as_variant: bool = False) -> str:
    """The Spark SQL type of a source column.

    A decimal without precision takes the source's default of (38, 0).  JSON is kept as a string, which every file
    format and JDBC can hold, or as VARIANT on request.
    """
    target = map_type(column)
    if m := re.fullmatch(r"(?:NUMERIC|DECIMAL)(?:\((\d+)(?:,(\d+))?\))?", target):
        return f"DECIMAL({min(38, int(m[1] or 38))},{m[2] or 0})"
    if m := re.fullmatch(r"(VARCHAR|CHAR)(?:\((\d+)\))?", target):
        return target if m[2] else "STRING"
    if target == "JSONB" and json_as_variant:
        return "VARIANT"
    return SPARK_DDL[target]


def source_type(field: T.StructField) -> str:
    """The source type name that a Spark field stands for; a field may carry its own in its metadata."""
    if "source_type" in field.metadata:
        return field.metadata["source_type"]
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        return "NUMBER"
    names = {
        T.LongType: "BIGINT",
        T.IntegerType: "INTEGER",
        T.ShortType: "SMALLINT",
        T.ByteType: "TINYINT",
        T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT4",
        T.StringType: "VARCHAR",
        T.VarcharType: "VARCHAR",
        T.CharType: "CHAR",
        T.BinaryType: "BINARY",
        T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP_LTZ",
        T.TimestampNTZType: "TIMESTAMP_NTZ",
        T.BooleanType: "BOOLEAN",
        T.ArrayType: "ARRAY",
        T.MapType: "OBJECT",
        T.StructType: "OBJECT",
        T.VariantType: "VARIANT",
    }
    return names.get(type(kind), "VARCHAR")


# Metadata keys under which Spark keeps a declared length and a default.
DECLARED_TYPE, DEFAULT = "__CHAR_VARCHAR_TYPE_STRING", "CURRENT_DEFAULT"


def columns_of(schema: T.StructType, required: Iterable[str] = ()) -> list[Column]:
    """Columns as discovery reports them, with declared lengths and defaults; required: columns of NOT NULL rules."""
    required = {c.lower() for c in required}
    out = []
    for i, f in enumerate(schema.fields, 1):
        kind, more = f.dataType, f.metadata
        declared = re.fullmatch(r"(varchar|char)\((\d+)\)", more.get(DECLARED_TYPE, ""))
        out.append(
            Column(
                name=f.name.lower(),
                data_type=declared[1].upper() if declared and "source_type" not in more else source_type(f),
                is_nullable=f.nullable and f.name.lower() not in required,
                default_value=more.get("default", more.get(DEFAULT)),
                character_maximum_length=more.get("char_len")
                or (int(declared[2]) if declared else getattr(kind, "length", None)),
                numeric_precision=getattr(kind, "precision", None),
                numeric_scale=getattr(kind, "scale", None),
                ordinal_position=i,
                comment=more.get("comment"),
            )
        )
    return out


def detect_date_column(columns: list[Column]) -> str | None:
    """The first date column with a telling name, or else the first date column."""
    dates = [c.name for c in columns if c.data_type.upper() in DATE_TYPES]
    return next((n for n in dates if any(h in n.lower() for h in DATE_HINTS)), dates[0] if dates else None)


def numeric_columns(columns: list[Column]) -> list[str]:
    return [c.name for c in columns if c.data_type.upper().split("(")[0] in NUMERIC_TYPES]


def min_max_columns(columns: list[Column]) -> list[str]:
    """Numbers and dates."""
    kinds = {*NUMERIC_TYPES, *DATE_TYPES}
    return [c.name for c in columns if c.data_type.upper().split("(")[0] in kinds]
