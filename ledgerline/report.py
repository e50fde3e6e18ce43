"""Reports: discovery as JSON and text, check results and transfers as DataFrames and text, DDL files."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.dialect import Translation
from .plans.model import Schema, TableReport

SHOWN_COLUMNS, SHOWN_DETAILS = 10, 10


def schema_json(schema: Schema) -> str:
    tables = [
        {
            "name": t.name,
            "row_count": t.row_count,
            "columns": [{"name": c.name, "type": c.data_type, "nullable": c.is_nullable} for c in t.columns],
        }
        for t in schema.tables
    ]
    return json.dumps({"schema": schema.name, "database": schema.database, "tables": tables}, indent=2)


def schema_text(schema: Schema) -> str:
    lines = [f"schema {schema.name}: {len(schema.tables)} tables, {len(schema.views)} views"]
    for t in schema.tables:
        lines.append(f"  {t.name} ({t.row_count if t.row_count is not None else '?'} rows)")
        lines += [
            f"    {c.name} {c.data_type}{'' if c.is_nullable else ' not null'}" for c in t.columns[:SHOWN_COLUMNS]
        ]
        if len(t.columns) > SHOWN_COLUMNS:
            lines.append(f"    and {len(t.columns) - SHOWN_COLUMNS} more columns")
    return "\n".join(lines)


def checks_frame(spark: SparkSession, validations: Iterable[TableReport]) -> DataFrame:
    rows = [(v.table, c.name, c.passed, c.message, list(c.details)) for v in validations for c in v.checks]
    schema = "table_name string, name string, passed boolean, message string, details array<string>"
    return spark.createDataFrame(rows, schema)


def by_table(checks: DataFrame) -> DataFrame:
    """table_name, checks, failed, passed; a table passes unless a check failed."""
    return checks.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and(F.coalesce("passed", F.lit(True))).alias("passed"),
    )


def summary(checks: DataFrame) -> DataFrame:
    """checks, failed, passed over all tables; nothing to check counts as passed."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.bool_and(F.coalesce("passed", F.lit(True))), F.lit(True)).alias("passed"),
    )


def validation_text(validations: Iterable[TableReport]) -> str:
    lines, run, failed = [], 0, 0
    for v in validations:
        lines.append(f"{'ok' if v.ok else 'FAILED'}  {v.table}  {v.seconds:.1f} s")
        for c in v.checks:
            run += 1
            failed += c.passed is False
            mark = {True: "ok", False: "FAILED", None: "skipped"}[c.passed]
            lines.append(f"  {mark}  {c.name}  {c.message}")
            if c.passed is False:
                lines += [f"    {d}" for d in c.details[:SHOWN_DETAILS]]
    lines.append(f"{run} checks, {failed} failed")
    return "\n".join(lines)


def write_statements(statements: Iterable[str], path: str) -> None:
    Path(path).write_text("".join(f"{s};\n\n" for s in statements if s.strip()))


def write_failed_views(views: Iterable[Translation], errors: dict[str, str], path: str) -> None:
    """The DDL of views that could not be made, each under its error and the schemas that it needs."""
    out = []
    for v in views:
        if v.name in errors:
            needs = ", ".join(v.schemas) or "none"
            out.append(f"-- {v.name}: {errors[v.name]}\n-- other schemas: {needs}\n{v.ddl or '-- no translation'};\n")
    Path(path).write_text("\n".join(out))
