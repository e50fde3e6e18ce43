"""DDL for the target: tables in the order of their references, comments, constraints as metadata; and its execution.

Spark's built-in catalog holds no keys, so that constraints travel in the table property `constraints` (JSON) and are
verified by queries (operators/constraints.py).  There are no transactions over DDL: a failed run drops what it made.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from ..functions.types import spark_ddl_type
from .model import Column, Constraint, DdlRun, Schema, Table


def quoted(*parts: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def table_order(tables: Iterable[Table]) -> list[Table]:
    """Referenced tables before those that refer to them; cycles are broken where they are met, outside ones ignored."""
    by_name = {t.name.lower(): t for t in tables}
    done: dict[str, Table] = {}
    open_: set[str] = set()
    for root in by_name:
        stack = [(root, iter(sorted(r.lower() for r in by_name[root].references)))]
        open_.add(root)
        while stack:
            name, rest = stack[-1]
            following = next((r for r in rest if r in by_name and r not in done and r not in open_), None)
            if following is not None:
                open_.add(following)
                stack.append((following, iter(sorted(r.lower() for r in by_name[following].references))))
            else:
                stack.pop()
                done.setdefault(name, by_name[name])
    return list(done.values())


def default_of(column: Column) -> str | None:
    """The default to declare; sequences and clocks of the source are dropped."""
    value = column.default_value
    if value is None or value.upper().startswith(("NEXTVAL", "CURRENT_")):
        return None
    return value


def column_ddl(column: Column) -> str:
    parts = [quoted(column.name.lower()), spark_ddl_type(column)]
    if not column.is_nullable:
        parts.append("NOT NULL")
    if (default := default_of(column)) is not None:
        parts.append(f"DEFAULT {default}")
    if column.comment:
        parts.append(f"COMMENT '{escaped(column.comment)}'")
    return " ".join(parts)


def constraints_of(table: Table) -> list[dict]:
    """Constraints as plain data, for the table property."""

    def plain(c: Constraint) -> dict:
        out = {"name": c.name, "type": c.type.value, "columns": [x.lower() for x in c.columns]}
        if c.referenced_table:
            out |= {"table": c.referenced_table.lower(), "refers": [x.lower() for x in c.referenced_columns]}
        return out

    keys = [table.primary_key] if table.primary_key else []
    out = [plain(c) for c in [*keys, *table.unique_constraints, *table.foreign_keys]]
    if required := [c.name.lower() for c in table.columns if not c.is_nullable]:
        out.append({"name": "not_null", "type": "NOT NULL", "columns": required})
    return out


def table_ddl(table: Table, schema: str, provider: str = "parquet") -> str:
    columns = ",\n  ".join(column_ddl(c) for c in sorted(table.columns, key=lambda c: c.ordinal_position))
    text = f"CREATE TABLE IF NOT EXISTS {quoted(schema, table.name.lower())} (\n  {columns}\n) USING {provider}"
    if table.comment:
        text += f"\nCOMMENT '{escaped(table.comment)}'"
    if rules := constraints_of(table):
        text += f"\nTBLPROPERTIES ('constraints' = '{escaped(json.dumps(rules))}')"
    return text


def schema_ddl(schema: Schema, target: str | None = None) -> list[str]:
    """CREATE SCHEMA, then tables in the order of their references."""
    name = (target or schema.name).lower()
    return [f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}", *(table_ddl(t, name) for t in table_order(schema.tables))]


def drop_schema_ddl(schema: str) -> str:
    return f"DROP SCHEMA IF EXISTS {quoted(schema.lower())} CASCADE"


_MADE = re.compile(r"\s*CREATE\s+(TABLE|VIEW|SCHEMA)\s+IF\s+NOT\s+EXISTS\s+(\S+)", re.IGNORECASE)


def execute_ddl(
    spark: SparkSession,
    statements: Iterable[str],
    stop_on_error: bool = True,
    dry_run: bool = False,
    progress: Callable[[int, int, str], None] | None = None,
) -> DdlRun:
    """Run statements in order.  When a run stops on an error, the tables that it made are dropped again."""
    statements = [s for s in statements if s.strip()]
    began, result, made = time.time(), DdlRun(), []
    for i, statement in enumerate(statements, 1):
        if progress:
            progress(i, len(statements), statement)
        if dry_run:
            result.ran += 1
            continue
        try:
            m = _MADE.match(statement)
            new = m and m[1].upper() == "TABLE" and not spark.catalog.tableExists(m[2].replace("`", ""))
            spark.sql(statement)
            result.ran += 1
            if new:
                made.append(m[2])
        except Exception as e:  # noqa: BLE001  reported, whatever it is
            result.failures.append((statement.splitlines()[0][:120], str(e).splitlines()[0]))
            if stop_on_error:
                for name in reversed(made):
                    spark.sql(f"DROP TABLE IF EXISTS {name}")
                    result.taken_back.append(name)
                break
    result.seconds = time.time() - began
    return result
