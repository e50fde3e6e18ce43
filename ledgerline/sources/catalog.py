"""Discovery of schemas from Spark's catalog."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from ..functions.types import columns_of
from ..plans.ddl import quoted
from ..plans.model import Constraint, ConstraintType, Procedure, Schema, Table, View


class SchemaNotFoundError(ValueError):
    pass


def assert_schema_exists(spark: SparkSession, name: str) -> None:
    if not spark.catalog.databaseExists(name):
        known = ", ".join(sorted(d.name for d in spark.catalog.listDatabases()))
        raise SchemaNotFoundError(f"no schema {name}; there are: {known}")


def table_names(spark: SparkSession, schema: str) -> list[str]:
    """Base tables by name, in lower case."""
    found = spark.catalog.listTables(schema)
    return sorted(t.name.lower() for t in found if t.tableType != "VIEW" and not t.isTemporary)


def properties(spark: SparkSession, schema: str, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(schema, table)}").collect()}


def constraints(spark: SparkSession, schema: str, table: str) -> list[Constraint]:
    """Constraints that the table's property `constraints` carries, without NOT NULL."""
    rules = json.loads(properties(spark, schema, table).get("constraints", "[]"))
    kinds = {k.value: k for k in ConstraintType}
    return [
        Constraint(r["name"], kinds[r["type"]], tuple(r["columns"]), r.get("table"), tuple(r.get("refers", ())))
        for r in rules
        if r["type"] in kinds
    ]


def required_columns(spark: SparkSession, schema: str, table: str) -> list[str]:
    rules = json.loads(properties(spark, schema, table).get("constraints", "[]"))
    return [c for r in rules if r["type"] == "NOT NULL" for c in r["columns"]]


def primary_key(spark: SparkSession, schema: str, table: str) -> list[str]:
    """The key's columns; empty where there is none."""
    keys = [c for c in constraints(spark, schema, table) if c.type is ConstraintType.PRIMARY_KEY]
    return list(keys[0].columns) if keys else []


def table(spark: SparkSession, schema: str, name: str, count: bool = True) -> Table:
    df = spark.table(quoted(schema, name))
    rules = constraints(spark, schema, name)
    of = lambda kind: [c for c in rules if c.type is kind]
    keys = of(ConstraintType.PRIMARY_KEY)
    return Table(
        name.lower(),
        schema,
        columns_of(df.schema, required_columns(spark, schema, name)),
        keys[0] if keys else None,
        of(ConstraintType.FOREIGN_KEY),
        of(ConstraintType.UNIQUE),
        spark.catalog.getTable(quoted(schema, name)).description,
        df.count() if count else None,
    )


def views(spark: SparkSession, schema: str, status: Callable[[str], None] = print) -> list[View]:
    out = []
    for r in spark.sql(f"SHOW VIEWS IN {quoted(schema)}").collect():
        if r["isTemporary"]:
            continue
        try:
            ddl = spark.sql(f"SHOW CREATE TABLE {quoted(schema, r['viewName'])}").head()[0]
        except Exception as e:  # noqa: BLE001  a view that can't be shown is listed without its text
            status(f"view {r['viewName']}: {str(e).splitlines()[0]}")
            ddl = None
        out.append(View(r["viewName"].lower(), ddl))
    return sorted(out, key=lambda v: v.name)


def procedures(spark: SparkSession, schema: str) -> list[Procedure]:
    """The schema's own functions, with their descriptions."""
    out = []
    for r in spark.sql(f"SHOW USER FUNCTIONS IN {quoted(schema)}").collect():
        name = r["function"]
        if not re.search(rf"(^|\.){re.escape(schema)}\.", name):
            continue
        lines = [x[0] for x in spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}").collect()]
        out.append(Procedure(name.split(".")[-1].lower(), "\n".join(lines)))
    return sorted(out, key=lambda p: p.name)


def discover(
    spark: SparkSession,
    schema: str,
    tables: Iterable[str] | None = None,
    count: bool = True,
    status: Callable[[str], None] = lambda _: None,
) -> Schema:
    """A schema's tables, views and procedures; with a filter of tables (in any case) only those tables."""
    assert_schema_exists(spark, schema)
    out = Schema(schema, spark.catalog.currentCatalog())
    wanted = {t.lower() for t in tables} if tables else None
    for name in table_names(spark, schema):
        if wanted is None or name in wanted:
            status(f"table {name}")
            out.tables.append(table(spark, schema, name, count))
    if wanted is None:
        out.views = views(spark, schema, status)
        out.procedures = procedures(spark, schema)
    elif not out.tables:
        status(f"no table of {schema} is among {', '.join(sorted(wanted))}")
    return out
