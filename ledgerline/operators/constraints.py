"""Constraints verified by queries, and found in catalogs that are given as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has: the keys and n.  Rows with a null in the key are no duplicates."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, refers: Sequence[str]) -> DataFrame:
    """Rows of the child whose key is complete and in no row of the parent."""
    names = [f"__p{i}" for i in range(len(refers))]
    keys = parent.select(*[F.col(r).alias(n) for r, n in zip(refers, names, strict=True)])
    on = [F.col(c) == F.col(n) for c, n in zip(columns, names, strict=True)]
    return child.dropna(subset=list(columns)).join(keys, on, "left_anti")


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """col, n of the columns that hold nulls."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"n{i}").alias("n")) for i, c in enumerate(columns)])
    return wide.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def keys_found(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Primary and unique keys of a catalog: table_name, constraint_name, constraint_type, columns in order.

    constraints: constraint_schema, table_name, constraint_name, constraint_type; usage: constraint_schema, table_name,
    constraint_name, column_name, ordinal_position.
    """
    keys = ["constraint_schema", "table_name", "constraint_name"]
    wanted = constraints.where(F.col("constraint_type").isin("PRIMARY KEY", "UNIQUE"))
    ordered = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name")))
    return (
        wanted.join(usage, keys)
        .groupBy("table_name", "constraint_name", "constraint_type")
        .agg(F.transform(ordered, lambda x: F.lower(x["column_name"])).alias("columns"))
    )


def references_found(references: DataFrame, usage: DataFrame) -> DataFrame:
    """Foreign keys of a catalog, a row per pair of columns, paired by their place in the key.

    references: constraint_name, unique_constraint_name; usage: constraint_name, table_name, column_name,
    ordinal_position.
    """
    own = usage.select(
        "constraint_name", "table_name", F.lower("column_name").alias("column_name"), "ordinal_position"
    )
    other = usage.select(
        F.col("constraint_name").alias("unique_constraint_name"),
        F.col("table_name").alias("referenced_table"),
        F.lower("column_name").alias("referenced_column"),
        "ordinal_position",
    )
    return references.join(own, "constraint_name").join(other, ["unique_constraint_name", "ordinal_position"])
