"""Sources and sinks of rows: catalog tables, Parquet folders, CSV with a null marker, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..plans.ddl import quoted

#: Text that stands for null in CSV; an empty field is an empty string.
NULL_MARK = r"\N"


def read_table(spark: SparkSession, schema: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(quoted(schema, name))
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    fetch_size: int = 10_000,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """partition: column, lower bound, upper bound, number of partitions read at once."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)} | ({"driver": driver} if driver else {})
    if partition:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        options |= dict(zip(names, map(str, partition), strict=True))
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, driver: str | None = None, batch_size: int = 10_000, connections: int = 5
) -> None:
    """Append; each partition commits on its own, over as many connections at most."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections)}
    df.write.format("jdbc").options(**options | ({"driver": driver} if driver else {})).mode("append").save()


_CSV = {"nullValue": NULL_MARK, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV, multiLine="true").csv(path)
