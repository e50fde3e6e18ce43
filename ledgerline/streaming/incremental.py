"""Incremental copy: new files of a folder go to the target once each, whatever fails in between."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.values import strip_nul


def copy_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, where: str | None = None, files_at_once: int = 100
) -> int:
    """Append the rows of files that no earlier run has copied; returns their number.

    The file sink's log and the checkpoint make each file count once.
    """
    schema = spark.read.parquet(source).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    rows = rows.where(F.expr(where)) if where else rows
    query = (
        strip_nul(rows)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
