"""Helpers shared by the corpus operators: shared storage, text slabs, literal tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker turns into numpy arrays at once; larger documents form a slab of their own.
SLAB_BYTES = 2_000_000
#: Spark's setting by which an execution drops its shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for the bytes of an Arrow batch.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
            current = spark.sparkContext.getCheckpointDir()
        folder = current
    return folder


def staged(df: DataFrame, tag: str, batch: str | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back; cuts lineage and survives lost executors.

    The shuffle files of the write, which nothing reads once the table stands, are dropped at its end.
    batch: bytes of an Arrow batch in the write, where they shall be fewer than the session's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = {x: spark.conf.get(x) for x in (CLEANUP, BATCH)}
    spark.conf.set(CLEANUP, "true")
    if batch:
        spark.conf.set(BATCH, batch)
    try:
        df.write.parquet(path)
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing still to be computed reads, not even after the loss of an executor."""
    for df in tables:
        if path := getattr(df, "staged_path", None):
            there = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(there, True)


def bounded_broadcast(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """df with a broadcast hint if it has few rows; df must be a staged table with columns of fixed width."""
    return F.broadcast(df) if df.count() <= rows else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def int_array(values: list[int]) -> Column:
    """A constant array of longs, folded by the optimizer."""
    return F.from_json(F.lit(json.dumps([int(v) for v in values])), "array<bigint>")


def slabs(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about `limit` bytes; a longer text is alone in its slice."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.nan_to_num(
            pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float)
        )
        bucket = (np.cumsum(lengths) - lengths) // limit
        cuts = np.concatenate([[0], np.nonzero(np.diff(bucket))[0] + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(int(a), int(b - a))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
