"""Copying tables: filters, limits, resumption, several tables at once."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.values import as_strings, strip_nul
from ..plans.ddl import quoted
from ..plans.model import Copied
from ..sources import catalog
from ..sources.checkpoints import Checkpoint
from ..sources.tables import read_table


def resume_bounds(limit: int | None, start: int, done: int) -> tuple[int | None, int]:
    """(rows still wanted, rows to skip) after `start` rows of earlier runs and `done` of this one."""
    skip = start + done
    return (None if not limit else max(0, limit - skip)), skip


def select_rows(
    df: DataFrame,
    where: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    order: Sequence[str] = (),
    text: bool = False,
) -> DataFrame:
    """The rows to copy.  limit counts from the first row of all; order makes limit and offset repeatable."""
    if where:
        df = df.where(F.expr(where))
    if limit or offset:
        if order:
            df = df.orderBy(*[f"`{c}`" for c in order])
        rest, skip = resume_bounds(limit, offset, 0)
        df = df.offset(skip) if skip else df
        df = df if rest is None else df.limit(rest)
    return as_strings(df) if text else strip_nul(df)


def in_batch(df: DataFrame, keys: Sequence[str], batch: int, batches: int) -> DataFrame:
    """The rows of one of several batches: by a hash of the key, or of the whole row where there is no key."""
    if batches == 1:
        return df
    columns = [F.col(f"`{c}`") for c in (keys or df.columns)]
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(batches)) == batch)


def transfer_table(
    spark: SparkSession,
    source_schema: str,
    table: str,
    target_schema: str,
    where: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    mode: str = "append",
    dry_run: bool = False,
    batches: int = 1,
    checkpoint: Checkpoint | None = None,
) -> Copied:
    """Copy one table; errors are reported, not raised.

    Rows are appended; what stands in the target stays.  Each batch is one write, which Spark commits as a whole.  The
    checkpoint remembers how many rows the target had before the transfer and after each batch, so that a batch that
    was committed just before a failure is not written again.  A limit makes one batch of the table.
    """
    began, done, before = time.time(), 0, 0
    try:
        df = read_table(spark, source_schema, table)
        df = df.toDF(*[c.lower() for c in df.columns])
        keys = catalog.primary_key(spark, source_schema, table)
        rows = select_rows(df, where, limit, offset, keys)
        if dry_run:
            return Copied(table, rows.count(), time.time() - began)
        name, batches = quoted(target_schema.lower(), table.lower()), 1 if limit or offset else batches
        first = 0
        if checkpoint:
            there = spark.table(name).count() if spark.catalog.tableExists(name) else 0
            first, before = checkpoint.begin(table, there, batches)
        for batch in range(first, batches):
            seen = Observation()
            part = in_batch(rows, keys, batch, batches).observe(seen, F.count(F.lit(1)).alias("n"))
            if spark.catalog.tableExists(name):
                part.select(*[f"`{c}`" for c in spark.table(name).columns]).write.insertInto(
                    name, overwrite=mode == "overwrite" and batch == 0
                )
            else:
                part.write.mode(mode).saveAsTable(name)
            done += seen.get["n"]
            if checkpoint:
                checkpoint.update(table, batch + 1, before + done)
        return Copied(table, done, time.time() - began, before=before)
    except Exception as e:  # noqa: BLE001  one table's failure must not end the others
        return Copied(table, done, time.time() - began, str(e).splitlines()[0], before)


def transfer_schema(
    spark: SparkSession,
    source_schema: str,
    target_schema: str,
    tables: Iterable[str] | None = None,
    where: str | None = None,
    limit: int | None = None,
    workers: int = 1,
    checkpoint: Checkpoint | None = None,
    mode: str = "append",
    dry_run: bool = False,
    continue_on_error: bool = True,
    status: Callable[[str], None] = lambda _: None,
    batches: int = 1,
) -> list[Copied]:
    """Copy the tables of a schema, `workers` at once, in order of name; tables that a checkpoint has done are left out.

    Tables that are copied at once run in scheduler pools of their own, so that under FAIR scheduling none starves.
    """
    wanted = {t.lower() for t in tables} if tables else None
    names = [t for t in catalog.table_names(spark, source_schema) if wanted is None or t in wanted]
    names = [t for t in names if not (checkpoint and checkpoint.is_completed(t))]
    stopped = False

    def one(name: str) -> Copied:
        nonlocal stopped
        if stopped:
            return Copied(name, 0, 0.0, "not begun: another table failed")
        status(f"copying {name}")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"copy-{name}" if workers > 1 else None)
        found = transfer_table(
            spark, source_schema, name, target_schema, where, limit, 0, mode, dry_run, batches, checkpoint
        )
        if found.ok and checkpoint and not dry_run:
            checkpoint.complete(name)
        status(f"{name}: {found.rows} rows, {found.rate:.0f} a second" if found.ok else f"{name}: {found.error}")
        stopped = stopped or not (found.ok or continue_on_error)
        return found

    if workers <= 1:
        return [one(n) for n in names]
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, names))


def stats_frame(spark: SparkSession, stats: Iterable[Copied]) -> DataFrame:
    rows = [(s.table, s.rows, s.seconds, s.ok, s.error) for s in stats]
    schema = "table_name string, rows_transferred long, transfer_time double, success boolean, error_message string"
    return spark.createDataFrame(rows, schema)


def summarise(stats: DataFrame) -> DataFrame:
    """tables, succeeded, rows, seconds, rows_per_second."""
    seconds = F.coalesce(F.sum("transfer_time"), F.lit(0.0))
    rows = F.coalesce(F.sum("rows_transferred"), F.lit(0))
    return stats.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if("success").alias("succeeded"),
        rows.alias("rows"),
        seconds.alias("seconds"),
        F.when(seconds > 0, rows / seconds).otherwise(0.0).alias("rows_per_second"),
    )
