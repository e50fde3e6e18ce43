"""Reconciliation of a source and a target table in five layers, each a lazy DataFrame query.

1 row counts, 2 rows per date, 3 null counts and least and greatest values, 4 sums of numbers per date, 5 a sample of
rows by key.  `reconcile` runs one aggregate of each side for layers 1 and 3, one grouped aggregate of each side for
layers 2 and 4, and one join for layer 5.  Dates join null-safely in full, so that dates on one side only, and null
dates, are seen; differences are counted in full, only the details of a report are cut.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as kinds
from ..functions.values import comparable
from ..plans.model import TableReport

#: Decimal digits that sums of doubles and floats keep, so that they don't depend on the order of addition; a decimal
#: column keeps its own.
SCALE = 2
#: Details in a report.
DATE_DETAILS, SUM_DETAILS, ROW_DETAILS = 25, 30, 20


def q(name: str) -> str:
    return f"`{name}`"


def row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """source_value, target_value, passed."""
    s, t = (df.agg(F.count(F.lit(1)).alias(n)) for df, n in ((source, "source_value"), (target, "target_value")))
    return s.crossJoin(t).withColumn("passed", F.col("source_value") == F.col("target_value"))


def counts_by_date(df: DataFrame, date: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """d, n; optionally of the half-open range [low, high)."""
    if low is not None:
        df = df.where(F.col(q(date)) >= F.lit(low).cast(df.schema[date].dataType))
    if high is not None:
        df = df.where(F.col(q(date)) < F.lit(high).cast(df.schema[date].dataType))
    return df.groupBy(F.col(q(date)).cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))


def partition_counts(source: DataFrame, target: DataFrame, date: str) -> DataFrame:
    """Dates whose counts differ: d, src, tgt, delta."""
    a, b = counts_by_date(source, date).alias("a"), counts_by_date(target, date).alias("b")
    src, tgt = F.coalesce(F.col("a.n"), F.lit(0)), F.coalesce(F.col("b.n"), F.lit(0))
    return (
        a.join(b, F.col("a.d").eqNullSafe(F.col("b.d")), "full_outer")
        .where(src != tgt)
        .select(
            F.coalesce("a.d", "b.d").alias("d"), src.alias("src"), tgt.alias("tgt"), F.abs(src - tgt).alias("delta")
        )
    )


def _long(wide: DataFrame, columns: Sequence[str], values: dict[str, list]) -> DataFrame:
    """One row per column from one wide row: col and the named values."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("col"), *[values[v][i].alias(v) for v in values]) for i, c in enumerate(columns)]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def null_counts(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """col, src, tgt, passed for each column."""

    def nulls(df: DataFrame, side: str) -> DataFrame:
        return df.agg(*[F.count_if(F.col(q(c)).isNull()).alias(f"{side}{i}") for i, c in enumerate(columns)])

    if not columns:
        return source.sparkSession.createDataFrame([], "col string, src long, tgt long, passed boolean")
    sides = {k: [F.col(f"{k[0]}{i}") for i in range(len(columns))] for k in ("src", "tgt")}
    wide = nulls(source, "s").crossJoin(nulls(target, "t"))
    return _long(wide, columns, sides).withColumn("passed", F.col("src") == F.col("tgt"))


def min_max(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """col, src_min, tgt_min, src_max, tgt_max (as text), passed for each column; compared as typed values."""

    def ends(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            *[f(F.col(q(c))).alias(f"{side}{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.min), ("x", F.max))]
        )

    names = ("src_min", "tgt_min", "src_max", "tgt_max")
    if not columns:
        schema = ", ".join(f"{n} string" for n in ("col", *names)) + ", passed boolean"
        return source.sparkSession.createDataFrame([], schema)
    short = dict(zip(names, ("sn", "tn", "sx", "tx"), strict=True))
    values = {n: [F.col(f"{short[n]}{i}").cast("string") for i in range(len(columns))] for n in names}
    values["passed"] = [
        F.col(f"sn{i}").eqNullSafe(F.col(f"tn{i}")) & F.col(f"sx{i}").eqNullSafe(F.col(f"tx{i}"))
        for i in range(len(columns))
    ]
    return _long(ends(source, "s").crossJoin(ends(target, "t")), columns, values)


def sum_scale(df: DataFrame, column: str, scale: int = SCALE) -> int:
    """Digits that the sum of a column keeps: its own, or `scale` for doubles and floats."""
    kind = df.schema[column].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else 0 if isinstance(kind, T.IntegralType) else scale


def exact_sum(df: DataFrame, column: str, scale: int = SCALE) -> Column:
    scale = sum_scale(df, column, scale)
    return F.sum(F.col(q(column)).cast(f"decimal(28,{scale})" if scale <= 10 else f"decimal(38,{scale})")).cast(
        f"decimal(38,{scale})"
    )


def sums_by_date(df: DataFrame, date: str, columns: Sequence[str], scale: int = SCALE) -> DataFrame:
    """d, n and one exact sum per column."""
    sums = [exact_sum(df, c, scale).alias(c) for c in columns]
    return df.groupBy(F.col(q(date)).cast("date").alias("d")).agg(F.count(F.lit(1)).alias("#n"), *sums)


def by_date(source: DataFrame, target: DataFrame, date: str, columns: Sequence[str], scale: int = SCALE) -> DataFrame:
    """d, src and tgt (counts), sums: those that differ, as structs of col, src, tgt; one row per date."""
    a, b = (sums_by_date(df, date, columns, scale).alias(n) for df, n in ((source, "a"), (target, "b")))
    # sums of several scales are shown as text
    widest = "string" if len({sum_scale(df, c, scale) for df in (source, target) for c in columns}) > 1 else None
    sums = []
    for c in columns:
        x, y = F.col(f"a.{q(c)}"), F.col(f"b.{q(c)}")
        shown = [v.cast(widest) if widest else v for v in (x, y)]
        sums.append(
            F.when(
                ~x.eqNullSafe(y), F.struct(F.lit(c).alias("col"), shown[0].alias("src"), shown[1].alias("tgt"))
            )
        )
    differing = F.array_compact(F.array(*sums)) if sums else F.lit(None).cast("array<struct<col:string>>")
    return a.join(b, F.col("a.d").eqNullSafe(F.col("b.d")), "full_outer").select(
        F.coalesce("a.d", "b.d").alias("d"),
        F.coalesce("a.`#n`", F.lit(0)).alias("src"),
        F.coalesce("b.`#n`", F.lit(0)).alias("tgt"),
        differing.alias("sums"),
    )


def aggregate_fingerprint(
    source: DataFrame, target: DataFrame, date: str, columns: Sequence[str], scale: int = SCALE
) -> DataFrame:
    """Sums that differ: d, col, src, tgt.  A date that is missing counts as null, like a date of nulls."""
    found = by_date(source, target, date, columns, scale)
    return found.select("d", F.explode("sums").alias("s")).select("d", "s.*")


def sampled(source: DataFrame, keys: Sequence[str], size: int, seed: int | None = None) -> DataFrame:
    """Rows to compare: the first by key, or by a seeded hash of the key."""
    order = [F.xxhash64(F.lit(seed), *[F.col(q(k)) for k in keys])] if seed is not None else []
    return source.orderBy(*order, *[F.col(q(k)) for k in keys]).limit(size)


def row_sample(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    size: int = 1000,
    columns: Sequence[str] | None = None,
    strict_text: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """Sampled rows that the target lacks or holds with other values: the keys, kind (missing, mismatch), differing.

    The target's rows are cut to the sample's keys before duplicates of a key are resolved (greatest values first).
    """
    columns = [c for c in (columns or source.columns) if c not in keys and c in target.columns]
    sample = sampled(source, keys, size, seed).select(*[q(c) for c in [*keys, *columns]])
    rank = Window.partitionBy(*[q(k) for k in keys]).orderBy(*[F.col(q(c)).desc_nulls_last() for c in columns])
    others = target.select(*[q(c) for c in [*keys, *columns]]).join(sample.select(*keys), list(keys), "left_semi")
    if columns:
        others = others.withColumn("rank", F.row_number().over(rank)).where("rank = 1").drop("rank")
    else:
        others = others.distinct()
    s, t = sample.alias("s"), others.withColumn("found", F.lit(True)).alias("t")
    on = [F.col(f"s.{q(k)}") == F.col(f"t.{q(k)}") for k in keys]
    differ = [
        F.when(
            ~comparable(F.col(f"s.{q(c)}"), strict_text).eqNullSafe(comparable(F.col(f"t.{q(c)}"), strict_text)),
            F.lit(c),
        )
        for c in columns
    ]
    differing = F.array_compact(F.array(*differ)) if differ else F.array().cast("array<string>")
    return (
        s.join(t, on, "left")
        .select(
            *[F.col(f"s.{q(k)}").alias(k) for k in keys],
            F.when(F.col("t.found").isNull(), "missing").otherwise("mismatch").alias("kind"),
            F.when(F.col("t.found").isNotNull(), differing).otherwise(F.array().cast("array<string>")).alias("differing"),
        )
        .where((F.col("kind") == "missing") | (F.size("differing") > 0))
    )


def multiset_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows that one side has more often, with side and n: the exhaustive check, which needs no key."""
    columns = [c for c in source.columns if c in target.columns]
    counted = source.select(columns).withColumn("w", F.lit(1)).unionByName(
        target.select(columns).withColumn("w", F.lit(-1))
    )
    surplus = counted.groupBy(*[q(c) for c in columns]).agg(F.sum("w").alias("w")).where("w <> 0")
    side = F.when(F.col("w") > 0, "source").otherwise("target")
    return surplus.withColumn("side", side).withColumn("n", F.abs("w")).drop("w")


def date_chunks(df: DataFrame, date: str) -> DataFrame:
    """Months from the first to the last date: low (first of the month), high (first of the next one)."""
    span = df.agg(F.min(q(date)).cast("date").alias("a"), F.max(q(date)).cast("date").alias("b"))
    months = F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))
    return (
        span.where("a is not null")
        .select(F.explode(months).alias("low"))
        .select("low", F.add_months("low", 1).alias("high"))
    )


def reconcile(
    source: DataFrame,
    target: DataFrame,
    table: str,
    keys: Sequence[str] = (),
    sample_size: int = 0,
    strict_text: bool = False,
) -> TableReport:
    """All layers that apply to a table: every column, every date."""
    began = time.time()
    out = TableReport(table)
    by_name = {c.lower(): c for c in target.columns}
    columns = [c for c in kinds.columns_of(source.schema) if c.name in by_name]
    source = source.toDF(*[c.lower() for c in source.columns])
    target = target.toDF(*[c.lower() for c in target.columns])
    if not columns:
        return out.add("schema_check", False, "no columns in common").close(began)
    names = [c.name for c in columns]
    flat = [n for n in names if not isinstance(source.schema[n].dataType, (T.ArrayType, T.MapType, T.StructType))]
    date = kinds.detect_date_column(columns)
    numbers = kinds.numeric_columns(columns) if date else []
    _overall(out, source, target, names, kinds.min_max_columns(columns))
    if date:
        _by_date(out, by_date(source, target, date, numbers), bool(numbers))
    if sample_size and not keys:
        out.add("row_sample", None, "skipped: the table has no key")
    elif sample_size:
        keys = [k.lower() for k in keys]
        _rows(out, row_sample(source, target, keys, sample_size, flat, strict_text), keys)
    return out.close(began)


def _overall(out: TableReport, source: DataFrame, target: DataFrame, names: Sequence[str], ends: Sequence[str]) -> None:
    """Layers 1 and 3 from one row of aggregates of each side."""

    def wide(df: DataFrame, side: str) -> DataFrame:
        nulls = [F.count_if(F.col(q(c)).isNull()).alias(f"{side}z{i}") for i, c in enumerate(names)]
        least = [F.min(q(c)).alias(f"{side}n{i}") for i, c in enumerate(ends)]
        most = [F.max(q(c)).alias(f"{side}x{i}") for i, c in enumerate(ends)]
        return df.agg(F.count(F.lit(1)).alias(f"{side}c"), *nulls, *least, *most)

    same = [
        F.col(f"sn{i}").eqNullSafe(F.col(f"tn{i}")) & F.col(f"sx{i}").eqNullSafe(F.col(f"tx{i}"))
        for i in range(len(ends))
    ]
    shown = [F.col(f"{x}{i}").cast("string").alias(f"{x}{i}") for x in ("sn", "sx", "tn", "tx") for i in range(len(ends))]
    counts = [f"{x}z{i}" for x in "st" for i in range(len(names))]
    both = wide(source, "s").crossJoin(wide(target, "t"))
    r = both.select("sc", "tc", *counts, *shown, *(x.alias(f"same{i}") for i, x in enumerate(same))).head()
    out.add("row_count", r["sc"] == r["tc"], f"{r['sc']} and {r['tc']}, difference {abs(r['sc'] - r['tc'])}")
    nulls = [f"{c}: {r[f'sz{i}']} and {r[f'tz{i}']}" for i, c in enumerate(names) if r[f"sz{i}"] != r[f"tz{i}"]]
    out.add("null_counts", not nulls, f"{len(nulls)} of {len(names)} columns differ", nulls)
    if ends:
        off = [
            f"{c}: {r[f'sn{i}']} to {r[f'sx{i}']} and {r[f'tn{i}']} to {r[f'tx{i}']}"
            for i, c in enumerate(ends)
            if not r[f"same{i}"]
        ]
        out.add("min_max_values", not off, f"{len(off)} of {len(ends)} columns differ", off)


def _first(diff: DataFrame, order: Sequence[Column | str], rows: int, **totals: Column) -> tuple[list, dict[str, int]]:
    """The first rows of a difference and totals over all of it, from one pass."""
    seen = Observation()
    found = diff.observe(seen, *(x.alias(n) for n, x in totals.items())).orderBy(*order).limit(rows).collect()
    return found, {n: seen.get.get(n) or 0 for n in totals}


def _by_date(out: TableReport, dates: DataFrame, summed: bool) -> None:
    """Layers 2 and 4 from one row per date."""
    uneven = F.col("src") != F.col("tgt")
    diff = dates.where(uneven | (F.size("sums") > 0))
    rows, n = _first(
        diff,
        [F.col("d").asc_nulls_first()],
        DATE_DETAILS + SUM_DETAILS,
        dates=F.count_if(uneven),
        sums=F.sum(F.greatest(F.size("sums"), F.lit(0))),
    )
    counts = [f"{r['d']}: {r['src']} and {r['tgt']}" for r in rows if r["src"] != r["tgt"]]
    out.add("partition_counts", n["dates"] == 0, f"{n['dates']} dates differ", counts[:DATE_DETAILS])
    if summed:
        sums = [f"{r['d']} {x['col']}: {x['src']} and {x['tgt']}" for r in rows for x in r["sums"]]
        out.add("aggregate_fingerprint", n["sums"] == 0, f"{n['sums']} sums differ", sums[:SUM_DETAILS])


def _rows(out: TableReport, diff: DataFrame, keys: Sequence[str]) -> None:
    kind = F.col("kind")
    rows, n = _first(
        diff,
        [q(k) for k in keys],
        ROW_DETAILS,
        missing=F.count_if(kind == "missing"),
        mismatch=F.count_if(kind == "mismatch"),
    )
    details = [
        ", ".join(f"{k}={r[k]}" for k in keys) + f": {r['kind']} {', '.join(r['differing'])}".rstrip() for r in rows
    ]
    out.add("row_sample", not any(n.values()), f"{n['missing']} missing, {n['mismatch']} with other values", details)
