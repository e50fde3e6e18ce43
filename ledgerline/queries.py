"""Queries over the engine's operators on the driver's tables, each with SQL that states the same independently.

Targets are derived from the sources by fixed corruptions: rows lost, doubled, changed, set to null.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import report
from .functions import dialect, values
from .functions import types as kinds
from .operators import checks, constraints, transfer
from .plans.ddl import execute_ddl, schema_ddl, table_order
from .plans.model import Column, Constraint, ConstraintType, Copied, Table
from .sources import catalog
from .sources.checkpoints import Checkpoint

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TGT = """WITH tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT * FROM orders WHERE o_orderkey % 89 = 0 AND o_orderkey % 97 <> 0)
"""


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corrupted(orders: DataFrame) -> DataFrame:
    """Orders with rows lost (97), doubled (89), changed (101) and set to null (103)."""
    key = F.col("o_orderkey")
    left = orders.where(key % 97 != 0)
    changed = left.withColumns(
        {
            "o_totalprice": F.when(key % 101 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderpriority": F.when(key % 103 != 0, F.col("o_orderpriority")),
        }
    )
    return changed.unionByName(left.where(key % 89 == 0))


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf_dir, "orders")
    return orders, corrupted(orders)


# --- layers ---------------------------------------------------------------------------------------------------------


@query(
    TGT + "SELECT s.c AS source_value, t.c AS target_value, s.c = t.c AS passed "
    "FROM (SELECT count(*) c FROM orders) s CROSS JOIN (SELECT count(*) c FROM tgt) t"
)
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_count(*both(spark, sf_dir))


@query(
    TGT
    + """, a AS (SELECT cast(o_orderdate AS date) d, count(*) c FROM orders GROUP BY 1),
     b AS (SELECT cast(o_orderdate AS date) d, count(*) c FROM tgt GROUP BY 1)
SELECT coalesce(a.d, b.d) AS d, coalesce(a.c, 0) AS src, coalesce(b.c, 0) AS tgt,
       abs(coalesce(a.c, 0) - coalesce(b.c, 0)) AS delta
FROM a FULL OUTER JOIN b ON a.d = b.d WHERE coalesce(a.c, 0) <> coalesce(b.c, 0)"""
)
def check_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.partition_counts(*both(spark, sf_dir), "o_orderdate")


@query(
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders
  UNION ALL SELECT o_orderkey, TIMESTAMP '1990-01-01 00:00:00' FROM orders WHERE o_orderkey < 10),
a AS (SELECT cast(o_orderdate AS date) d, count(*) c FROM orders GROUP BY 1),
b AS (SELECT cast(o_orderdate AS date) d, count(*) c FROM t GROUP BY 1)
SELECT coalesce(a.d, b.d) AS d, coalesce(a.c, 0) AS src, coalesce(b.c, 0) AS tgt,
       abs(coalesce(a.c, 0) - coalesce(b.c, 0)) AS delta
FROM a FULL OUTER JOIN b ON a.d IS NOT DISTINCT FROM b.d WHERE coalesce(a.c, 0) <> coalesce(b.c, 0)"""
)
def check_partition_counts_null_and_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null dates and dates that only the target has."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    nulled = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    early = orders.where("o_orderkey < 10").withColumn("o_orderdate", F.expr("timestamp_ntz'1990-01-01 00:00:00'"))
    return checks.partition_counts(orders, nulled.unionByName(early), "o_orderdate")


_ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


@query(
    TGT
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, s.n AS src, t.n AS tgt, s.n = t.n AS passed FROM (SELECT count(*) - count({c}) n FROM orders) s "
        f"CROSS JOIN (SELECT count(*) - count({c}) n FROM tgt) t"
        for c in _ORDERS
    )
)
def check_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_counts(*both(spark, sf_dir), _ORDERS)


@query(
    """WITH t AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  o_custkey, o_orderkey FROM orders) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, a.mn = b.mn AND a.mx = b.mx AS passed FROM (SELECT min({c}) mn, max({c}) mx FROM orders) a "
        f"CROSS JOIN (SELECT min({c}) mn, max({c}) mx FROM t) b"
        for c in ("o_totalprice", "o_custkey", "o_orderkey")
    )
)
def check_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    scaled = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 101 == 0, price * 2).otherwise(price))
    return checks.min_max(orders, scaled, ["o_totalprice", "o_custkey", "o_orderkey"]).select("col", "passed")


@query(
    TGT
    + """, a AS (SELECT cast(o_orderdate AS date) d, cast(sum(cast(o_totalprice AS decimal(28,2))) AS decimal(38,2)) s
  FROM orders GROUP BY 1),
b AS (SELECT cast(o_orderdate AS date) d, cast(sum(cast(o_totalprice AS decimal(28,2))) AS decimal(38,2)) s FROM tgt GROUP BY 1)
SELECT coalesce(a.d, b.d) AS d, 'o_totalprice' AS col, a.s AS src, b.s AS tgt
FROM a FULL OUTER JOIN b ON a.d = b.d WHERE a.s IS DISTINCT FROM b.s"""
)
def check_aggregate_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.aggregate_fingerprint(*both(spark, sf_dir), "o_orderdate", ["o_totalprice"])


def _line_sum(c: str) -> str:
    return f"cast(sum(cast({c} AS decimal(28,2))) AS decimal(38,2)) AS {c}"


@query(
    f"""WITH t AS (SELECT l_shipdate, CASE WHEN l_orderkey % 53 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  l_extendedprice FROM lineitem),
a0 AS (SELECT cast(l_shipdate AS date) d, {_line_sum("l_quantity")}, {_line_sum("l_extendedprice")} FROM lineitem GROUP BY 1),
b0 AS (SELECT cast(l_shipdate AS date) d, {_line_sum("l_quantity")}, {_line_sum("l_extendedprice")} FROM t GROUP BY 1),
a AS (SELECT d, 'l_quantity' col, l_quantity s FROM a0 UNION ALL SELECT d, 'l_extendedprice', l_extendedprice FROM a0),
b AS (SELECT d, 'l_quantity' col, l_quantity s FROM b0 UNION ALL SELECT d, 'l_extendedprice', l_extendedprice FROM b0)
SELECT coalesce(a.d, b.d) AS d, coalesce(a.col, b.col) AS col, a.s AS src, b.s AS tgt
FROM a FULL OUTER JOIN b ON a.d = b.d AND a.col = b.col WHERE a.s IS DISTINCT FROM b.s"""
)
def check_aggregate_fingerprint_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    n = F.col("l_quantity")
    changed = lines.withColumn("l_quantity", F.when(F.col("l_orderkey") % 53 == 0, n + 1).otherwise(n))
    return checks.aggregate_fingerprint(lines, changed, "l_shipdate", ["l_quantity", "l_extendedprice"])


@query(
    TGT
    + """, smp AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000),
tt AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey DESC NULLS LAST, o_orderstatus DESC NULLS LAST,
  o_totalprice DESC NULLS LAST, o_orderdate DESC NULLS LAST, o_orderpriority DESC NULLS LAST) rn FROM tgt)
SELECT smp.o_orderkey, CASE WHEN tt.o_orderkey IS NULL THEN 'missing' ELSE 'mismatch' END AS kind
FROM smp LEFT JOIN tt ON smp.o_orderkey = tt.o_orderkey AND tt.rn = 1
WHERE tt.o_orderkey IS NULL OR smp.o_totalprice IS DISTINCT FROM tt.o_totalprice
   OR smp.o_orderpriority IS DISTINCT FROM tt.o_orderpriority"""
)
def check_row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_sample(*both(spark, sf_dir), ["o_orderkey"], 1000).select("o_orderkey", "kind")


@query(
    TGT
    + """SELECT 'source' AS side, count(*) AS n FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM tgt)
UNION ALL SELECT 'target', count(*) FROM (SELECT * FROM tgt EXCEPT ALL SELECT * FROM orders)"""
)
def check_multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.multiset_diff(*both(spark, sf_dir)).groupBy("side").agg(F.sum("n").alias("n"))


@query(
    """SELECT cast(m AS date) AS low, cast(m + INTERVAL 1 MONTH AS date) AS high FROM (SELECT unnest(generate_series(
  date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)"""
)
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.date_chunks(load(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "SELECT cast(o_orderdate AS date) AS d, count(*) AS n FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-03-01' GROUP BY 1"
)
def partition_counts_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.counts_by_date(load(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "1996-03-01")


@query(
    "SELECT cast(date_trunc('month', o_orderdate) AS date) AS low, cast(o_orderdate AS date) AS d, count(*) AS n "
    "FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2"
)
def partition_counts_every_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by date within every chunk of date_chunks."""
    orders = load(spark, sf_dir, "orders")
    counts, chunks = checks.counts_by_date(orders, "o_orderdate"), checks.date_chunks(orders, "o_orderdate")
    inside = (F.col("d") >= F.col("low")) & (F.col("d") < F.col("high"))
    return counts.join(F.broadcast(chunks), inside).select("low", "d", "n")


_COUNTS = "(SELECT cast(o_orderdate AS date) d, count(*) c FROM {} GROUP BY 1)"
_SUMS = "(SELECT cast(o_orderdate AS date) d, " + ", ".join(
    f"sum(cast({c} AS decimal(28,2))) s{i}" for i, c in enumerate(("o_orderkey", "o_custkey", "o_totalprice"))
) + " FROM {} GROUP BY 1)"
_ENDS = "SELECT " + ", ".join(
    f"min({c}), max({c})" for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
) + " FROM {}"
_NULLS = "SELECT " + ", ".join(f"count(*) - count({c})" for c in _ORDERS) + " FROM {}"


def _same(rows: str) -> str:
    """SQL for: the rows made from orders and from tgt are the same."""
    return (
        f"NOT EXISTS (({rows.format('orders')} EXCEPT {rows.format('tgt')}) UNION ALL "
        f"({rows.format('tgt')} EXCEPT {rows.format('orders')}))"
    )


_CHECKED = {
    "row_count": _same("SELECT count(*) FROM {}"),
    "partition_counts": _same(f"SELECT * FROM {_COUNTS}"),
    "null_counts": _same(_NULLS),
    "min_max_values": _same(_ENDS),
    "aggregate_fingerprint": _same(f"SELECT * FROM {_SUMS}"),
    "row_sample": "NOT EXISTS (SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000) EXCEPT SELECT * FROM tgt)",
}


@query(TGT + " UNION ALL ".join(f"SELECT 'orders' AS table_name, '{k}' AS name, {v} AS passed" for k, v in _CHECKED.items()))
def reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five layers of one table, as the report shows them."""
    found = checks.reconcile(*both(spark, sf_dir), "orders", ["o_orderkey"], sample_size=1000)
    return report.checks_frame(spark, [found]).select("table_name", "name", "passed")


@query(
    """WITH c(table_name, name, passed) AS (VALUES ('a', 'x', true), ('a', 'y', NULL), ('b', 'x', false), ('b', 'y', true),
  ('c', 'x', CAST(NULL AS boolean)))
SELECT table_name, count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed, bool_and(coalesce(passed, true)) AS passed
FROM c GROUP BY table_name"""
)
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("a", "x", True), ("a", "y", None), ("b", "x", False), ("b", "y", True), ("c", "x", None)]
    return report.by_table(spark.createDataFrame(rows, "table_name string, name string, passed boolean"))


_KEY = dict(
    zip(
        TABLES,
        "r_regionkey n_nationkey c_custkey s_suppkey p_partkey o_orderkey l_orderkey event_id doc_id vec_id page_id "
        "item_id doc_id conv_id".split(),
        strict=True,
    )
)


def _lost_rows(name: str) -> None:
    key = _KEY[name]

    def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = load(spark, sf_dir, name)
        return checks.row_count(df, df.where(F.col(key) % 5 != 0))

    query(
        f"SELECT count(*) AS source_value, count(*) FILTER (WHERE {key} % 5 <> 0) AS target_value, "
        f"count(*) = count(*) FILTER (WHERE {key} % 5 <> 0) AS passed FROM {name}",
        f"lost_rows_{name}",
    )(row_counts)


for _t in TABLES:
    _lost_rows(_t)


def _nulled(name: str, columns: list[str]) -> None:
    """A target whose every other column is null in some rows, each column in others."""
    key = _KEY[name]

    def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = load(spark, sf_dir, name)
        some = [F.when(F.col(key) % (i + 2) != 0, F.col(c)).alias(c) if i % 2 else F.col(c) for i, c in enumerate(columns)]
        return checks.null_counts(df, df.select(*some), columns)

    def lost(i: int, c: str) -> str:
        return f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR {key} % {i + 2} = 0)" if i % 2 else ")")

    sql = " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(*) - count({c}) AS src, {lost(i, c)} AS tgt, count(*) - count({c}) = {lost(i, c)} AS passed "
        f"FROM {name}"
        for i, c in enumerate(columns)
    )
    query(sql, f"nulled_columns_{name}")(null_counts)


_nulled("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
_nulled("events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
_nulled("documents", ["doc_id", "text", "lang", "source", "n_chars"])


@query(
    """SELECT col, src_min, tgt_min, src_max, tgt_max, src_min = tgt_min AND src_max = tgt_max AS passed FROM (
  SELECT 'o_orderkey' AS col, CAST(min(o_orderkey) AS VARCHAR) AS src_min, CAST(min(o_orderkey) FILTER (WHERE o_orderkey % 3 > 0)
    AS VARCHAR) AS tgt_min, CAST(max(o_orderkey) AS VARCHAR) AS src_max,
    CAST(max(o_orderkey) FILTER (WHERE o_orderkey % 3 > 0) AS VARCHAR) AS tgt_max FROM orders
  UNION ALL SELECT 'o_orderdate', strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'),
    strftime(min(o_orderdate) FILTER (WHERE o_orderkey % 3 > 0), '%Y-%m-%d %H:%M:%S'),
    strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'),
    strftime(max(o_orderdate) FILTER (WHERE o_orderkey % 3 > 0), '%Y-%m-%d %H:%M:%S') FROM orders)"""
)
def check_min_max_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ends themselves, where the target lacks a third of the rows."""
    orders = load(spark, sf_dir, "orders")
    return checks.min_max(orders, orders.where("o_orderkey % 3 > 0"), ["o_orderkey", "o_orderdate"])


@query(
    """WITH s AS (SELECT cast(o_orderdate AS date) d, o_orderkey k, CAST(o_totalprice AS DECIMAL(14,4)) v FROM orders),
a AS (SELECT d, sum(v) x, sum(CASE WHEN k % 101 = 0 THEN v + 0.0010 ELSE v END) y FROM s GROUP BY 1)
SELECT d, 'v' AS col, CAST(x AS DECIMAL(38,4)) AS src, CAST(y AS DECIMAL(38,4)) AS tgt FROM a WHERE x <> y"""
)
def check_sums_of_own_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences in the third decimal digit of a column with four."""
    rows = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(14,4)").alias("v")
    )
    more = F.when(F.col("o_orderkey") % 101 == 0, F.col("v") + F.lit("0.0010").cast("decimal(5,4)")).otherwise(F.col("v"))
    return checks.aggregate_fingerprint(rows, rows.withColumn("v", more.cast("decimal(14,4)")), "o_orderdate", ["v"])


@query(
    """SELECT 'wide' AS table_name, name, name NOT IN ('min_max_values', 'aggregate_fingerprint') OR
  NOT EXISTS (SELECT * FROM orders WHERE o_orderkey % 101 = 0) AS passed
FROM (VALUES ('row_count'), ('partition_counts'), ('null_counts'), ('min_max_values'), ('aggregate_fingerprint')) AS c(name)"""
)
def reconcile_twelve_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fault in the last of twelve numeric columns."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderdate", "o_orderkey", *((F.col("o_totalprice") + i).alias(f"n{i}") for i in range(11))
    )
    last = F.when(F.col("o_orderkey") % 101 == 0, F.col("n10") * 3).otherwise(F.col("n10"))
    found = checks.reconcile(orders, orders.withColumn("n10", last), "wide")
    return report.checks_frame(spark, [found]).select("table_name", "name", "passed")


@query(
    """WITH smp AS (SELECT * FROM conversations ORDER BY conv_id, turn LIMIT 400)
SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 11 = 0 THEN 'missing' ELSE 'mismatch' END AS kind,
  CASE WHEN (conv_id + turn) % 11 = 0 THEN '' WHEN conv_id % 7 = 0 AND turn % 2 = 0 THEN 'role,text'
       WHEN conv_id % 7 = 0 THEN 'role' ELSE 'text' END AS differing
FROM smp WHERE (conv_id + turn) % 11 = 0 OR conv_id % 7 = 0 OR (turn % 2 = 0 AND conv_id % 5 = 0)"""
    .replace("conv_id % 7 = 0 AND turn % 2 = 0 THEN", "conv_id % 7 = 0 AND turn % 2 = 0 AND conv_id % 5 = 0 THEN")
)
def check_row_sample_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of two columns, and which of the others differ."""
    rows = load(spark, sf_dir, "conversations")
    c, t = F.col("conv_id"), F.col("turn")
    target = rows.where((c + t) % 11 != 0).withColumns(
        {
            "role": F.when(c % 7 == 0, F.lit("nobody")).otherwise(F.col("role")),
            "text": F.when((t % 2 != 0) | (c % 5 != 0), F.col("text")),
        }
    )
    found = checks.row_sample(rows, target, ["conv_id", "turn"], 400)
    return found.withColumn("differing", F.array_join("differing", ","))


@query("SELECT cast(ts AS date) AS d, count(*) AS n FROM events GROUP BY 1")
def counts_by_date_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.counts_by_date(load(spark, sf_dir, "events"), "ts")


# --- transfer -------------------------------------------------------------------------------------------------------


@query("SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")) + " FROM lineitem")
def transfer_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return values.as_strings(lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"))


@query("SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")
def transfer_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.select_rows(load(spark, sf_dir, "orders"), "o_totalprice > 100000 AND o_orderstatus = 'O'")


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 700")
def transfer_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.select_rows(load(spark, sf_dir, "orders"), limit=700, order=["o_orderkey"])


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 200")
def transfer_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transfer of 700 rows that was stopped after 200."""
    return transfer.select_rows(load(spark, sf_dir, "orders"), limit=700, offset=200, order=["o_orderkey"])


@query(
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN c_name ELSE c_name || 'x' END AS t "
    "FROM customer"
)
def null_nul_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null stays null, '' stays '', and the characters that the target can't hold go."""
    k, name = F.col("c_custkey"), F.col("c_name")
    dirty = (
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.lit("\0"))
        .when(k % 4 == 2, name)
        .otherwise(F.concat(F.lit("\0"), name, F.lit("\0x")))
    )
    return values.strip_nul(load(spark, sf_dir, "customer").select("c_custkey", dirty.alias("t")))


@query(
    "SELECT 3 AS tables, 2 AS succeeded, 1500 AS rows, CAST(3 AS DOUBLE) AS seconds, CAST(500 AS DOUBLE) AS rows_per_second"
)
def transfer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = [Copied("a", 1000, 1.5), Copied("b", 500, 0.5), Copied("c", 0, 1.0, "lost")]
    return transfer.summarise(transfer.stats_frame(spark, stats))


def _scratch(spark: SparkSession, run: Callable[[str], DataFrame]) -> DataFrame:
    """The few rows of what `run` finds in schemas of its own, which are dropped again."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    for side in ("src", "tgt"):
        spark.sql(f"CREATE SCHEMA {name}_{side}")
    try:
        found = run(name)
        return spark.createDataFrame(found.collect(), found.schema)
    finally:
        for side in ("src", "tgt"):
            spark.sql(f"DROP SCHEMA IF EXISTS {name}_{side} CASCADE")


_FOUND = "count(*) AS n, count(DISTINCT o_orderkey) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers"


@query(
    f"SELECT {_FOUND} FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 1000 "
    "UNION ALL SELECT -o_orderkey, o_custkey FROM orders WHERE o_orderkey < 100)"
)
def transfer_into_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that stood in the target stay."""

    def run(name: str) -> DataFrame:
        orders = load(spark, sf_dir, "orders")
        orders.write.saveAsTable(f"{name}_src.orders")
        old = orders.where("o_orderkey < 100").withColumn("o_orderkey", -F.col("o_orderkey"))
        old.write.saveAsTable(f"{name}_tgt.orders")
        found = transfer.transfer_schema(spark, f"{name}_src", f"{name}_tgt", where="o_totalprice > 1000")
        assert all(x.ok for x in found), found
        return spark.table(f"{name}_tgt.orders").selectExpr(*_FOUND.split(", "))

    return _scratch(spark, run)


@query(f"SELECT {_FOUND} FROM (SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT -1, 5)")
def transfer_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transfer in five batches that was lost after the third was committed and before it was noted."""

    def run(name: str) -> DataFrame:
        orders = load(spark, sf_dir, "orders")
        orders.write.saveAsTable(f"{name}_src.orders")
        target = f"{name}_tgt.orders"
        orders.limit(1).selectExpr("-1L AS o_orderkey", "5L AS o_custkey", "* EXCEPT (o_orderkey, o_custkey)").write.saveAsTable(target)
        with tempfile.TemporaryDirectory() as folder:
            state = Checkpoint(f"{folder}/state", "src", "tgt")
            state.begin("orders", 1, 5)
            for batch in range(3):
                part = transfer.in_batch(orders, [], batch, 5)
                part.write.insertInto(target)
                if batch < 2:
                    state.update("orders", batch + 1, spark.table(target).count() - 1)
            again = Checkpoint(f"{folder}/state", "src", "tgt")
            found = transfer.transfer_schema(spark, f"{name}_src", f"{name}_tgt", checkpoint=again, batches=5)
            assert [x.ok for x in found] == [True], found
            assert again.is_completed("orders")
        return spark.table(target).selectExpr(*_FOUND.split(", "))

    return _scratch(spark, run)


@query(
    """SELECT * FROM (VALUES (1, 'a', 'INTEGER', false, NULL, NULL, 'the key'), (2, 'v', 'VARCHAR', true, '''x''', 5, NULL),
  (3, 'c', 'CHAR', true, NULL, 3, NULL), (4, 'n', 'NUMBER', true, NULL, NULL, NULL), (5, 't', 'VARCHAR', true, NULL, NULL, NULL))
AS v(place, name, kind, nullable, fallback, length, said)"""
)
def discovered_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns as they were declared, after a build from one schema into another."""

    def run(name: str) -> DataFrame:
        rules = '[{"name": "nn", "type": "NOT NULL", "columns": ["a"]}]'
        spark.sql(
            f"CREATE TABLE {name}_src.t (a INT COMMENT 'the key', v VARCHAR(5) DEFAULT 'x', c CHAR(3), n DECIMAL(12,3), t STRING) "
            f"USING parquet TBLPROPERTIES ('constraints' = '{rules}')"
        )
        made = execute_ddl(spark, schema_ddl(catalog.discover(spark, f"{name}_src"), f"{name}_tgt"))
        assert made.ok, made
        found = catalog.discover(spark, f"{name}_tgt").tables[0].columns
        rows = [
            (c.ordinal_position, c.name, c.data_type, c.is_nullable, c.default_value, c.character_maximum_length, c.comment)
            for c in found
        ]
        return spark.createDataFrame(
            rows, "place int, name string, kind string, nullable boolean, fallback string, length int, said string"
        )

    return _scratch(spark, run)


@query(
    "SELECT 'names' AS view, count(*) AS n FROM nation WHERE n_name IS NOT NULL UNION ALL "
    "SELECT 'regions', count(DISTINCT n_regionkey) FROM nation"
)
def views_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of another dialect, of which one needs another that comes later by name."""

    def run(name: str) -> DataFrame:
        load(spark, sf_dir, "nation").write.saveAsTable(f"{name}_tgt.nation")
        given = {
            "a_names": 'CREATE OR REPLACE SECURE VIEW "DB"."S"."A_NAMES" AS SELECT TRIM(n_name), v.r FROM z_regions v',
            "z_regions": "CREATE VIEW db.s.z_regions (n_name, r) AS SELECT n_name, IFF(n_regionkey >= 0, n_regionkey, NULL) FROM nation",
        }
        found = [dialect.translate_view(k, v, f"{name}_tgt") for k, v in given.items()]
        made, errors = dialect.build_views(spark, found, f"{name}_tgt")
        assert not errors, errors
        rows = spark.table(f"{name}_tgt.a_names")
        counts = [("names", rows.where("n_name IS NOT NULL").count()), ("regions", rows.select("r").distinct().count())]
        return spark.createDataFrame(counts, "view string, n long")

    return _scratch(spark, run)


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def transfer_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that an earlier run has not copied: an anti-join on the key."""
    part = load(spark, sf_dir, "part")
    return part.join(part.where("p_size < 10").select("p_partkey"), "p_partkey", "left_anti").select("p_partkey", "p_name")


# --- constraints ----------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE NOT EXISTS "
    "(SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderkey % 97 <> 0)"
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").where("o_orderkey % 97 <> 0")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return constraints.orphans(lines, ["l_orderkey"], orders, ["o_orderkey"])


@query(TGT + "SELECT 'o_orderpriority' AS col, count(*) - count(o_orderpriority) AS n FROM tgt")
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.nulls(corrupted(load(spark, sf_dir, "orders")), _ORDERS)


_KEYS = [
    ("S", "LINE", "PK_LINE", "PRIMARY KEY"),
    ("S", "LINE", "UQ_LINE", "UNIQUE"),
    ("S", "ITEM", "PK_ITEM", "PRIMARY KEY"),
    ("S", "LINE", "FK_LINE", "FOREIGN KEY"),
]
_USAGE = [
    ("S", "LINE", "PK_LINE", "NUM", 2),
    ("S", "LINE", "PK_LINE", "ORD", 1),
    ("S", "LINE", "UQ_LINE", "CODE", 1),
    ("S", "ITEM", "PK_ITEM", "A", 1),
    ("S", "ITEM", "PK_ITEM", "B", 2),
    ("S", "LINE", "FK_LINE", "ITEM_A", 1),
    ("S", "LINE", "FK_LINE", "ITEM_B", 2),
]


@query(
    f"""WITH k(s, t, c, kind) AS (VALUES {", ".join(map(str, _KEYS))}), u(s, t, c, col, o) AS (VALUES {", ".join(map(str, _USAGE))})
SELECT k.t AS table_name, k.c AS constraint_name, kind AS constraint_type, string_agg(lower(col), ',' ORDER BY o) AS columns
FROM k JOIN u ON k.s = u.s AND k.t = u.t AND k.c = u.c WHERE kind IN ('PRIMARY KEY', 'UNIQUE') GROUP BY 1, 2, 3"""
)
def pk_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["constraint_schema", "table_name", "constraint_name"]
    found = constraints.keys_found(
        spark.createDataFrame(_KEYS, [*names, "constraint_type"]),
        spark.createDataFrame(_USAGE, [*names, "column_name", "ordinal_position"]),
    )
    return found.withColumn("columns", F.array_join("columns", ","))


@query(
    f"""WITH u(s, t, c, col, o) AS (VALUES {", ".join(map(str, _USAGE))})
SELECT a.t AS table_name, lower(a.col) AS column_name, b.t AS referenced_table, lower(b.col) AS referenced_column
FROM u a JOIN u b ON a.c = 'FK_LINE' AND b.c = 'PK_ITEM' AND a.o = b.o"""
)
def fk_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = spark.createDataFrame(
        _USAGE, ["constraint_schema", "table_name", "constraint_name", "column_name", "ordinal_position"]
    )
    links = spark.createDataFrame([("FK_LINE", "PK_ITEM")], ["constraint_name", "unique_constraint_name"])
    found = constraints.references_found(links, usage)
    return found.select("table_name", "column_name", "referenced_table", "referenced_column")


# --- types and DDL --------------------------------------------------------------------------------------------------

_TYPES = [
    ("NUMBER", 10, 2, None, "NUMERIC(10,2)"),
    ("NUMBER", 38, 0, None, "NUMERIC(38)"),
    ("NUMBER", None, None, None, "NUMERIC"),
    ("VARCHAR", None, None, 5, "VARCHAR(5)"),
    ("varchar", None, None, None, "VARCHAR"),
    ("TINYINT", None, None, None, "SMALLINT"),
    ("TIMESTAMP_TZ", None, None, None, "TIMESTAMP WITH TIME ZONE"),
    ("VARIANT", None, None, None, "JSONB"),
    ("GEOGRAPHY", None, None, None, "TEXT"),
    ("NUMBER(10,2)", None, None, None, "TEXT"),
]


@query(
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{t}', '{x}')" for i, (t, *_, x) in enumerate(_TYPES))
    + ") AS v(id, source, target)"
)
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for i, (t, p, s, n, _) in enumerate(_TYPES):
        column = Column("c", t, character_maximum_length=n, numeric_precision=p, numeric_scale=s)
        rows.append((i, t, kinds.map_type(column)))
    return spark.createDataFrame(rows, "id int, source string, target string")


_FAMILIES = {
    "NUMERIC": ["NUMBER", "NUMERIC"],
    "DECIMAL": ["DECIMAL"],
    "INTEGER": ["INT", "INTEGER"],
    "BIGINT": ["BIGINT"],
    "SMALLINT": ["BYTEINT", "SMALLINT", "TINYINT"],
    "DOUBLE PRECISION": ["DOUBLE", "DOUBLE PRECISION", "FLOAT", "FLOAT8"],
    "REAL": ["FLOAT4", "REAL"],
    "VARCHAR": ["VARCHAR"],
    "CHAR": ["CHAR", "CHARACTER"],
    "TEXT": ["STRING", "TEXT", "GEOGRAPHY", "VECTOR"],
    "BYTEA": ["BINARY", "VARBINARY"],
    "DATE": ["DATE"],
    "TIME": ["TIME"],
    "TIMESTAMP": ["DATETIME", "TIMESTAMP", "TIMESTAMP_NTZ"],
    "TIMESTAMP WITH TIME ZONE": ["TIMESTAMP_LTZ", "TIMESTAMP_TZ"],
    "BOOLEAN": ["BOOLEAN"],
    "JSONB": ["ARRAY", "OBJECT", "VARIANT"],
}


@query(
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{t}', {len(x)}, '{','.join(sorted(x))}')" for t, x in _FAMILIES.items())
    + ") AS v(target, n, sources)"
)
def type_map_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 33 source types, and two unknown ones, by the target type that they get."""
    names = [*kinds.TYPE_MAP, "GEOGRAPHY", "VECTOR"]
    rows = spark.createDataFrame([(kinds.map_type(Column("c", t)), t) for t in names], "target string, t string")
    return rows.groupBy("target").agg(
        F.count("*").cast("int").alias("n"), F.array_join(F.array_sort(F.collect_list("t")), ",").alias("sources")
    )


_EDGES = {
    "lineitem": ["orders", "part", "supplier"],
    "orders": ["customer"],
    "customer": ["nation"],
    "supplier": ["nation"],
    "nation": ["region"],
    "region": [],
    "part": [],
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', true)" for t in _EDGES) + ") AS v(name, after_referenced)")
def table_order_by_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every table comes after those that it refers to."""
    tables = [
        Table(t, "s", foreign_keys=[Constraint(f"fk_{r}", ConstraintType.FOREIGN_KEY, ("k",), r, ("k",)) for r in refs])
        for t, refs in _EDGES.items()
    ]
    place = {t.name: i for i, t in enumerate(table_order(tables))}
    rows = [(t, all(place[r] < place[t] for r in refs)) for t, refs in _EDGES.items()]
    return spark.createDataFrame(rows, "name string, after_referenced boolean")


# --- views ----------------------------------------------------------------------------------------------------------


def _view(name: str, body: str, sql: str, tables: tuple[str, ...]) -> None:
    """A query in the foreign dialect, run after its rewriting."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = dialect.alias_expressions(dialect.rewrite(body))
        # tables stand as arguments in the text, so that no name in the session is taken
        return spark.sql(text, **{t: load(spark, sf_dir, t) for t in tables})

    query(sql, name)(run)


_view(
    "view_iff",
    "SELECT o_orderkey, IFF(o_totalprice > 200000, IFF(o_orderstatus = 'O', 'big open', 'big'), 'small') AS size FROM {orders}",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN CASE WHEN o_orderstatus = 'O' THEN 'big open' ELSE 'big' END "
    "ELSE 'small' END AS size FROM orders",
    ("orders",),
)
_view(
    "view_nvl",
    "SELECT c_custkey, NVL(NULLIF(c_mktsegment, 'BUILDING'), 'none') AS a, IFNULL(NULLIF(c_nationkey, 3), -1) AS b FROM {customer}",
    "SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS a, coalesce(nullif(c_nationkey, 3), -1) AS b FROM customer",
    ("customer",),
)
_view(
    "view_lpad_rpad",
    "SELECT n_nationkey, LPAD(n_nationkey, 4, '0') AS a, RPAD(LPAD(n_regionkey, 3, '*'), 5, '-') AS b FROM {nation}",
    "SELECT n_nationkey, lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS a, "
    "rpad(lpad(CAST(n_regionkey AS VARCHAR), 3, '*'), 5, '-') AS b FROM nation",
    ("nation",),
)
_view(
    "view_trim",
    "SELECT TRIM(p_name), p_partkey FROM {part}",
    "SELECT trim(p_name) AS p_name, p_partkey FROM part",
    ("part",),
)
_view(
    "view_concat_ws",
    "SELECT CONCAT_WS('-', n_name, NULL, n_nationkey::VARCHAR) AS t FROM {nation}",
    "SELECT concat_ws('-', n_name, NULL, CAST(n_nationkey AS VARCHAR)) AS t FROM nation",
    ("nation",),
)
_view(
    "view_casts",
    "SELECT o_orderkey, o_orderkey::STRING AS a, o_totalprice::NUMBER(12,2) AS b, o_custkey::NUMBER AS c FROM {orders}",
    "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_totalprice AS DECIMAL(12,2)) AS b, "
    "CAST(o_custkey AS DECIMAL(38,0)) AS c FROM orders",
    ("orders",),
)
_view(
    "view_date_trunc",
    "SELECT o_orderkey, CAST(DATE_TRUNC(month, o_orderdate) AS DATE) AS m FROM {orders}",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders",
    ("orders",),
)
_view(
    "view_to_date",
    "SELECT event_id, TO_DATE(SUBSTR(ts::VARCHAR, 1, 10)) AS d FROM {events}",
    "SELECT event_id, CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS d FROM events",
    ("events",),
)
_view(
    "view_date_trunc_types",
    "SELECT event_id, DATE_TRUNC(month, ts) AS m, TYPEOF(DATE_TRUNC(hour, ts)) AS a, "
    "TYPEOF(DATE_TRUNC(year, CAST(ts AS TIMESTAMP))) AS b FROM {events}",
    "SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS m, 'timestamp_ntz' AS a, 'timestamp' AS b FROM events",
    ("events",),
)
_view(
    "view_to_timestamp",
    "SELECT event_id, TO_TIMESTAMP(SUBSTR(ts::VARCHAR, 1, 19))::TIMESTAMP_NTZ AS t, "
    "TRY_TO_TIMESTAMP(event_type)::TIMESTAMP_NTZ AS u FROM {events}",
    "SELECT event_id, date_trunc('second', ts) AS t, CAST(NULL AS TIMESTAMP) AS u FROM events",
    ("events",),
)
for _unit in ("year", "quarter", "month", "week", "day", "hour", "minute", "second"):
    _view(
        f"view_datediff_{_unit}",
        f"SELECT event_id, DATEDIFF({_unit}, ts, '2024-03-15 10:20:30'::TIMESTAMP_NTZ) AS n FROM {{events}}",
        "SELECT event_id, CAST(datediff('day', date_trunc('week', ts), TIMESTAMP '2024-03-11') / 7 AS BIGINT) AS n FROM events"
        if _unit == "week"
        else f"SELECT event_id, datediff('{_unit}', ts, TIMESTAMP '2024-03-15 10:20:30') AS n FROM events",
        ("events",),
    )
_view(
    "view_split_to_table",
    "SELECT n_nationkey, s.index AS idx, s.value AS v FROM {nation}, LATERAL SPLIT_TO_TABLE(n_name, '_') s",
    "SELECT n_nationkey, CAST(unnest(range(1, CAST(len(string_split(n_name, '_')) + 1 AS BIGINT))) AS INTEGER) AS idx, "
    "unnest(string_split(n_name, '_')) AS v FROM nation",
    ("nation",),
)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of all layers over a corrupted copy of orders."""
    return reconcile_orders(spark, sf_dir)
