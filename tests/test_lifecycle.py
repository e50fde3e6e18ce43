import json

import pytest
from pyspark.sql import functions as F

from ledgerline import cli, report
from ledgerline.functions import dialect
from ledgerline.operators import checks, constraints, transfer
from ledgerline.plans import ddl
from ledgerline.plans.model import Column, Constraint, ConstraintType, Schema, Table
from ledgerline.queries import corrupted
from ledgerline.sources import catalog, tables
from ledgerline.sources.checkpoints import Checkpoint
from ledgerline.streaming.incremental import copy_new_files


@pytest.fixture
def source(spark, sf_dir):
    spark.sql("DROP SCHEMA IF EXISTS src CASCADE")
    spark.sql("DROP SCHEMA IF EXISTS tgt CASCADE")
    spark.sql("CREATE SCHEMA src")
    keys = {"nation": ("n_nationkey", "n_regionkey", "region"), "region": ("r_regionkey", None, None)}
    keys |= {"orders": ("o_orderkey", None, None)}
    for name, (key, foreign, parent) in keys.items():
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.saveAsTable(f"src.{name}")
        rules = [{"name": f"pk_{name}", "type": "PRIMARY KEY", "columns": [key]}]
        if foreign:
            rules.append(
                {"name": "fk", "type": "FOREIGN KEY", "columns": [foreign], "table": parent, "refers": ["r_regionkey"]}
            )
        spark.sql(f"ALTER TABLE src.{name} SET TBLPROPERTIES ('constraints' = '{json.dumps(rules)}')")
    spark.sql("CREATE VIEW src.big AS SELECT o_orderkey, o_totalprice FROM src.orders WHERE o_totalprice > 1000")
    yield "src"
    spark.sql("DROP SCHEMA IF EXISTS src CASCADE")
    spark.sql("DROP SCHEMA IF EXISTS tgt CASCADE")


def test_discovery(spark, source):
    found = catalog.discover(spark, source)
    assert [t.name for t in found.tables] == ["nation", "orders", "region"]
    assert found.tables[0].row_count == 25
    assert found.tables[0].primary_key.columns == ("n_nationkey",)
    assert found.tables[0].references == {"region"}
    assert [v.name for v in found.views] == ["big"]
    assert json.loads(report.schema_json(found))["tables"][2]["columns"][0]["name"] == "r_regionkey"
    assert "nation (25 rows)" in report.schema_text(found)
    only = catalog.discover(spark, source, ["ORDERS"])
    assert [t.name for t in only.tables] == ["orders"]
    assert only.views == []
    with pytest.raises(catalog.SchemaNotFoundError, match="src"):
        catalog.discover(spark, "nowhere")


def test_build_transfer_validate_destroy(spark, source, tmp_path, capsys):
    run = lambda *a: cli.main(list(a), spark)
    assert run("build", "--schema", "src", "--target", "tgt") == 0
    assert spark.table("tgt.nation").count() == 0
    assert catalog.primary_key(spark, "tgt", "nation") == ["n_nationkey"]
    done = str(tmp_path / "done.json")
    args = ["transfer", "--schema", "src", "--target", "tgt", "--workers", "2", "--checkpoint", done]
    assert run(*args, "--dry-run") == 0
    assert spark.table("tgt.orders").count() == 0
    assert run(*args) == 0
    assert spark.table("tgt.orders").count() == 1500
    assert run(*args) == 0  # nothing is copied twice
    assert spark.table("tgt.orders").count() == 1500
    assert run("validate", "--schema", "src", "--target", "tgt", "--sample-size", "100") == 0
    assert "0 failed" in capsys.readouterr().out
    spark.sql("INSERT INTO tgt.nation VALUES (99, 'NOWHERE', 77)")
    log = tmp_path / "log"
    assert run("validate", "--schema", "src", "--target", "tgt", "--table", "nation", "--save-log", str(log)) == 1
    assert "FAILED  row_count" in log.read_text()
    lost = constraints.orphans(spark.table("tgt.nation"), ["n_regionkey"], spark.table("tgt.region"), ["r_regionkey"])
    assert [r["n_nationkey"] for r in lost.collect()] == [99]
    assert run("destroy", "--target", "tgt", "--no-prompt") == 2
    assert run("destroy", "--target", "tgt", "--dry-run") == 0
    assert spark.catalog.databaseExists("tgt")
    assert run("destroy", "--target", "tgt", "--force") == 0
    assert not spark.catalog.databaseExists("tgt")


def test_migrate_and_files(spark, source, tmp_path):
    out = tmp_path / "ddl"
    assert cli.main(["migrate", "--schema", "src", "--target", "tgt", "--output", str(out)], spark) == 0
    assert "CREATE TABLE" in (tmp_path / "ddl.tables.sql").read_text()
    assert cli.main(["discover", "--schema", "nowhere"], spark) == 2
    assert cli.main(["discover", "--schema", "src", "--format", "json", "--output", str(out)], spark) == 0
    assert json.loads(out.read_text())["schema"] == "src"


def test_failed_ddl_is_taken_back(spark, source):
    statements = ["CREATE SCHEMA IF NOT EXISTS tgt", "CREATE TABLE IF NOT EXISTS tgt.a (x INT) USING parquet", "", "NONSENSE"]
    seen = []
    result = ddl.execute_ddl(spark, statements, progress=lambda i, n, s: seen.append((i, n)))
    assert (result.ok, result.ran, len(result.failures)) == (False, 2, 1)
    assert seen[-1] == (3, 3)
    assert not spark.catalog.tableExists("tgt.a")
    assert len(ddl.execute_ddl(spark, statements, stop_on_error=False).failures) == 1
    assert spark.catalog.tableExists("tgt.a")
    assert ddl.execute_ddl(spark, ["NONSENSE"], dry_run=True).ok


def test_table_ddl_runs(spark, source):
    columns = [
        Column("ID", "NUMBER", False, numeric_precision=10, numeric_scale=0, ordinal_position=1, comment="the 'key'"),
        Column("NAME", "VARCHAR", default_value="'x'", character_maximum_length=5, ordinal_position=2),
        Column("DOC", "VARIANT", ordinal_position=3),
        Column("AT", "TIMESTAMP_NTZ", ordinal_position=4),
    ]
    key = Constraint("pk", ConstraintType.PRIMARY_KEY, ("ID",))
    schema = Schema("S", tables=[Table("THINGS", "S", columns, key, comment="it's")])
    assert ddl.execute_ddl(spark, ddl.schema_ddl(schema, "TGT")).ok
    assert spark.table("tgt.things").columns == ["id", "name", "doc", "at"]
    assert catalog.required_columns(spark, "tgt", "things") == ["id"]
    assert spark.catalog.getTable("tgt.things").description == "it's"


def test_views_in_any_order(spark, source):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tgt")
    spark.table("src.nation").write.mode("overwrite").saveAsTable("tgt.nation")
    texts = {
        "a_late": "CREATE VIEW a_late (k, n) AS SELECT n_nationkey, NVL(label, 'none') FROM z_early",
        "z_early": "CREATE VIEW z_early AS SELECT n_nationkey, IFF(n_regionkey = 1, 'one', NULL) AS label, TRIM(n_name) FROM nation",
        "broken": "CREATE VIEW broken AS SELECT * FROM missing",
    }
    views = [dialect.translate_view(n, t, "tgt") for n, t in texts.items()]
    made, errors = dialect.build_views(spark, views, "tgt")
    assert sorted(made) == ["a_late", "z_early"]
    assert list(errors) == ["broken"]
    assert spark.table("tgt.a_late").columns == ["k", "n"]
    assert spark.table("tgt.z_early").columns == ["n_nationkey", "label", "n_name"]


def test_each_layer_catches_its_fault(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    failed = lambda t: {c.name for c in checks.reconcile(orders, t, "orders", ["o_orderkey"], 5000).failed}
    assert failed(orders) == set()
    # losses and doublings cancel out at this size: the total doesn't see them
    found = failed(corrupted(orders))
    assert "row_count" not in found
    assert {"partition_counts", "null_counts", "aggregate_fingerprint", "row_sample"} <= found
    scaled = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    assert failed(scaled) == {"min_max_values", "aggregate_fingerprint", "row_sample"}
    assert {"row_count", "partition_counts"} <= failed(orders.limit(10))


def test_no_key_no_columns_and_empty_tables(spark, sf_dir):
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    skipped = checks.reconcile(region, region, "region", (), 10)
    assert skipped.ok
    assert [c.passed for c in skipped.checks if c.name == "row_sample"] == [None]
    other = spark.createDataFrame([(1,)], "x int")
    assert [c.name for c in checks.reconcile(region, other, "region").checks] == ["schema_check"]
    empty = region.limit(0)
    assert checks.reconcile(empty, empty, "region", ["r_regionkey"], 10).ok
    assert checks.date_chunks(spark.createDataFrame([], "d date"), "d").count() == 0


def test_samples_with_null_values_and_doubled_keys(spark):
    s = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, " d")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (4, "d")], "k int, v string")
    found = {r["k"]: r["kind"] for r in checks.row_sample(s, t, ["k"], 10).collect()}
    assert found == {2: "mismatch", 3: "missing", 4: "mismatch"}
    loose = {r["k"] for r in checks.row_sample(s, t, ["k"], 10, strict_text=True).collect()}
    assert loose == {2, 3}
    assert checks.row_sample(s, t, ["k"], 2, seed=1).count() <= 2


def test_checkpoint_files(tmp_path):
    path = tmp_path / "c.json"
    c = Checkpoint(str(path), "s", "t")
    assert c.begin("A", 7, 4) == (0, 0)
    c.update("A", 1, 10)
    assert Checkpoint(str(path), "s", "t").begin("a", 17, 4) == (1, 10)
    assert Checkpoint(str(path), "s", "t").begin("a", 20, 4) == (2, 13)  # a batch that was committed, but not noted
    with pytest.raises(ValueError, match="4 batches"):
        Checkpoint(str(path), "s", "t").begin("a", 20, 5)
    c.complete("A")
    again = Checkpoint(str(path), "s", "t")
    assert again.is_completed("a")
    assert again.summary() == {"completed": 1, "in_progress": 0}
    with pytest.raises(ValueError, match="another transfer"):
        Checkpoint(str(path), "other", "t")
    path.write_text("{")
    assert Checkpoint(str(path), "s", "t").completed == []
    path.write_text("{}")
    assert Checkpoint(str(path), "s", "t").begin("a", 3, 1) == (0, 0)


def test_transfer_errors_are_reported(spark, source):
    stats = transfer.transfer_table(spark, "src", "nation", "nowhere")
    assert not stats.ok
    assert stats.error
    spark.sql("CREATE SCHEMA IF NOT EXISTS tgt")
    some = transfer.transfer_table(spark, "src", "orders", "tgt", "o_orderkey < 100", limit=5)
    assert (some.ok, some.rows) == (True, 5)
    s = transfer.summarise(transfer.stats_frame(spark, [stats, some])).head()
    assert (s["tables"], s["succeeded"], s["rows"]) == (2, 1, 5)


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    rows = [(None, 1), ("", 2), ("a,b", 3), ('q"\n', 4)]
    df = spark.createDataFrame(rows, "t string, n int")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), "t string, n int")
    assert [(r["t"], r["n"]) for r in back.orderBy("n").collect()] == rows


def test_jdbc_round_trip(spark):
    url, driver = "jdbc:derby:memory:trip;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    tables.write_jdbc(df, url, "trip", driver)
    tables.write_jdbc(df.where("k = 1"), url, "trip", driver)
    back = tables.read_jdbc(spark, url, "trip", driver, partition=("k", 1, 3, 2))
    assert sorted(r["k"] for r in back.collect()) == [1, 1, 2]


def test_incremental_copy_takes_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(1, "a\0"), (2, "b")], "k int, v string").coalesce(1).write.parquet(source)
    assert copy_new_files(spark, source, target, state) == 2
    assert copy_new_files(spark, source, target, state) == 0
    spark.createDataFrame([(3, "c")], "k int, v string").coalesce(1).write.mode("append").parquet(source)
    copy_new_files(spark, source, target, state)
    assert sorted(r["v"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_a_checkpointed_transfer_appends_and_resumes_after_its_last_batch(spark, source, tmp_path):
    spark.sql("DROP TABLE IF EXISTS tgt.orders")
    spark.sql("CREATE SCHEMA IF NOT EXISTS tgt")
    spark.table("src.orders").limit(3).write.saveAsTable("tgt.orders")
    path = str(tmp_path / "state")
    state = Checkpoint(path, "src", "tgt")
    assert state.begin("orders", 3, 4) == (0, 0)
    rows = spark.table("src.orders")
    transfer.in_batch(rows, ["o_orderkey"], 0, 4).write.insertInto("tgt.orders")  # committed, but not noted
    found = transfer.transfer_table(spark, "src", "orders", "tgt", batches=4, checkpoint=Checkpoint(path, "src", "tgt"))
    assert found.ok, found.error
    assert found.before + found.rows == rows.count()
    assert spark.table("tgt.orders").count() == rows.count() + 3
    assert spark.table("tgt.orders").distinct().count() == rows.count()


def test_sums_keep_each_columns_scale_and_all_columns_are_summed(spark):
    rows = [(f"2024-01-{1 + i % 3:02d}", *([i] * 11), f"{i}.001") for i in range(9)]
    names = ["d", *(f"n{i}" for i in range(11)), "x"]
    df = spark.createDataFrame(rows, names).selectExpr("cast(d AS date) AS d", *names[1:12], "cast(x AS decimal(12,4)) AS x")
    other = df.selectExpr("* EXCEPT (x)", "cast(if(n0 = 4, x + 0.002, x) AS decimal(12,4)) AS x")
    found = checks.reconcile(df, other, "t")
    assert [c.name for c in found.failed] == ["min_max_values", "aggregate_fingerprint"] or [c.name for c in found.failed] == [
        "aggregate_fingerprint"
    ]
    assert "x: " in found.failed[-1].details[0]
