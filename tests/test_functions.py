import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dialect, types, values
from ledgerline.operators.transfer import resume_bounds
from ledgerline.plans.ddl import column_ddl, default_of, escaped, table_order
from ledgerline.plans.model import Column, Constraint, ConstraintType, Table, TableReport


def col(kind, p=None, s=None, n=None, **more):
    return Column("c", kind, character_maximum_length=n, numeric_precision=p, numeric_scale=s, **more)


def test_every_type_has_a_target_and_a_spark_type():
    assert len(types.TYPE_MAP) == 33
    for name in types.TYPE_MAP:
        assert types.map_type(col(name.lower())) == types.TYPE_MAP[name]
        assert types.spark_ddl_type(col(name))


@pytest.mark.parametrize(
    ("column", "target", "spark"),
    [
        (col("NUMBER", 10, 2), "NUMERIC(10,2)", "DECIMAL(10,2)"),
        (col("NUMBER", 38, 0), "NUMERIC(38)", "DECIMAL(38,0)"),
        (col("NUMBER"), "NUMERIC", "DECIMAL(38,0)"),
        (col("DECIMAL", 5, 1), "DECIMAL(5,1)", "DECIMAL(5,1)"),
        (col("VARCHAR", n=7), "VARCHAR(7)", "VARCHAR(7)"),
        (col("VARCHAR"), "VARCHAR", "STRING"),
        (col("CHARACTER", n=2), "CHAR(2)", "CHAR(2)"),
        (col("GEOGRAPHY"), "TEXT", "STRING"),
        (col("NUMBER(10,2)"), "TEXT", "STRING"),
        (col("ARRAY"), "JSONB", "STRING"),
    ],
)
def test_types(column, target, spark):
    assert types.map_type(column) == target
    assert types.spark_ddl_type(column) == spark


def test_roles_of_columns():
    columns = [
        Column("made", "TIMESTAMP_NTZ"),
        Column("ship_date", "DATE"),
        Column("n", "NUMBER(3)"),
        Column("b", "BYTEINT"),
        Column("t", "VARCHAR"),
        Column("dt", "DATETIME"),
    ]
    assert types.detect_date_column(columns) == "ship_date"
    assert types.detect_date_column(columns[:1]) == "made"
    assert types.detect_date_column(columns[2:]) is None
    assert types.numeric_columns(columns) == ["n"]
    assert types.min_max_columns(columns) == ["made", "ship_date", "n"]


def test_defaults_and_escapes():
    assert default_of(col("INT", default_value="0")) == "0"
    assert default_of(col("INT", default_value="CURRENT_TIMESTAMP")) is None
    assert default_of(col("INT", default_value="NEXTVAL('s')")) is None
    assert default_of(col("INT", default_value="seq.NEXTVAL")) == "seq.NEXTVAL"
    assert escaped("it's") == "it\\'s"
    assert column_ddl(col("INT", is_nullable=False, comment="a'b")) == "`c` INT NOT NULL COMMENT 'a\\'b'"


def tables(edges):
    def keys(refs):
        return [Constraint("k", ConstraintType.FOREIGN_KEY, ("a",), r, ("a",)) for r in refs]

    return [Table(t, "s", foreign_keys=keys(refs)) for t, refs in edges.items()]


@pytest.mark.parametrize(
    "edges",
    [
        {"a": ["b"], "b": ["c"], "c": []},
        {"a": ["b", "c"], "b": ["d"], "c": ["d"], "d": []},
        {"a": ["a"], "b": ["a"]},
        {"a": ["elsewhere"], "b": []},
    ],
)
def test_table_order(edges):
    order = [t.name for t in table_order(tables(edges))]
    assert sorted(order) == sorted(edges)
    for t, refs in edges.items():
        for r in refs:
            if r in edges and r != t:
                assert order.index(r) < order.index(t)


def test_table_order_with_a_cycle_and_a_long_chain():
    assert sorted(t.name for t in table_order(tables({"a": ["b"], "b": ["a"]}))) == ["a", "b"]
    chain = {f"t{i}": [f"t{i + 1}"] for i in range(3000)} | {"t3000": []}
    assert [t.name for t in table_order(tables(chain))] == [f"t{i}" for i in range(3000, -1, -1)]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ((None, 0, 0), (None, 0)),
        ((None, 500, 0), (None, 500)),
        ((100, 40, 0), (60, 40)),
        ((100, 40, 30), (30, 70)),
        ((100, 120, 0), (0, 120)),
        ((0, 5, 0), (None, 5)),
    ],
)
def test_resume_bounds(given, expected):
    assert resume_bounds(*given) == expected


def test_summaries():
    assert TableReport("t").ok
    assert TableReport("t").add("x", True).add("y", None).ok
    v = TableReport("t").add("x", True).add("y", False).add("z", None)
    assert not v.ok
    assert [c.name for c in v.failed] == ["y"]


def test_decimal_text():
    assert values.decimal_text("1.0") == values.decimal_text("1.000") == "1"
    assert values.decimal_text(None) == "NULL"
    assert values.decimal_text("x") == "x"


def test_cleaning(spark):
    rows = [(None, 1), ("", 2), ("a\0b", 3), ("\\N", 4), ('q",\n', 5)]
    df = values.strip_nul(spark.createDataFrame(rows, "t string, n int"))
    assert [r["t"] for r in df.orderBy("n").collect()] == [None, "", "ab", "\\N", 'q",\n']


def test_comparable(spark):
    df = spark.createDataFrame([(" a ", "a"), (None, "NULL")], "x string, y string")
    strict = [r[0] for r in df.select(values.comparable(F.col("x"), True) == values.comparable(F.col("y"), True)).collect()]
    assert strict == [True, True]
    typed = [r[0] for r in df.select(values.comparable(F.col("x")).eqNullSafe(values.comparable(F.col("y")))).collect()]
    assert typed == [False, False]


@pytest.mark.parametrize(
    ("sql", "expected"),
    [
        ("IFF(a, IFF(b, 1, 2), 3)", "if(a, if(b, 1, 2), 3)"),
        ("'IFF(a,b,c)' || IFF(a, ')', '(')", "'IFF(a,b,c)' || if(a, ')', '(')"),
        ("GETDATE() -- GETDATE()", "current_timestamp() -- GETDATE()"),
        ("x::VARCHAR, x::VARCHAR(10), x::NUMBER, x::NUMBER(10,2), x::date", "x::STRING, x::VARCHAR(10), x::DECIMAL(38,0), x::DECIMAL(10,2), x::date"),
        ("NVL(a, b)", "NVL(a, b)"),
        ("LPAD(RPAD(x, 3, ' '), 5, '0')", "LPAD(RPAD(x, 3, ' '), 5, '0')"),
        ("DATE_TRUNC(month, x)", "(x - (cast(x AS timestamp_ntz) - cast(date_trunc('month', x) AS timestamp_ntz)))"),
        ("EXTRACT(YEAR FROM c)", "EXTRACT(YEAR FROM c)"),
    ],
)
def test_rewrite(sql, expected):
    assert dialect.rewrite(sql) == expected


def test_aliases():
    sql = "SELECT a, TRIM(t.b), count(*), x AS y, c + 1 d, CASE WHEN a THEN 1 END, 'k' FROM t"
    expected = (
        "SELECT a, TRIM(t.b) AS b, count(*) AS col_3, x AS y, c + 1 d, CASE WHEN a THEN 1 END AS col_6, 'k' AS col_7 FROM t"
    )
    assert dialect.alias_expressions(sql) == expected


def test_view_forms():
    t = dialect.translate_view("v", 'CREATE OR REPLACE SECURE VIEW "D"."S"."V" ("A", b) AS SELECT x, y FROM "D"."O"."T";', "Tgt")
    assert t.ddl == "CREATE OR REPLACE VIEW `tgt`.`v` (`a`, `b`) AS SELECT x, y FROM `o`.`t`"
    assert t.schemas == ["o"]
    assert dialect.translate_view("v", None, "t").reason == "no DDL"
    assert dialect.translate_view("v", "DROP TABLE x", "t").reason.startswith("not a view")
    assert dialect.translate_view("v", "CREATE VIEW v AS SELECT IFF(a, 1", "t").reason == "unbalanced brackets"
    stub = dialect.procedure_stub("p", "line 1\nline 2", "t")
    assert stub.splitlines()[1:] == ["-- line 1", "-- line 2"]
    assert dialect.procedure_stub("p", None, "t") is None
