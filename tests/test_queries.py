import duckdb
import pytest

from ledgerline import queries


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert queries.queries().keys() == queries.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, db, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = db.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 6
    assert set(queries.queries()) <= set(__spark_entry__.queries())
