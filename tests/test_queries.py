import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([float(r[i]) if isinstance(r[i], float) else r[i] for i in order]) for r in values)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["source", "chunks", "tokens", "documents"]
