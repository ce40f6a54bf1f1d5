import duckdb
import pytest

import __spark_entry__
from corpusloom.plans import layout_plans


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A document of 130 pages, whose evenly sampled half has most characters in small type."""
    folder = str(tmp_path_factory.mktemp("tables"))
    small, body = "small " * 40, "the common body of the book goes on and on."
    lines = [small if i // 10 % 2 == 0 and i % 9 == 0 else body if i // 10 % 2 else "short" for i in range(1300)]
    spark.createDataFrame([(1, "\n".join(lines)), (2, "One line.")], "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    return folder


def both(spark, tables, name):
    got = __spark_entry__.queries()[name](spark, tables)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet/*.parquet'")
    want = con.execute(layout_plans.ORACLES[name])
    columns = [x[0] for x in want.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.fetchall()))
    return got


def test_book_stats_weigh_every_page(spark, tables):
    assert both(spark, tables, "book_stats").filter("doc = 1").first().body_font == 10.7
    assert both(spark, tables, "body_font").filter("doc = 1").first().body_font == 8.0


def test_page_margin_takes_lines_by_the_font_of_every_page(spark, tables):
    assert {r.margin for r in both(spark, tables, "page_margin").filter("doc = 1").collect()} == {72.0}


def test_prose_is_text_in_the_font_of_every_page(spark, tables):
    text = " ".join(r.text for r in both(spark, tables, "prose").filter("doc = 1").collect())
    assert "common body" in text and "small" not in text
