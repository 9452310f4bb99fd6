"""Every query of plans against its DuckDB SQL on the small tables."""

from __future__ import annotations

import datetime
import os
import re

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for name in os.listdir(SF):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 8)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v) if isinstance(v, datetime.datetime) else v


def names():
    from tessera.plans import QUERIES

    return sorted(QUERIES)


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    from tessera.plans import ORACLE_SQL, QUERIES

    df = QUERIES[name](spark, SF)
    got = sorted(repr(tuple(plain(r[c]) for c in sorted(df.columns))) for r in df.collect())
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name])
        cols = want.columns
        assert sorted(cols) == sorted(df.columns)
        assert got == sorted(repr(tuple(plain(r[cols.index(c)]) for c in sorted(cols))) for r in want.fetchall())


MARKED = ["- item _one_ and *two*", "+ plus", "* star", "**bold ** x", "__under __ (_a_)", "___", "a_b_c *d", "# head _x_", "> quote *y*.", "red, blue, red/blue;green,, red", "plain", "", None]
UNMARKED = ["item one and two", "plus", "star", "bold x", "under (a)", "", "a_b_c *d", "head x", "quote y.", "red, blue, red/blue;green,, red", "plain", "", None]


def test_text_queries_over_whole_tables(spark, tmp_path):
    from tessera.plans import ORACLE_SQL, QUERIES

    spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    turns = [0, 7, 8, 9, 10, 59, 60, 3599, 3600, 359_998]
    spark.createDataFrame([(1, n, "x") for n in turns], "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert {r.doc_id: r.v for r in QUERIES["t24_markdown"](spark, str(tmp_path)).collect()} == dict(enumerate(UNMARKED))
    names = {r.doc_id: r.names for r in QUERIES["t3_category_names_all"](spark, str(tmp_path)).collect()}
    assert names == {d: list(dict.fromkeys(y for p in re.split("[,，/|;；、·]+", x or "") if (y := p.strip(" ")))) for d, x in enumerate(MARKED)}
    items = {r.turn: r.item for r in QUERIES["s24_subtitles_all"](spark, str(tmp_path)).collect()}
    assert items == {n: f"{n}\n{n // 3600:02}:{n // 60 % 60:02}:{n % 60:02},000 --> {(n + 1) // 3600:02}:{(n + 1) // 60 % 60:02}:{(n + 1) % 60:02},500\nx\n" for n in turns}
    import duckdb

    c = duckdb.connect()
    for name, key, want in (("t3_category_names_all", "doc_id", names), ("s24_subtitles_all", "turn", items)):
        for table in ("documents", "conversations"):
            c.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        got = c.sql(ORACLE_SQL[name])
        assert {r[got.columns.index(key)]: r[-1] for r in got.fetchall()} == want


def test_length_ratios_are_rounded_as_in_sql(spark, tmp_path):
    """Hundredths whose half is no binary number, exact halves, and texts that are null or empty."""
    import duckdb

    from tessera.plans import ORACLE_SQL, QUERIES

    sizes = [(a, b) for b in (200, 240, 400) for a in range(b * 3 // 4)]
    texts = [("x" * b, "y" * a) for a, b in sizes] + [("x " * 200, None), ("x " * 200, ""), (None, "y"), ("", "y"), ("x " * 200, "y. " * 30)]
    rows = [(i, turn, x) for i, pair in enumerate(texts) for turn, x in enumerate(pair)]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = {i: codes for i, _, codes in c.sql(ORACLE_SQL["q9_completeness"]).fetchall()}
    assert {r.conv_id: r.codes for r in QUERIES["q9_completeness"](spark, str(tmp_path)).collect()} == want
    assert want[sizes.index((138, 240))] == ["length_ratio_low:0.57<0.75"] and want[sizes.index((25, 200))] == ["length_ratio_low:0.13<0.75"]


def test_markdown_of_every_document(spark):
    from tessera.plans import QUERIES

    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r.v for r in QUERIES["t24_markdown"](spark, SF).collect()}
    assert got.keys() == texts.keys() and all((got[d] is None) == (x is None) for d, x in texts.items())
    plain = [d for d, x in texts.items() if x and not re.search(r"[*_]", x) and not re.match(r"[#>+-]", x)]
    assert len(plain) > 50 and all(got[d] == texts[d] for d in plain)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
