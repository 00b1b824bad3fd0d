"""Queries with SQL against DuckDB on the test tables and on small ones with empty texts, ties and short items."""

import os

import pytest

pytest.importorskip("tickerloom.llm")

from tickerloom.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.01"


def compare(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    found = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, str(folder))
    assert sorted(got.columns) == sorted(found.columns)
    rows = sorted(map(tuple, got.select(*found.columns).collect()))
    assert rows == sorted(found.fetchall())
    return rows


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_tables(spark, name):
    rows = compare(spark, DATA, name)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert len(rows) == (600 * docs.select("lang").distinct().count() if name == "op13_filter_audit" else docs.count())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_odd_rows(spark, tmp_path, name):
    passage = " ".join(f"w{i}" for i in range(15))
    texts = ["A#" + "b " * 120, " ".join(f"v{i}" for i in range(130)), " ".join(f"V{i}" for i in range(130)), passage, f"A {passage.upper()} b", f"a {passage} c {passage}", None, "", " \t\n", "w1 w2 w3", "é w1 W2 w3 é", passage, "w0 " * 40]
    spark.createDataFrame([(i, t, (None, "", "en", "de")[i % 4]) for i, t in enumerate(texts)], "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    items = [("b", passage), ("a", "w1, w2! w3"), ("c", "w0 " * 12), ("d", "..."), ("e", ""), ("f", "absent words")]
    spark.createDataFrame(items, "item_id string, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, i % 3 or None) for i in range(8)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    # DuckDB reads files, so the only part takes the folder's name
    for t in ("documents", "benchmark", "labels"):
        os.rename(next((tmp_path / f"{t}.parquet").glob("part-*")), tmp_path / f"{t}.part")
        os.rename(tmp_path / f"{t}.parquet", tmp_path / f"{t}.folder")
        os.rename(tmp_path / f"{t}.part", tmp_path / f"{t}.parquet")
    assert len(compare(spark, tmp_path, name)) == (1800 if name == "op13_filter_audit" else len(texts))
