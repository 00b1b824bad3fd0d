"""Landed files in odd shapes, references to characters, lookups and guards."""

import datetime as dt
import html
import json
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.functions import scalars
from tickerloom.operators import extract, universe
from tickerloom.sources import readers


def test_references_are_read_as_browsers_read_them(spark):
    rng = random.Random(3)
    names = [*html.entities.html5, "unknown;", "x", "amp", "notit;", "#65;", "#x41", "#0", "#128;", "#x9f;", "#xD800;", "#1114112;", "#99999999999999999999;", "#1;", "#11;", "#127;", "#xFDD0;", "#x1F600;", "#xFFFE;", "#x1FFFF;", "#;", "#x;", "&", " ", "a" * 40 + ";"]
    texts = ["", "&", "no", "&&amp;;", "a &lt b"] + [f"x &{n} y" for n in names] + ["".join(rng.choice(["&" + rng.choice(names), "t", ";", " "]) for _ in range(12)) for _ in range(300)]
    got = {r.t: r.u for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.unescape(F.col("t")).alias("u")).collect()}
    assert got == {t: html.unescape(t) for t in texts}
    row = spark.createDataFrame([(None, " a &nbsp; b\x1fc ")], "n string, t string").select(scalars.unescape(F.col("n")), scalars.clean_label(F.col("n")), scalars.clean_label(F.col("t"))).first()
    assert tuple(row) == (None, "", "a b c")


def test_json_of_either_shape_keeps_its_order(spark, tmp_path):
    files = {"a.json": '[{"isin": "I1", "ticker": "x ", "sector": "one"},\n {"isin": "I1", "ticker": "Y", "sector": "two"}]', "b.json": json.dumps({"n": 1, "data": [{"isin": "I2", "sector": 3}, {"isin": " I1 ", "ticker": "z", "sector": "four"}]}), "c.json": "not json", "d.json": '{"data": 5}', "e.json": "[]"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    master = readers.security_master(spark, str(tmp_path))
    assert [tuple(r) for r in master.orderBy("file", "place").collect()] == [("a.json", 0, "I1", "x ", "one", None), ("a.json", 1, "I1", "Y", "two", None), ("b.json", 0, "I2", None, "3", None), ("b.json", 1, " I1 ", "z", "four", None)]
    found = {r.key: r.row.sector for r in universe.security_lookup(master, ["file", "place"]).collect()}
    assert found == {"I1": "one", "X": "one", "Y": "two", "I2": "3", "Z": "four"}
    rows = spark.createDataFrame([("I9", "y"), ("I1", "Z"), (None, None), ("", "nope")], "isin string, ticker string")
    assert sorted((r.isin or "", r.sector) for r in universe.lookup_by_isin_or_ticker(rows, master, "sector", ["file", "place"]).collect() if r.ticker) == [("", None), ("I1", "one"), ("I9", "two")]


def test_taxonomy_and_benchmark_guards(spark, tmp_path):
    (tmp_path / "bare.csv").write_text("symbol,sector\nA,x\n")
    (tmp_path / "none.csv").write_text("symbol,group\nA,x\n")
    assert readers.read_taxonomy(spark, f"{tmp_path}/bare.csv", "industry").first().sector == "x"
    assert readers.read_taxonomy(spark, None, default=f"{tmp_path}/absent.csv") is None and readers.read_taxonomy(spark, None) is None
    with pytest.raises(FileNotFoundError, match="absent"):
        readers.read_taxonomy(spark, f"{tmp_path}/absent.csv")
    with pytest.raises(ValueError, match="lacks the columns sector"):
        readers.read_taxonomy(spark, f"{tmp_path}/none.csv", "industry")
    with pytest.raises(ValueError, match="no level"):
        readers.read_taxonomy(spark, None, "x")
    (tmp_path / "l.csv").write_text("date,close\n2024-01-02,2\n2024-01-01,1\n")
    readers.register_benchmark("test", "A Level", "l.csv")
    readers.register_benchmark("test", "A Level", "l.csv")
    assert [tuple(r) for r in readers.registered_level(spark, str(tmp_path), "test").collect()] == [(dt.date(2024, 1, 1), 1.0, "A Level"), (dt.date(2024, 1, 2), 2.0, "A Level")]
    assert readers.registered_level(spark, "", "mine", f"{tmp_path}/l.csv").first().benchmark == "mine"
    with pytest.raises(ValueError, match="already"):
        readers.register_benchmark("test", "Another", "l.csv")
    with pytest.raises(ValueError, match="no benchmark"):
        readers.registered_level(spark, str(tmp_path), "other")


def test_floors_may_only_move_later(spark):
    floors = readers.history_floors("2018-05-31", 100, 5, prices="2018-03-01")
    row = spark.range(1).select(*(v.alias(k) for k, v in floors.items())).first()
    assert tuple(row) == (dt.date(2018, 5, 31), dt.date(2018, 3, 1), dt.date(2017, 2, 28))
    with pytest.raises(ValueError, match="2017-02-28; 2017-02-27 is earlier"):
        readers.history_floors("2018-05-31", 100, 5, financials="2017-02-27")
    with pytest.raises(ValueError, match="no floor x"):
        readers.history_floors("2018-05-31", x="2020-01-01")


def test_cells_of_pages_in_sql(spark):
    extract.register_table_functions(spark)
    pages = spark.createDataFrame([("A", '<section id="quarters"><table><thead><tr><th>x</th></tr></thead><tbody><tr><td>1</td></tr></tbody></table></section>'), ("B", None)], "symbol string, html string")
    got = spark.sql("select symbol, section, head, text from {p}, lateral page_cells(html)", p=pages).collect()
    assert sorted(map(tuple, got)) == [("A", "quarters", False, "1"), ("A", "quarters", True, "x")]


def test_names_of_characters_are_a_constant(spark):
    """A map read from JSON isn't folded by Spark: each reference would read all names again."""
    df = spark.range(200_000).select(scalars.clean_label(F.concat(F.lit("a &notit; "), F.col("id").cast("string"), F.lit("&eacute;"))).alias("label"))
    assert "from_json" not in df._jdf.queryExecution().analyzed().toString()
    assert df.where("label like 'a ¬it; %é'").count() == 200_000


def test_landed_pages_are_few_files(spark):
    """Pages of one-digit symbols are a file each, the others share files, and all are read."""
    from tickerloom import landed_queries

    pages = spark.range(300).selectExpr("concat('S', id) as symbol", "concat('<p>', id, '</p>') as html")
    got = landed_queries.landed_pages(spark, pages, "few")
    assert {(r.symbol, r.html.strip()) for r in got.collect()} == {(f"S{i}", f"<p>{i}</p>") for i in range(300)}
    assert len(got.inputFiles()) < 60
