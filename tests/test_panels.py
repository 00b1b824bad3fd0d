"""Hand-worked cases, invariants, the day-by-day recurrence and readers."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.functions import scalars
from tickerloom.operators import asof, attribution, corpact, extract, fundamentals, metrics, panel, signals, timeline, weights
from tickerloom.plans.runs import Config, Market, configs_table, run_strategies, targets
from tickerloom.schemas import no_nan, require_columns
from tickerloom.sources import readers


def day(n: int) -> dt.date:
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_standardise(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 100)] + [("b", 5.0), ("c", 2.0), ("c", 2.0), ("d", None)], "k string, v double")
    got = {}
    for r in signals.standardised(df, "v", ["k"], 3.0, "z").collect():
        got.setdefault(r.k, []).append(r.z)
    assert sorted(got["a"]) == pytest.approx([-0.481456, -0.458530, -0.435603, -0.412677, 1.788267], abs=1e-6)
    assert got["b"] == [0.0] and got["c"] == [0.0, 0.0] and got["d"] == [None]


def test_waterfill(spark):
    rows = [("r", day(0), s, w, 0.35) for s, w in zip("abcd", (0.5, 0.3, 0.12, 0.08), strict=True)]
    df = spark.createDataFrame(rows, "run_id string, rebal_date date, symbol string, weight double, cap double")
    got = {r.symbol: r.weight for r in weights.cap_groups(df, "symbol", "cap").collect()}
    assert got == pytest.approx({"a": 0.35, "b": 0.35, "c": 0.18, "d": 0.12})


def test_waterfill_equals_iteration(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for k in range(60):
        w = [rng.random() ** 3 for _ in range(rng.randrange(3, 12))]
        w = [x / sum(w) for x in w]
        cap = max(1 / len(w) + 1e-6, rng.uniform(0.1, 0.6))
        rows += [(str(k), day(0), str(i), x, cap) for i, x in enumerate(w)]
        for _ in range(1000):
            over = [x > cap for x in w]
            excess = sum(x - cap for x in w if x > cap)
            if excess < 1e-15:
                break
            free = sum(x for x, o in zip(w, over, strict=True) if not o and x < cap)
            w = [cap if x >= cap else x + excess * x / free for x in w]
        expected |= {(str(k), str(i)): x for i, x in enumerate(w)}
    df = spark.createDataFrame(rows, "run_id string, rebal_date date, symbol string, weight double, cap double")
    got = {(r.run_id, r.symbol): r.weight for r in weights.cap_groups(df, "symbol", "cap").collect()}
    assert got == pytest.approx(expected, abs=1e-9)


def test_caps_that_cannot_hold(spark):
    df = spark.createDataFrame([("r", day(0), s, "x", 0.5, 0.4, None, None) for s in "ab"], "run_id string, rebal_date date, symbol string, sector string, raw_weight double, max_stock_wt double, max_sector_wt double, max_size_bucket_wt map<string,double>")
    with pytest.raises(weights.InfeasibleCap, match="r 2020-01-01"):
        weights.capped(df)


def test_back_adjust(spark):
    q = spark.createDataFrame([(day(1), "A", 100.0, 10.0), (day(2), "A", 100.0, 10.0), (day(3), "A", 50.0, 10.0), (day(1), "B", 7.0, 1.0)], "date date, symbol string, close double, volume double")
    a = spark.createDataFrame([("A", day(2), "dividend", None, None, 10.0), ("A", day(3), "split", 10.0, 5.0, None)], "symbol string, ex_date date, action_type string, ratio_num double, ratio_denom double, amount double")
    got = {(r.symbol, r.date): (r.close, r.volume) for r in corpact.back_adjust(q, a).collect()}
    assert got[("A", day(1))] == pytest.approx((45.0, 20.0)) and got[("A", day(2))] == pytest.approx((50.0, 20.0))
    assert got[("A", day(3))] == (50.0, 10.0) and got[("B", day(1))] == (7.0, 1.0)


@pytest.mark.parametrize(("subject", "expected"), [
    ("Stock Split From Rs.10/- To Rs.2/-", ("split", 10.0, 2.0, None)), ("Stock Split 1:5", ("split", 5.0, 1.0, None)), ("Sub-division 10:2", ("split", 10.0, 2.0, None)),
    ("Bonus issue 6:1", ("bonus", 6.0, 1.0, None)), ("Interim Dividend - Rs 5.50 Per Share", ("dividend", None, None, 5.5)), ("Annual General Meeting", (None,) * 4),
    ("Annual General Meeting/Dividend - Rs 3 Per Share", ("dividend", None, None, 3.0)), ("Scheme of arrangement", (None,) * 4),
    ("Dividend Rs 5 per share of face value Rs 10", ("dividend", None, None, 5.0)), (None, (None,) * 4),
])
def test_subjects(spark, subject, expected):
    r = one(corpact.classify_subject(spark.createDataFrame([(subject,)], "subject string")))
    assert (r.action_type, r.ratio_num, r.ratio_denom, r.amount) == expected


def test_ledger_and_lineage(spark):
    raw = spark.createDataFrame([("A", "31-Mar-2024", "Bonus 1:1"), ("A", "-", "Bonus 1:1"), ("B", "2024-01-02", "AGM")], "symbol string, ex_date string, subject string")
    r = one(corpact.adjustment_ledger(raw))
    assert (r.symbol, r.ex_date, r.action_type) == ("A", dt.date(2024, 3, 31), "bonus")
    events = spark.createDataFrame([(day(1), "merger", "A| B ", "C")], "event_date date, event_type string, predecessor_symbols string, successor_symbols string")
    history = spark.createDataFrame([("C", "active", "IN1")], "symbol string, status string, isin string")
    got = {(r.symbol, r.direction, r.other, r.other_status) for r in corpact.lineage(events, history).collect()}
    assert got == {("C", "in", "A", None), ("C", "in", "B", None), ("A", "out", "C", "active"), ("B", "out", "C", "active")}


def test_scalars(spark):
    rows = [("31-Mar-2024",), ("31-March-2024",), ("31-03-2024",), ("2024-03-31",), ("-",), ("x",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(scalars.parse_date(F.col("s"))).collect()]
    assert got == [dt.date(2024, 3, 31)] * 4 + [None] * 3
    r = one(spark.range(1).select(
        scalars.period_end(F.lit("Jun 2024")).alias("q"), scalars.period_end(F.lit("Jun 2024"), True).alias("a"), scalars.period_end(F.lit("TTM")).alias("t"), scalars.snake_case(F.lit(" EPS in Rs +")).alias("s"),
        scalars.parse_number(F.lit("1,234.5%")).alias("n"), scalars.parse_number(F.lit("abc")).alias("m"), scalars.clean_label(F.lit(" Oil  Gas &amp; Consumable Fuels ")).alias("c"),
        scalars.split_list(F.lit("a| b||")).alias("l"), scalars.record_id(F.lit("12")).alias("i"), scalars.record_id(F.lit("x1")).alias("j"), scalars.sign_safe_growth(F.lit(120.0), F.lit(-100.0)).alias("g"), scalars.log10_positive(F.lit(-1.0)).alias("p")))
    assert (r.q, r.a, r.t) == (dt.date(2024, 6, 30), dt.date(2024, 3, 31), None)
    assert (r.s, r.n, r.m, r.c, r.l, r.i, r.j, r.g, r.p) == ("eps_in_rs", 1234.5, None, "Oil, Gas & Consumable Fuels", ["a", "b"], 12, 0, 2.2, None)


def test_drawdown_and_metrics(spark):
    r = spark.createDataFrame([("r", i, day(i), x, x, 0.0, x) for i, x in enumerate((0.1, -0.5, 0.2), 1)], "run_id string, cal_idx int, date date, gross double, net double, benchmark double, active double")
    d = one(metrics.max_drawdown(r).where("series = 'net'"))
    assert (d.max_drawdown, d.start_date, d.trough_date, d.recovery_date) == (pytest.approx(-0.5), day(1), day(2), None)
    s = one(metrics.series_statistics(r).where("series = 'net'"))
    assert s.cagr == pytest.approx(0.66 ** (252 / 3) - 1) and s.sortino is None


def test_asof_cases(spark):
    left = spark.createDataFrame([("a", day(5)), ("a", day(1)), ("b", day(9)), (None, day(9))], "k string, d date")
    right = spark.createDataFrame([("a", day(2), 1), ("a", day(5), 2), ("b", None, 3), ("c", day(1), 4)], "k string, e date, v int")
    got = {(r.k, r.d): r.v for r in asof.asof_join(left, right, ["k"], "d", "e").collect()}
    assert got == {("a", day(5)): 2, ("a", day(1)): None, ("b", day(9)): None, (None, day(9)): None}
    assert asof.asof_join(left, right, ["k"], "d", "e", how="inner").count() == 1


def test_schedule_falls_forward(spark):
    days = [dt.date(2018, 6, 28), dt.date(2018, 6, 29), dt.date(2018, 7, 2), dt.date(2018, 7, 3), dt.date(2018, 9, 28), dt.date(2018, 10, 1)]
    cal = timeline.calendar(spark.createDataFrame([(d,) for d in days], "date date"))
    universe = spark.createDataFrame([(dt.date(2018, 6, 30),)], "quarter_end_date date")
    s = timeline.schedule(configs_table(spark, [Config("r", start=dt.date(2018, 6, 30))]), cal, universe)
    assert sorted(r.rebal_date for r in s.collect()) == [dt.date(2018, 7, 2), dt.date(2018, 9, 28)]
    t = timeline.trade_dates(s.withColumn("rebal_offset", F.lit(1)), cal)
    assert sorted(r.trade_date for r in t.collect()) == [dt.date(2018, 7, 3), dt.date(2018, 10, 1)]


@pytest.fixture(scope="module")
def small(spark):
    """Three symbols over 40 days; C stops trading on day 20, D starts late."""
    rng = random.Random(2)
    rows = []
    for s in "ABCD":
        p = 100.0
        for i in range(60):
            p *= 1 + rng.uniform(-0.05, 0.05)
            if (s == "C" and i > 25) or (s == "D" and i < 30) or rng.random() < 0.1:
                continue
            rows.append((day(i), s, p, 1000.0))
    quotes = spark.createDataFrame(rows, "date date, symbol string, close double, volume double")
    u = [(day(q), i + 1, s, 1e9 / (i + 1), 5e8 / (i + 1), 100.0, 1e7, 5e6) for q in (5, 20, 35) for i, s in enumerate("ABCD" if q == 35 else "ABC")]
    universe = spark.createDataFrame(u, "quarter_end_date date, rank int, symbol string, market_cap_inr double, free_float_market_cap_inr double, close_inr double, shares_outstanding double, free_float_shares double")
    sectors = spark.createDataFrame([("A", "x"), ("B", "y")], "symbol string, sector string")
    bench = spark.createDataFrame([(day(i), 1000.0 + i) for i in range(3, 50)], "date date, close double")
    fin = spark.createDataFrame([], "symbol string, date date, parameter string, value double")
    return rows, quotes, universe, sectors, bench, fin


def run(spark, small, **changes):
    _, quotes, universe, sectors, bench, fin = small
    m = Market.build(quotes, universe, sectors, fin, bench)
    c = Config(**({"run_id": "r", "rebal_freq": "custom", "custom_rebal_dates": [day(8), day(22), day(40)], "max_stock_wt": None} | changes))
    return m, run_strategies(m, configs_table(spark, [c]))


def test_the_panel_has_the_names_of_the_universe(spark, small):
    """Names that are never in the universe make no row a day; their days are days of the calendar all the same."""
    _, quotes, universe, sectors, bench, fin = small
    more = quotes.limit(1).withColumns({"symbol": F.lit("never"), "date": F.date_add(F.lit(day(0)), 1000)})
    m = Market.build(quotes.unionByName(more), universe, sectors, fin, bench)
    assert {r.symbol for r in m.series.collect()} == {r.symbol for r in m.dense.select("symbol").distinct().collect()} == {r.symbol for r in universe.select("symbol").distinct().collect()}
    assert m.cal.count() == quotes.select("date").distinct().count() + 1


def test_quotes_of_some_names_or_days_are_made_of_their_rows_alone(spark, tmp_path):
    """The choice of names or days is made before anything is shuffled or sorted, and both steps of the quotes take one shuffle."""
    from tickerloom import fixtures

    rows = [(1, 1, 5, 1, 2.0, 100.0, 1), (1, 2, 5, 1, 3.0, 90.0, 1), (1, 2, 6, 1, 4.0, 80.0, 1), (1, 2, 6, 1, 4.0, 80.0, 1), (None, 1, 5, 1, 1.0, 70.0, 1), (3, 1, 5, None, 1.0, None, 1), (4, 1, 5, None, 2.0, 60.0, 1), (4, 1, 5, 2, 2.0, 50.0, 2), (5, 1, 5, 2, None, 40.0, None)]
    lines = spark.createDataFrame([(*r[:6], None if r[6] is None else dt.datetime(2020, 3, r[6])) for r in rows], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    df = fixtures.panel(spark, str(tmp_path), "fx_quotes")
    whole = spark.sql(fixtures.QUOTES, lineitem=lines)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, df.collect())) == sorted(map(key, whole.select(*df.columns).collect())) and df.count() == 4
    names = F.broadcast(spark.createDataFrame([("S1",)], "symbol string"))
    days = F.broadcast(spark.createDataFrame([(dt.date(2020, 3, 1),)], "date date"))
    for chosen, on, n in ((names, "symbol", 1), (days, "date", 2)):
        some = df.join(chosen, on, "left_semi")
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Window") < plan.index("Exchange hashpartitioning") < plan.index("LeftSemi"), plan
        assert plan.count("Exchange hashpartitioning") == 1 and some.count() == n


def test_the_market_has_the_figures_of_its_names(spark, small):
    _, quotes, universe, sectors, bench, _ = small
    fin = spark.createDataFrame([(s, day(3), "net_profit", 1.0) for s in ("A", "D", "never")], "symbol string, date date, parameter string, value double")
    m = Market.build(quotes, universe, sectors, fin, bench)
    assert {r.symbol for r in m.financials.collect()} == {"A", "D"} and m.financials.columns == fin.columns


def test_raw_figures_are_summed_in_one_pass(spark):
    from tickerloom import fixtures

    df = fixtures.panel(spark, "/root/testdata/sf0.001", "fx_fin_raw")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.line_item for r in df.select("line_item").distinct().collect()} == set(fixtures.FIN_ITEMS)


def test_holdings_equal_the_daily_recurrence(spark, small):
    rows = small[0]
    m, r = run(spark, small, cash_buffer=0.1)
    wanted = {}
    for t in r.targets.collect():
        wanted.setdefault(t.rebal_date, {})[t.symbol] = t.weight
    days = sorted({x[0] for x in rows})
    at = {(d, s): p for d, s, p, _ in rows}
    last = {s: max(d for d, k, *_ in rows if k == s) for s in "ABCD"}
    trade = {days[days.index(d) + 1]: w for d, w in wanted.items()}
    closes, held, expected = {}, {"CASH": 1.0}, {}
    for d in days:
        before = dict(closes)
        for s in "ABCD":
            if (d, s) in at:
                closes[s] = at[(d, s)]
        for s in [s for s in held if s != "CASH" and last[s] < d]:
            held["CASH"] = held.get("CASH", 0) + held.pop(s)
        if d in trade:
            held = dict(trade[d])
        grown = {s: w * (1 + (0 if s == "CASH" or s not in before else closes[s] / before[s] - 1)) for s, w in held.items()}
        total = sum(grown.values())
        expected[d] = total - 1
        held = {s: w / total for s, w in grown.items()}
    got = {x.date: x.gross for x in r.returns.collect()}
    assert got == pytest.approx(expected, abs=1e-12)
    final = {x.symbol: x.weight for x in r.weights.where(F.col("date") == F.lit(days[-1])).collect()}
    assert final == pytest.approx(held, abs=1e-12)
    res = one(attribution.identity_residuals(r.contribution(m), r.returns, r.weights))
    assert max(res.gross_residual, res.net_residual, res.weight_residual) < 1e-12


def test_joint_caps_hold(spark, small):
    _, r = run(spark, small, max_stock_wt=0.5, max_sector_wt=0.6)
    for t in r.targets.groupBy("rebal_date").agg(F.sum("weight").alias("s"), F.max("weight").alias("m")).collect():
        assert t.s == pytest.approx(1) and t.m <= 0.5 + 1e-9


def test_targets_never_look_ahead(spark, small):
    _, quotes, universe, sectors, bench, fin = small
    later = quotes.withColumn("close", F.when(F.col("date") > F.lit(day(22)), F.col("close") * 3).otherwise(F.col("close")))
    c = configs_table(spark, [Config("r", rebal_freq="custom", custom_rebal_dates=[day(8), day(22)], max_stock_wt=None, min_price=50.0)])
    rows = lambda q: sorted(map(tuple, targets(Market.build(q, universe, sectors, fin, bench), c).collect()))
    assert rows(quotes) == rows(later)


def test_user_signal_and_filter(spark, small, monkeypatch):
    monkeypatch.setitem(signals.SIGNALS, "own", lambda tables, pool: pool.select("run_id", "rebal_date", "symbol", F.col("rank").cast("double").alias("raw")))
    _, quotes, universe, sectors, bench, fin = small
    m = Market.build(quotes, universe, sectors, fin, bench)
    c = configs_table(spark, [Config("r", rebal_freq="custom", custom_rebal_dates=[day(40)], signal="own", signal_top_n=1, max_stock_wt=None)])
    assert one(targets(m, c, extra=[lambda t, pool: pool.where("symbol <> 'D'")])).symbol == "C"
    with pytest.raises(ValueError, match="needs a signal"):
        configs_table(spark, [Config("r", weighting="ffmcap_tilt")])


def test_sections_and_annual_items(spark):
    raw = spark.createDataFrame([("A", day(1), k, v) for k, v in (("share_capital", 10.0), ("reserves", 5.0), ("total_assets", 40.0), ("cash_from_operating_activity", 7.0), ("cash_from_investing_activity", -2.0), ("opm", 9.0), ("odd_item", 1.0))], "symbol string, date date, line_item string, value double")
    got = {r.parameter: r.value for r in fundamentals.derived(fundamentals.canonical(raw), annual=True).collect()}
    assert got == {"total_assets": 40.0, "cfo": 7.0, "cfi": -2.0, "odd_item": 1.0, "net_equity": 15.0, "total_liabilities": 25.0, "fcf": 5.0}


PAGE = """<html><body><a href="/market/IN03/" title="Broad Sector">Energy</a> <a class="x" href="#">no</a>
<a href="/market/IN03/IN0301/" title="Sector">Oil Gas &amp; Consumable Fuels</a>
<section id="quarters"><table class="data-table"><thead><tr><th></th><th>Mar 2024</th><th>TTM</th></tr></thead><tbody><tr><td>Sales +</td><td>1,200</td><td>5</td></tr><tr><td>OPM %</td><td>12%</td><td></td></tr></tbody></table></section>
<section id="balance-sheet"><table><thead><tr><th>x</th><th>Mar 2023</th></tr></thead><tbody><tr><td>Reserves</td><td>77.5</td></tr><tr><td></td><td>3</td></tr></tbody></table></section></body></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([("A", PAGE), ("B", None), ("C", "<p>nothing</p>")], "symbol string, html string")
    got = {(r.symbol, r.period, r.line_item, r.date, r.value) for r in extract.page_financials(pages).collect()}
    assert got == {("A", "quarterly", "sales", dt.date(2024, 3, 31), 1200.0), ("A", "quarterly", "opm", dt.date(2024, 3, 31), 12.0), ("A", "annual", "reserves", dt.date(2023, 3, 31), 77.5)}
    r = one(extract.page_classification(pages))
    assert (r.macro_sector, r.macro_code, r.sector, r.sector_code, r.industry) == ("Energy", "IN03", "Oil, Gas & Consumable Fuels", "IN0301", None)


def test_filings(spark, tmp_path):
    fact = lambda c, n: f'<x:NumberOfShares decimals="0" contextRef="{c}I" unit="u">{n}</x:NumberOfShares>'
    pad = " " * 5000
    files = {
        "A_2024-03-31_7.xml": fact("ShareholdingPattern", 100) + fact("ShareholdingOfPromoterAndPromoterGroup", 40) + pad,
        "A_2024-03-31_9.xml": fact("ShareholdingPattern", 120) + fact("ShareholdingOfPromoterAndPromoterGroup", 40) + pad,
        "B_2024-03-31_1.xml": fact("ShareholdingPattern", 50) + pad, "C_2024-03-31_1.xml": fact("ShareholdingPattern", 50), "D_2024-03-31_1.xml": fact("ShareholdingPattern", 5) + "ShareholdingOfPromoterAndPromoterGroup" + pad,
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = {r.symbol: (r.total_shares, r.promoter_shares, r.free_float_shares) for r in extract.filing_shares(readers.read_filings(spark, str(tmp_path))).collect()}
    assert got == {"A": (120, 40, 80), "B": (50, 0, 50)}


def test_readers(spark, tmp_path):
    at = str(tmp_path)
    rows = spark.createDataFrame([(day(1), "A", "close", 1.5), (day(1), "A", "open", float("nan"))], "date date, symbol string, parameter string, value double")
    readers.write_long_panel(rows, f"{at}/panel")
    back = readers.read_long_panel(spark, f"{at}/panel")
    assert {tuple(r) for r in back.collect()} == {(day(1), "A", "close", 1.5), (day(1), "A", "open", None)}
    assert "PartitionFilters: [isnotnull(parameter" in back.where("parameter = 'close'")._jdf.queryExecution().executedPlan().toString()
    assert readers.read_optional(spark, f"{at}/absent", "a int").count() == 0
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "bhav20240105.csv").write_text("SYMBOL, SERIES ,OPEN,CLOSE\nA, EQ ,1,2\nB,BE,1,2\n")
    r = one(readers.read_daily(spark, f"{at}/q", "classic"))
    assert (r.symbol, r.date, r.open, r.close, r.volume) == ("A", dt.date(2024, 1, 5), 1.0, 2.0, None)
    (tmp_path / "listed.csv").write_text("SYMBOL,NAME OF COMPANY, SERIES, DATE OF LISTING, ISIN NUMBER\nA,Alpha,EQ,01-JAN-2001,IN1\nA,Alpha,EQ,02-JAN-2001,IN1\nB,Beta,BE,,IN2\n")
    r = one(readers.read_listed(spark, f"{at}/listed.csv"))
    assert (r.symbol, r.isin, r.listing_date) == ("A", "IN1", dt.date(2001, 1, 1))
    (tmp_path / "ev").mkdir()
    (tmp_path / "ev" / "A.json").write_text(json.dumps([{"exDate": "01-Jan-2024", "subject": "Bonus 1:1"}]))
    assert tuple(one(readers.read_events(spark, f"{at}/ev"))) == ("A", "01-Jan-2024", "Bonus 1:1")
    (tmp_path / "idx.json").write_text(json.dumps({"data": [{"symbol": "A", "date": "31-Mar-2024", "xbrl": "u/f.xml", "recordId": 5}, {"symbol": "A", "date": "31-Mar-2024", "xbrl": "u/-", "recordId": 6}]}))
    assert tuple(one(readers.read_filings_index(spark, f"{at}/idx.json"))) == ("A", dt.date(2024, 3, 31), "u/f.xml", 5)
    gaps = spark.createDataFrame([("s", "A", "r", "m")], "script string, symbol string, reason string, error_msg string")
    readers.append_gaps(gaps, f"{at}/gaps", "2024-01-01")
    readers.append_gaps(gaps, f"{at}/gaps", "2024-01-02")
    assert readers.read_table(spark, f"{at}/gaps", "GAPS").count() == 2
    assert readers.fingerprints(spark, f"{at}/q").count() == 1
    levels = [spark.createDataFrame([(day(1), 1.0), (day(2), 2.0)], "date date, close double"), spark.createDataFrame([(day(2), 3.0)], "date date, close double")]
    assert {tuple(r) for r in readers.consolidate_levels(levels).collect()} == {(day(1), 1.0), (day(2), 3.0)}
    with pytest.raises(ValueError, match="no benchmark"):
        readers.benchmark_level(spark, {}, "x")
    with pytest.raises(ValueError, match="no level"):
        readers.taxonomy(gaps, "x")
    with pytest.raises(ValueError, match="lacks the columns z"):
        require_columns(gaps, ["z"])
    assert no_nan(rows).where("value is null").count() == 1


def test_bundle_is_written(spark, small, tmp_path):
    _, r = run(spark, small)
    readers.write_result(r, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "weights")).where("run_id = 'r'").count() == r.weights.count()
    assert "net_cagr" in spark.read.text(str(tmp_path / "out" / "summary")).first()[0]


def test_universe_pieces(spark):
    rows = spark.createDataFrame([(day(1), "A", "close", 1.0), (day(1), "A", "close", 2.0)], "date date, symbol string, parameter string, value double")
    assert one(panel.upsert(rows.limit(1), rows.where("value = 2"))).value == 2.0


def test_asof_rows_without_a_key_match_nothing(spark):
    from tickerloom.operators.asof import asof_join

    left = spark.createDataFrame([("a", "2020-01-05"), (None, "2020-01-05"), ("b", "2020-01-05"), ("a", None)], "k string, d string").selectExpr("k", "cast(d as date) as d")
    right = spark.createDataFrame([("a", "2020-01-01", 1), ("a", "2020-01-01", 3), ("a", "2020-01-01", 2), (None, "2020-01-01", 9), ("b", None, 8)], "k string, at string, v int").selectExpr("k", "cast(at as date) as at", "v")
    got = {(r.k, r.d is None): r.v for r in asof_join(left, right, ["k"], "d", "at").collect()}
    assert got == {("a", False): 3, (None, False): None, ("b", False): None, ("a", True): None}
    assert asof_join(left, right, ["k"], "d", "at", how="inner").count() == 1
