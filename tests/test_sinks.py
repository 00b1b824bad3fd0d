"""Sinks that are written again, chains of events, schema guards and joint caps on small tables."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import corpact, panel, quality, weights
from tickerloom.sources import sinks

DAY = dt.date(2024, 1, 5)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def test_upsert_rewrites_only_what_changes(spark, tmp_path):
    path = f"{tmp_path}/shares"
    rows = spark.createDataFrame([(s, dt.date(y, 3, 31), 1) for s in "ABC" for y in (2020, 2021, 2022)], "symbol string, date date, total_shares long")
    assert sinks.upsert_shares(spark, path, rows) == 3
    before = files(path)
    new = spark.createDataFrame([("A", dt.date(2021, 3, 31), 5, 9), ("D", dt.date(2021, 6, 30), 6, None), ("A", dt.date(2025, 3, 31), 7, 8)], "symbol string, date date, total_shares int, public_shares long")
    assert sinks.upsert_shares(spark, path, new.withColumn("total_shares", F.col("total_shares").cast("long"))) == 2
    after = files(path)
    assert {k: v for k, v in before.items() if "year=2021" not in k} == {k: v for k, v in after.items() if "year=2021" not in k and "year=2025" not in k}
    got = {(r.symbol, r.date.isoformat()): (r.total_shares, r.public_shares) for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert len(got) == 11 and got["A", "2021-03-31"] == (5, 9) and got["D", "2021-06-30"] == (6, None) and got["B", "2021-03-31"] == (1, None) and got["A", "2025-03-31"] == (7, 8)
    assert sinks.upsert_shares(spark, path, rows.where("1 = 0")) == 0 and files(path) == after
    with pytest.raises(ValueError, match="symbol or date"):
        sinks.upsert_shares(spark, path, rows.withColumn("date", F.lit(None).cast("date")))


def test_upserts_by_symbol_and_into_a_panel(spark, tmp_path):
    one = spark.createDataFrame([(f"S{i}", "old") for i in range(40)], "symbol string, sector string")
    sinks.upsert_classification(spark, f"{tmp_path}/c", one)
    before = files(f"{tmp_path}/c")
    assert sinks.upsert_classification(spark, f"{tmp_path}/c", one.where("symbol = 'S7'").withColumn("sector", F.lit("new"))) == 1
    after = files(f"{tmp_path}/c")
    assert len([k for k in before if after.get(k) == before[k]]) == len(before) - 1
    assert {r.symbol for r in spark.read.parquet(f"{tmp_path}/c").where("sector = 'new'").collect()} == {"S7"}
    long = spark.createDataFrame([(DAY, "A", "close", 1.0), (DAY, "A", "volume", 2.0), (DAY.replace(year=2023), "A", "close", 3.0)], "date date, symbol string, parameter string, value double")
    sinks.upsert_panel(spark, f"{tmp_path}/p", long)
    assert sinks.upsert_panel(spark, f"{tmp_path}/p", long.where("parameter = 'volume'").withColumn("value", F.lit(9.0))) == 1
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_path}/p").collect()) == [1.0, 3.0, 9.0]


def test_reports_of_a_day_replace_each_other(spark, tmp_path):
    path = f"{tmp_path}/checks"
    assert sinks.read_report(spark, path, sinks.CHECKS).count() == 0
    checks = spark.createDataFrame([("a", "PASS", 1.0, None), ("b", "FAIL", 2.0, "x")], "name string, status string, metric double, detail string")
    sinks.write_checks(checks, path, DAY, "prices")
    sinks.write_checks(checks, path, DAY, "shares")
    kept = files(path)
    sinks.write_checks(checks.where("name = 'a'"), path, DAY, "prices")
    assert {k: v for k, v in files(path).items() if "shares" in k} == {k: v for k, v in kept.items() if "shares" in k}
    assert sinks.read_report(spark, path, sinks.CHECKS).count() == 3 and sinks.read_report(spark, path, sinks.CHECKS, DAY, "prices").count() == 1
    plan = sinks.read_report(spark, path, sinks.CHECKS, DAY, "prices")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
    with pytest.raises(ValueError, match="detail"):
        sinks.write_checks(checks.drop("detail"), path, DAY, "prices")
    moves = spark.createDataFrame([("A", DAY, 1.0, 0.7)], "symbol string, date date, close double, change double")
    for df, n in ((moves, 1), (moves.unionByName(moves), 2), (moves.where("1 = 0"), 0)):
        sinks.write_outliers(df, f"{tmp_path}/outliers", DAY)
        assert sinks.read_report(spark, f"{tmp_path}/outliers", sinks.OUTLIERS, DAY).count() == n


def test_checks_that_are_written_twice_are_computed_once(spark, monkeypatch):
    from tickerloom import landed_queries

    written, write = [], sinks.write_checks
    monkeypatch.setattr(sinks, "write_checks", lambda df, path, day, group: (written.append((day, group, df._jdf.queryExecution().optimizedPlan().toString())), write(df, path, day, group)))
    landed_queries.checks_sink(spark, "/root/testdata/sf0.01")
    again = [plan for day, _, plan in written if day == landed_queries.AS_OF][1:]  # the first is of another threshold
    assert len(again) == 6 and not any("Aggregate" in plan for plan in again)


def test_chains_of_events_end_in_cycles(spark):
    pairs = [(f"C{i}", f"C{i + 1}") for i in range(10)] + [("R0", "R1"), ("R1", "R2|X"), ("R2", "R0"), ("self", "self"), (None, "Y"), ("Z", "")]
    events = spark.createDataFrame([(DAY, "rename", a, b) for a, b in pairs + pairs[:3]], "event_date date, event_type string, predecessor_symbols string, successor_symbols string")
    found = {(r.symbol, r.direction, r.other): (r.hop, r.path) for r in corpact.lineage_paths(events).collect()}
    assert found["C0", "out", "C10"] == (10, [f"C{i}" for i in range(11)]) and found["C10", "in", "C0"][0] == 10
    assert found["R0", "out", "X"] == (2, ["R0", "R1", "X"]) and found["R0", "out", "R2"][0] == 2 and ("R0", "out", "R0") not in found
    assert {k[0] for k in found} == {f"C{i}" for i in range(11)} | {"R0", "R1", "R2", "X"}
    assert corpact.lineage_paths(events.where("1 = 0")).count() == 0


def test_chains_have_no_limit_of_rows(spark):
    """The recursion of SQL gives up at a number of rows, by default a million."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        pairs = [(f"C{i:03}", f"C{i + 1:03}") for i in range(12)] + [("C000", "D"), ("D", "C002")]
        events = spark.createDataFrame([(DAY, "rename", a, b) for a, b in pairs], "event_date date, event_type string, predecessor_symbols string, successor_symbols string")
        found = {(r.symbol, r.direction, r.other): (r.hop, r.path) for r in corpact.lineage_paths(events).collect()}
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    # each pair once, by its least path
    assert len(found) == 2 * (13 * 12 // 2 + 1 + 11) and found["C000", "out", "C002"] == (2, ["C000", "C001", "C002"]) and found["C012", "in", "D"] == (11, [*(f"C{i:03}" for i in range(12, 1, -1)), "D"])


def test_schema_guards_name_what_is_off(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "date int, symbol string, more double")
    row = quality.schema_check("prices_exists", df, "date DATE, symbol STRING, value DOUBLE", spark).first()
    assert (row.status, row.metric, row.detail) == ("FAIL", 2.0, "date int, value missing")
    assert quality.schema_check("t", df, "symbol STRING", spark).first().status == "PASS"
    assert quality.schema_check("t", None, "symbol STRING", spark).first()["detail"] == "no table"
    found = {r.name: r.status for r in quality.validate(quality.Tables(shares=df, metadata=df), spark, DAY).collect()}
    assert found == {f"{n}_exists": "FAIL" for n in quality.LAYOUTS}


def test_joint_caps_go_on_only_with_what_moves(spark):
    """One rebalance needs no second pass, one some, one has a single cap."""
    rows = [("one", f"s{i}", f"g{i}", 0.1, 0.2, 0.5) for i in range(10)]
    raw = [0.3, 0.2, 0.15, 0.1, 0.08, 0.07, 0.05, 0.05]
    rows += [("many", f"s{i}", "g" + "aabbcdef"[i], w, 0.16, 0.22) for i, w in enumerate(raw)]
    rows += [("single", f"s{i}", "g", w, 0.16, None) for i, w in enumerate(raw)]
    df = spark.createDataFrame([(k, DAY, s, g, w, a, b, None, "small") for k, s, g, w, a, b in rows], "run_id string, rebal_date date, symbol string, sector string, raw_weight double, max_stock_wt double, max_sector_wt double, max_size_bucket_wt map<string,double>, size_bucket string")
    moving = []
    got = weights.capped(df, moving).collect()
    assert moving[0] == 1 and moving[-1] == 0 and len(moving) > 2 and set(moving[:-1]) == {1}
    by = lambda k: [r for r in got if r.run_id == k]
    assert len(got) == len(rows) and all(abs(sum(r.weight for r in by(k)) - 1) < 1e-9 for k in ("one", "many", "single"))
    assert all(r.weight == pytest.approx(0.1) for r in by("one")) and max(r.weight for r in by("many")) < 0.16 + 1e-9 and max(r.weight for r in by("single")) == pytest.approx(0.16)
    sectors = {}
    for r in by("many"):
        sectors[r.sector] = sectors.get(r.sector, 0) + r.weight
    assert max(sectors.values()) < 0.22 + 1e-9


def test_rolling_median_is_exact(spark):
    import random
    import statistics

    rng = random.Random(4)
    values = [None if rng.random() < 0.3 else float(rng.randrange(20)) for _ in range(200)]
    dense = spark.createDataFrame([("A", i, v, 2.0) for i, v in enumerate(values)], "symbol string, cal_idx int, close_raw double, volume double")
    got = {r.cal_idx: r.adv for r in panel.with_adv(dense, 15, 6).collect()}
    for i in range(200):
        own = [2 * v for v in values[max(0, i - 14) : i + 1] if v is not None]
        assert got[i] == (statistics.median(own) if len(own) >= 6 else None)


@pytest.mark.parametrize(("subject", "expected"), [
    ("Dividend Rs 5 Per Share On Face Value Rs 2", ("dividend", None, None, 5.0)), ("Interim Dividend Rs 12 Per Share And Face Value Split From Rs 10 To Rs 2", ("split", 10.0, 2.0, None)),
    ("Interim Dividend Rs 12 Per Share / Face Value Rs 10", ("dividend", None, None, 12.0)), ("Dividend Rs 5 Per Share 10", ("dividend", None, None, 5.0)), ("Share 10 Dividend Re 0.50", ("dividend", None, None, 0.5)),
    ("Face Value Rs 10 Dividend Rs 4", ("dividend", None, None, 4.0)), ("Fv Split Rs.10/- Per Share To Rs.2/-", ("split", 10.0, 2.0, None)), ("Split Rs.10/- Of Re.1/-", ("split", 10.0, 1.0, None)),
    ("Dividend Of Rs 5 And Split Of Rs 10 To Rs 2", ("split", 10.0, 2.0, None)), ("Bonus 2:1 Of Face Value Rs 10", ("bonus", 2.0, 1.0, None)), ("Face Value Split From Rs 2 To Rs 10", (None,) * 4),
    ("Dividend Rs 12 Per Share " + "x" * 50 + " Split To Rs 2", ("dividend", None, None, 12.0)), ("Split From Rs 10 Into Rs 5", ("split", 10.0, 5.0, None)), ("", (None,) * 4),
])
def test_subjects_bind_their_sums(spark, subject, expected):
    r = corpact.classify_subject(spark.createDataFrame([(subject,)], "subject string")).first()
    assert (r.action_type, r.ratio_num, r.ratio_denom, r.amount) == expected


def lineage_of_scan(plan: str, mark: str) -> list[str]:
    """The operators above the scan whose line holds mark, from the scan up."""
    lines = [x for x in plan.splitlines() if x.strip(" :+-")]
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    at = next(i for i, x in enumerate(lines) if mark in x and "Scan" in x)
    out, d = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < d:
            out.append(x.lstrip(" :+-"))
            d = depth(x)
    return out


def test_the_panel_isnt_shuffled_for_pools_holdings_and_costs(spark):
    """Holdings and names move to the panel's buckets; the panel stays where it lies."""
    from tickerloom.operators import holdings, select, timeline
    from tickerloom.plans.runs import Config, Market, configs_table

    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    quotes = spark.createDataFrame([(d, s, 10.0 + i % 7, 5.0) for i, d in enumerate(days) for s in "ABCD"], "date date, symbol string, close double, volume double")
    universe = spark.createDataFrame([(dt.date(2020, 1, 1), i + 1, s, 1e6, 1e6, 10.0, 100.0, 60.0) for i, s in enumerate("ABCD")], "quarter_end_date date, rank int, symbol string, market_cap_inr double, free_float_market_cap_inr double, close_inr double, shares_outstanding double, free_float_shares double")
    sectors = spark.createDataFrame([(s, "x") for s in "ABCD"], "symbol string, sector string")
    nothing = spark.createDataFrame([], "symbol string, date date, parameter string, value double")
    m = Market.build(quotes, universe, sectors, nothing, quotes.select("date", "close").distinct())
    row = m.series.where("symbol = 'B'").first()
    assert row.closes == [10.0 + i % 7 for i in range(120)] and row.first_idx == 0 and row.last_valid == days[-1] and row.advs[:9] == [None] * 9 and row.advs[9] is not None
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        configs = configs_table(spark, [Config("r", max_stock_wt=None, rebal_freq="M")])
        pool = select.pool(m, timeline.schedule(configs, m.cal, m.universe), configs)
        wanted = spark.createDataFrame([("r", days[30], "A", 1.0)], "run_id string, rebal_date date, symbol string, weight double")
        segs = spark.createDataFrame([("r", days[30], 31, days[31], 60)], "run_id string, rebal_date date, trade_idx int, trade_date date, end_idx int")
        values = holdings.values(wanted, segs, m)
        traded = spark.createDataFrame([("r", days[30], days[31], 31, "A", "x", 1.0, 1.0, 0.0, 1.0)], "run_id string, rebal_date date, trade_date date, trade_idx int, symbol string, sector string, raw_weight double, target_weight double, drift_weight double, delta_weight double")
        for df, mark in ((pool, "closes#"), (values, "closes#"), (holdings.costs(traded, configs, m), "advs#")):
            above = lineage_of_scan(df._jdf.queryExecution().executedPlan().toString(), mark)
            join = next(i for i, x in enumerate(above) if "SortMergeJoin" in x)
            assert not any("Exchange" in x for x in above[:join]), above
        assert values.count() == 31 and values.where("cal_idx = 30").first().value == 1.0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
