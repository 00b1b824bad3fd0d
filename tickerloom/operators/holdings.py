"""Holdings between trades in closed form, trades, costs and returns.

Between trades a holding's value is its target weight times the growth of its filled close since the close before
the trade day, so each day's weights need no day before: no loop over days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.asof import snapshot_asof
from tickerloom.operators.signals import standardised
from tickerloom.schemas import CASH


def segments(trades: DataFrame, bounds: DataFrame) -> DataFrame:
    """trades (run_id, rebal_date, trade_idx, trade_date) with end_idx, the last day before the run's next trade or its end; bounds (run_id, last_idx)."""
    after = F.lead("trade_idx").over(Window.partitionBy("run_id").orderBy("trade_idx"))
    return trades.join(bounds, "run_id").withColumn("end_idx", F.coalesce(after - 1, F.col("last_idx"))).where("trade_idx <= last_idx").drop("last_idx")


def values(targets: DataFrame, segs: DataFrame, tables) -> DataFrame:
    """(run_id, trade_idx, trade_date, cal_idx, date, symbol, label, value): daily values in units of the wealth before the trade; from the day before it, as the value 1 in sum.

    A holding whose last valid close is past, or that never had one, keeps its value under the label CASH from the day after the trade.
    """
    held = targets.select("run_id", "rebal_date", "symbol", F.col("weight").alias("_w")).join(segs, ["run_id", "rebal_date"])
    series = tables.series.select("symbol", "closes", "first_close", "last_valid")
    # each holding meets its symbol's row once; its days are read from the arrays before they become rows
    at = lambda i: F.coalesce(F.get("closes", i), F.col("first_close"))
    growth = lambda i: F.when(F.col("symbol") == CASH, 1.0).otherwise(F.coalesce(F.try_divide(at(i), at(F.col("trade_idx") - 1)), F.lit(1.0)))
    days = F.transform(F.sequence(F.col("trade_idx") - 1, F.col("end_idx")), lambda i: F.struct(i.alias("cal_idx"), (F.col("_w") * growth(i)).alias("value")))
    daily = held.join(series, "symbol", "left").select("run_id", "trade_idx", "trade_date", "symbol", "last_valid", F.explode(days).alias("_d"))
    out = daily.select("run_id", "trade_idx", "trade_date", "symbol", "last_valid", "_d.*").join(F.broadcast(tables.cal), "cal_idx", "left")
    gone = (F.col("date") > F.col("trade_date")) & (F.col("last_valid").isNull() | (F.col("last_valid") < F.col("date")))
    label = F.when((F.col("symbol") == CASH) | gone, CASH).otherwise(F.col("symbol"))
    return out.select("run_id", "trade_idx", "trade_date", "cal_idx", "date", "symbol", label.alias("label"), "value", "last_valid")


def gross_returns(vals: DataFrame) -> DataFrame:
    """(run_id, cal_idx, date, gross) of the days from each run's first trade."""
    wealth = vals.groupBy("run_id", "trade_idx", "cal_idx", "date").agg(F.sum("value").alias("v"))
    before = F.lag("v").over(Window.partitionBy("run_id", "trade_idx").orderBy("cal_idx"))
    return wealth.withColumn("gross", F.col("v") / before - 1).where("cal_idx >= trade_idx").select("run_id", "cal_idx", "date", "gross")


def daily_weights(vals: DataFrame) -> DataFrame:
    """(run_id, cal_idx, date, symbol, weight) after each day's drift, with CASH as a symbol."""
    days = vals.where("cal_idx >= trade_idx").groupBy("run_id", "cal_idx", "date", F.col("label").alias("symbol")).agg(F.sum("value").alias("v"))
    return days.withColumn("weight", F.col("v") / F.sum("v").over(Window.partitionBy("run_id", "cal_idx"))).drop("v")


def cash_before_first_trade(trades: DataFrame, bounds: DataFrame, cal: DataFrame) -> DataFrame:
    """Days of a run, from bounds.first_idx on, before its first trade: (run_id, cal_idx, date), all in cash."""
    first = trades.groupBy("run_id").agg(F.min("trade_idx").alias("first_trade"))
    span = bounds.join(first, "run_id", "left").withColumn("until", F.coalesce(F.col("first_trade") - 1, F.col("last_idx"))).where("first_idx <= until")
    return span.select("run_id", F.explode(F.sequence("first_idx", "until")).alias("cal_idx")).join(F.broadcast(cal), "cal_idx")


def trades_table(targets: DataFrame, segs: DataFrame, vals: DataFrame) -> DataFrame:
    """(run_id, rebal_date, trade_date, trade_idx, symbol, sector, raw_weight, target_weight, drift_weight, delta_weight): holdings before and after each trade.

    What is delisted by a trade day is cash before the trade, so it bears no cost.
    """
    last = vals.join(segs.select("run_id", "trade_idx", "end_idx"), ["run_id", "trade_idx"]).where("cal_idx = end_idx")
    following = segs.select("run_id", (F.col("trade_idx") - 1).alias("end_idx"), F.col("trade_idx").alias("next_idx"), F.col("trade_date").alias("next_date"))
    before = last.join(following, ["run_id", "end_idx"])
    gone = F.col("last_valid").isNull() | (F.col("last_valid") < F.col("next_date"))
    before = before.withColumn("symbol", F.when((F.col("symbol") == CASH) | gone, CASH).otherwise(F.col("symbol")))
    before = before.groupBy("run_id", F.col("next_idx").alias("trade_idx"), "symbol").agg(F.sum("value").alias("v"))
    before = before.withColumn("drift_weight", F.col("v") / F.sum("v").over(Window.partitionBy("run_id", "trade_idx"))).drop("v")
    start = segs.groupBy("run_id").agg(F.min("trade_idx").alias("trade_idx")).select("run_id", "trade_idx", F.lit(CASH).alias("symbol"), F.lit(1.0).alias("drift_weight"))
    after = targets.join(segs.select("run_id", "rebal_date", "trade_idx"), ["run_id", "rebal_date"]).select("run_id", "trade_idx", "symbol", "sector", "raw_weight", F.col("weight").alias("target_weight"))
    both = before.unionByName(start).join(after, ["run_id", "trade_idx", "symbol"], "full_outer")
    filled = both.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("raw_weight", "target_weight", "drift_weight")})
    named = filled.join(segs.select("run_id", "trade_idx", "trade_date", "rebal_date"), ["run_id", "trade_idx"])
    return named.select("run_id", "rebal_date", "trade_date", "trade_idx", "symbol", "sector", "raw_weight", "target_weight", "drift_weight", (F.col("target_weight") - F.col("drift_weight")).alias("delta_weight"))


def costs(trades: DataFrame, configs: DataFrame, tables) -> DataFrame:
    """Traded names with cost_bps: base plus a charge on the positive part of an illiquidity score.

    The score adds the z-scores of small capitalisation, small traded value and small free float within
    a trade's names, as of the trade date, clipped at 5, and is standardised again; missing parts count as 0.
    """
    traded = trades.where((F.col("symbol") != CASH) & (F.abs("delta_weight") > 1e-9))
    at = snapshot_asof(traded, tables.universe, "trade_date") if not tables.universe.isEmpty() else traded.withColumn("quarter_end_date", F.lit(None).cast("date"))
    traded = traded.join(at.select("run_id", "trade_idx", "symbol", "quarter_end_date"), ["run_id", "trade_idx", "symbol"], "left")
    snap = tables.universe.select("quarter_end_date", "symbol", "market_cap_inr", "free_float_shares", "shares_outstanding")
    rows = traded.join(snap, ["quarter_end_date", "symbol"], "left").join(tables.series.select("symbol", "advs"), "symbol", "left").withColumn("adv", F.get("advs", "trade_idx")).drop("advs")
    rows = rows.withColumns({
        "_a": F.when(F.col("market_cap_inr") > 0, -F.log10("market_cap_inr")), "_b": F.when(F.col("adv") > 0, -F.log10("adv")),
        "_c": -F.try_divide("free_float_shares", "shares_outstanding"),
    })
    by = ["run_id", "trade_idx"]
    for c in ("_a", "_b", "_c"):
        rows = standardised(rows, c, by, 5.0, f"{c}z")
    rows = rows.withColumn("_raw", F.coalesce("_az", F.lit(0.0)) + F.coalesce("_bz", F.lit(0.0)) + F.coalesce("_cz", F.lit(0.0)))
    rows = standardised(rows, "_raw", by, 5.0, "illiquidity_z").join(configs.select("run_id", "tcost_base", "tcost_k", "tcost_floor", "tcost_ceiling"), "run_id")
    bps = F.col("tcost_base") + F.col("tcost_k") * F.greatest(F.lit(0.0), F.coalesce("illiquidity_z", F.lit(0.0)))
    return rows.withColumn("cost_bps", F.least(F.col("tcost_ceiling"), F.greatest(F.col("tcost_floor"), bps))).select(*trades.columns, "illiquidity_z", "cost_bps")


def turnover(trades: DataFrame, costed: DataFrame) -> DataFrame:
    """(run_id, rebal_date, trade_date, trade_idx, one_way_turnover, drag_decimal, drag_bps, drag_nav) of each trade."""
    turned = trades.groupBy("run_id", "rebal_date", "trade_date", "trade_idx").agg((F.sum(F.abs("delta_weight")) / 2).alias("one_way_turnover"))
    drag = costed.groupBy("run_id", "trade_idx").agg((F.sum(F.abs("delta_weight") * F.col("cost_bps")) / 10000).alias("drag_decimal"))
    out = turned.join(drag, ["run_id", "trade_idx"], "left").withColumn("drag_decimal", F.coalesce("drag_decimal", F.lit(0.0)))
    w = Window.partitionBy("run_id").orderBy("trade_idx").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumns({"drag_bps": F.col("drag_decimal") * 10000, "drag_nav": F.product(1 - F.col("drag_decimal")).over(w)})


def benchmark_returns(levels: DataFrame, cal: DataFrame) -> DataFrame:
    """(cal_idx, date, benchmark): returns of the levels on the calendar, filled forward; 0 before the first level."""
    on_days = F.broadcast(cal).join(levels, "date", "left")
    w = Window.orderBy("cal_idx")  # a row a day
    filled = on_days.withColumn("_l", F.last("close", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return filled.select("cal_idx", "date", F.coalesce(F.try_divide("_l", F.lag("_l").over(w)) - 1, F.lit(0.0)).alias("benchmark"))


def returns_table(gross: DataFrame, idle: DataFrame, turned: DataFrame, bench: DataFrame) -> DataFrame:
    """(run_id, cal_idx, date, gross, net, benchmark, active)."""
    all_days = gross.unionByName(idle.withColumn("gross", F.lit(0.0)).select(*gross.columns))
    drag = turned.select("run_id", F.col("trade_idx").alias("cal_idx"), "drag_decimal")
    out = all_days.join(drag, ["run_id", "cal_idx"], "left").join(F.broadcast(bench.drop("date")), "cal_idx", "left")
    net = (1 + F.col("gross")) * (1 - F.coalesce("drag_decimal", F.lit(0.0))) - 1
    out = out.withColumn("net", net).withColumn("benchmark", F.coalesce("benchmark", F.lit(0.0)))
    return out.select("run_id", "cal_idx", "date", "gross", "net", "benchmark", (F.col("net") - F.col("benchmark")).alias("active"))
