"""Sector attribution whose parts add up to the engine's returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.asof import snapshot_asof
from tickerloom.schemas import CASH, UNCLASSIFIED

KEYS = ["run_id", "cal_idx", "date", "sector"]


def with_sector(df: DataFrame, sectors: DataFrame) -> DataFrame:
    """df with the symbol's sector; cash is a sector of its own, unmapped symbols are UNCLASSIFIED."""
    own = sectors.select("symbol", F.col("sector").alias("_s"))
    named = df.drop("sector").join(own, "symbol", "left")
    return named.withColumn("sector", F.when(F.col("symbol") == CASH, CASH).otherwise(F.coalesce("_s", F.lit(UNCLASSIFIED)))).drop("_s")


def sector_weights(weights: DataFrame, sectors: DataFrame) -> DataFrame:
    """(run_id, cal_idx, date, sector, weight)."""
    return with_sector(weights, sectors).groupBy(*KEYS).agg(F.sum("weight").alias("weight"))


def earning_weights(weights: DataFrame, trades: DataFrame, cal: DataFrame) -> DataFrame:
    """(run_id, cal_idx, symbol, earning): the weights that earned each day's return: the day before's, on trade days the targets."""
    traded = trades.select("run_id", F.col("trade_idx").alias("cal_idx")).distinct()
    before = weights.select("run_id", (F.col("cal_idx") + 1).alias("cal_idx"), "symbol", F.col("weight").alias("earning")).join(traded, ["run_id", "cal_idx"], "left_anti")
    last = weights.groupBy("run_id").agg(F.max("cal_idx").alias("_last"))
    before = before.join(last, "run_id").where("cal_idx <= _last").drop("_last")
    on_trade = trades.select("run_id", F.col("trade_idx").alias("cal_idx"), "symbol", F.col("target_weight").alias("earning"))
    return before.unionByName(on_trade)


def sector_contribution(weights: DataFrame, trades: DataFrame, costed: DataFrame, returns: DataFrame, sectors: DataFrame, tables) -> DataFrame:
    """(run_id, cal_idx, date, sector, weight, contrib_gross, contrib_tcost, contrib_net, cum_contrib_net_pct) for every sector a run ever has, on each of its days.

    Net contributions shrink with the day's drag as the engine's net return does, and accumulate in units of wealth.
    """
    day = F.broadcast(tables.cal)
    rets = tables.dense.select("symbol", "cal_idx", "ret")
    earned = earning_weights(weights, trades, tables.cal).join(rets, ["symbol", "cal_idx"], "left")
    gross = with_sector(earned.select("run_id", "cal_idx", "symbol", F.when(F.col("symbol") == CASH, 0.0).otherwise(F.col("earning") * F.coalesce("ret", F.lit(0.0))).alias("g")), sectors)
    gross = gross.groupBy("run_id", "cal_idx", "sector").agg(F.sum("g").alias("contrib_gross"))
    cost = with_sector(costed.select("run_id", F.col("trade_idx").alias("cal_idx"), "symbol", (F.abs("delta_weight") * F.coalesce("cost_bps", F.lit(0.0)) / 10000).alias("c")), sectors)
    cost = cost.groupBy("run_id", "cal_idx", "sector").agg(F.sum("c").alias("contrib_tcost"))
    drag = cost.groupBy("run_id", "cal_idx").agg(F.sum("contrib_tcost").alias("_drag"))
    own = sector_weights(weights, sectors)
    # every sector of a run on every day of it: thousands of days times dozens of sectors
    seen = gross.select("run_id", "sector").union(own.select("run_id", "sector")).distinct()
    days = returns.select("run_id", "cal_idx", "net")
    grid = days.join(seen, "run_id").join(day, "cal_idx")
    out = grid.join(gross, ["run_id", "cal_idx", "sector"], "left").join(cost, ["run_id", "cal_idx", "sector"], "left").join(own.drop("date"), ["run_id", "cal_idx", "sector"], "left").join(drag, ["run_id", "cal_idx"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = out.withColumns({c: zero(c) for c in ("contrib_gross", "contrib_tcost", "weight")}).withColumn("contrib_net", F.col("contrib_gross") * (1 - zero("_drag")) - F.col("contrib_tcost"))
    w = Window.partitionBy("run_id", "sector").orderBy("cal_idx")
    before = zero(F.product(1 + zero("net")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    out = out.withColumn("_nav", F.when(F.row_number().over(w) == 1, 1.0).otherwise(before))
    out = out.withColumn("cum_contrib_net_pct", F.sum(F.col("contrib_net") * F.col("_nav")).over(w.rowsBetween(Window.unboundedPreceding, 0)) * 100)
    return out.select(*KEYS, "weight", "contrib_gross", "contrib_tcost", "contrib_net", "cum_contrib_net_pct")


def benchmark_sector_weights(universe: DataFrame, sectors: DataFrame) -> DataFrame:
    """(quarter_end_date, sector, benchmark_wt) by free-float capitalisation, positive ones only."""
    own = with_sector(universe.where("free_float_market_cap_inr > 0"), sectors)
    sums = own.groupBy("quarter_end_date", "sector").agg(F.sum("free_float_market_cap_inr").alias("_f"))
    return sums.select("quarter_end_date", "sector", (F.col("_f") / F.sum("_f").over(Window.partitionBy("quarter_end_date"))).alias("benchmark_wt"))


def active_sector_weights(weights: DataFrame, universe: DataFrame, sectors: DataFrame) -> DataFrame:
    """(run_id, date, sector, portfolio_wt, benchmark_wt, active_wt); a side without the sector counts 0."""
    own = sector_weights(weights, sectors).select("run_id", "date", "sector", F.col("weight").alias("portfolio_wt"))
    days = snapshot_asof(own.select("run_id", "date").distinct(), universe, "date")
    bench = days.join(F.broadcast(benchmark_sector_weights(universe, sectors)), "quarter_end_date").select("run_id", "date", "sector", "benchmark_wt")
    both = own.join(bench, ["run_id", "date", "sector"], "full_outer")
    both = both.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("portfolio_wt", "benchmark_wt")})
    return both.withColumn("active_wt", F.col("portfolio_wt") - F.col("benchmark_wt"))


def headline(contribution: DataFrame, active: DataFrame) -> DataFrame:
    """(run_id, sector, cum_contrib_net_pct, active_wt) on each run's last day."""
    end = contribution.groupBy("run_id").agg(F.max("date").alias("date"))
    own = contribution.join(end, ["run_id", "date"]).select("run_id", "date", "sector", "cum_contrib_net_pct")
    return own.join(active, ["run_id", "date", "sector"], "left").select("run_id", "sector", "cum_contrib_net_pct", "active_wt")


def identity_residuals(contribution: DataFrame, returns: DataFrame, weights: DataFrame) -> DataFrame:
    """(run_id, gross_residual, net_residual, weight_residual): the largest deviation of the sums over sectors."""
    sums = contribution.groupBy("run_id", "cal_idx").agg(F.sum("contrib_gross").alias("g"), F.sum("contrib_net").alias("n"), F.sum("weight").alias("w"))
    both = sums.join(returns.select("run_id", "cal_idx", "gross", "net"), ["run_id", "cal_idx"])
    held = weights.select("run_id", "cal_idx").distinct()
    return both.join(held, ["run_id", "cal_idx"]).groupBy("run_id").agg(
        F.max(F.abs(F.col("g") - F.col("gross"))).alias("gross_residual"), F.max(F.abs(F.col("n") - F.col("net"))).alias("net_residual"), F.max(F.abs(F.col("w") - 1)).alias("weight_residual"))
