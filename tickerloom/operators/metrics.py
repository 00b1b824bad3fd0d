"""Performance statistics of daily return tables (run_id, cal_idx, date, gross, net, benchmark, active)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YEAR = 252


def _days() -> Window:
    return Window.partitionBy("run_id").orderBy("date")


def long_series(returns: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(run_id, date, series, r), nulls as 0."""
    names = names or ["gross", "net", "benchmark"]
    return returns.unpivot(["run_id", "date"], names, "series", "r").withColumn("r", F.coalesce("r", F.lit(0.0)))


def cagr(r: Column) -> Column:
    """Compounded annual growth; 0 if nothing is left."""
    end, years = F.product(1 + r), F.count(r) / YEAR
    return F.when(end <= 0, 0.0).otherwise(F.pow(end, 1 / years) - 1)


def series_statistics(returns: DataFrame) -> DataFrame:
    """(run_id, series, days, cagr, annual_vol, sharpe, sortino, total_return) of gross, net and benchmark."""
    long = long_series(returns)
    out = long.groupBy("run_id", "series").agg(
        F.count("r").alias("days"), cagr(F.col("r")).alias("cagr"), (F.stddev_samp("r") * YEAR**0.5).alias("annual_vol"),
        (F.stddev_samp(F.when(F.col("r") < 0, F.col("r"))) * YEAR**0.5).alias("_down"), (F.product(1 + F.col("r")) - 1).alias("total_return"))
    ratio = lambda c: F.when(F.col(c) > 0, F.col("cagr") / F.col(c))
    return out.select("run_id", "series", "days", "cagr", "annual_vol", ratio("annual_vol").alias("sharpe"), ratio("_down").alias("sortino"), "total_return")


def relative_statistics(returns: DataFrame) -> DataFrame:
    """(run_id, hit_rate, tracking_error, information_ratio) of net against the benchmark."""
    te = F.stddev_samp("active") * YEAR**0.5
    return returns.groupBy("run_id").agg(
        F.avg((F.col("active") > 0).cast("double")).alias("hit_rate"), te.alias("tracking_error"), F.when(te > 0, F.avg("active") * YEAR / te).alias("information_ratio"))


def curves(returns: DataFrame) -> DataFrame:
    """(run_id, date, series, equity, drawdown) of gross, net, benchmark and active (net over benchmark)."""
    w = _days().rowsBetween(Window.unboundedPreceding, 0)
    by = Window.partitionBy("run_id", "series").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    equity = long_series(returns).withColumn("equity", F.product(1 + F.col("r")).over(by)).select("run_id", "date", "series", "equity")
    ratio = returns.select("run_id", "date", F.lit("active").alias("series"), (F.product(1 + F.coalesce("net", F.lit(0.0))).over(w) / F.product(1 + F.coalesce("benchmark", F.lit(0.0))).over(w)).alias("equity"))
    both = equity.unionByName(ratio)
    return both.withColumn("drawdown", F.col("equity") / F.max("equity").over(by) - 1)


def max_drawdown(returns: DataFrame) -> DataFrame:
    """(run_id, series, max_drawdown, start_date, trough_date, recovery_date, recovery_days): the first deepest trough, the last day at a peak before it (or the first day), and the first day at a peak after it."""
    c = curves(returns).where("series <> 'active'")
    deepest = c.groupBy("run_id", "series").agg(F.min(F.struct("drawdown", "date")).alias("t"), F.min("date").alias("first"))
    at = c.join(deepest.select("run_id", "series", "first", F.col("t.drawdown").alias("max_drawdown"), F.col("t.date").alias("trough_date")), ["run_id", "series"])
    peak = F.col("drawdown") >= 0
    out = at.groupBy("run_id", "series", "max_drawdown", "trough_date").agg(
        F.coalesce(F.max(F.when(peak & (F.col("date") <= F.col("trough_date")), F.col("date"))), F.min("first")).alias("start_date"),
        F.min(F.when(peak & (F.col("date") > F.col("trough_date")), F.col("date"))).alias("recovery_date"))
    return out.withColumn("recovery_days", F.datediff("recovery_date", "trough_date"))


def calendar_years(returns: DataFrame) -> DataFrame:
    """(run_id, year, gross, net, benchmark, active), compounded; active is net less benchmark."""
    part = lambda c: F.product(1 + F.coalesce(c, F.lit(0.0))) - 1
    out = returns.groupBy("run_id", F.year("date").alias("year")).agg(*(part(c).alias(c) for c in ("gross", "net", "benchmark")))
    return out.withColumn("active", F.col("net") - F.col("benchmark"))


def rolling_statistics(returns: DataFrame, rows: int = YEAR) -> DataFrame:
    """(run_id, date, annual_return, annual_vol, sharpe, information_ratio) over the last rows, full windows only."""
    w = _days().rowsBetween(-(rows - 1), 0)
    te = F.stddev_samp("active").over(w) * YEAR**0.5
    out = returns.withColumns({
        "_n": F.count("net").over(w), "annual_return": F.pow(F.product(1 + F.col("net")).over(w), YEAR / rows) - 1,
        "annual_vol": F.stddev_samp("net").over(w) * YEAR**0.5, "information_ratio": F.avg("active").over(w) * YEAR / F.nullif(te, F.lit(0.0)),
    })
    out = out.where(F.col("_n") == rows).withColumn("sharpe", F.col("annual_return") / F.nullif("annual_vol", F.lit(0.0)))
    return out.select("run_id", "date", "annual_return", "annual_vol", "sharpe", "information_ratio")


def portfolio_averages(weights: DataFrame, turned: DataFrame, returns: DataFrame) -> DataFrame:
    """(run_id, avg_positions, mean_turnover, annual_turnover, mean_cost_bps, annual_cost_bps)."""
    held = weights.where("symbol <> 'CASH' and weight > 1e-9").groupBy("run_id", "date").agg(F.count(F.lit(1)).alias("n"))
    days = returns.groupBy("run_id").agg((F.count(F.lit(1)) / YEAR).alias("years"))
    positions = days.join(held.groupBy("run_id").agg(F.sum("n").alias("n")), "run_id", "left").select("run_id", "years", (F.coalesce("n", F.lit(0)) / (F.col("years") * YEAR)).alias("avg_positions"))
    trades = turned.groupBy("run_id").agg(F.avg("one_way_turnover").alias("mean_turnover"), F.sum("one_way_turnover").alias("_t"), F.avg("drag_bps").alias("mean_cost_bps"), F.sum("drag_bps").alias("_c"))
    out = positions.join(trades, "run_id", "left")
    return out.select("run_id", "avg_positions", "mean_turnover", (F.col("_t") / F.col("years")).alias("annual_turnover"), "mean_cost_bps", (F.col("_c") / F.col("years")).alias("annual_cost_bps"))


def summary(returns: DataFrame, weights: DataFrame, turned: DataFrame) -> DataFrame:
    """One row a run with the statistics of each series, relative ones, drawdowns and averages."""
    names = ["cagr", "annual_vol", "sharpe", "sortino", "total_return"]
    stats = series_statistics(returns).groupBy("run_id").agg(*(F.max(F.when(F.col("series") == s, F.col(c))).alias(f"{s}_{c}") for s in ("gross", "net", "benchmark") for c in names), F.max("days").alias("days"))
    falls = max_drawdown(returns).groupBy("run_id").agg(*(F.max(F.when(F.col("series") == s, F.col("max_drawdown"))).alias(f"{s}_max_drawdown") for s in ("gross", "net", "benchmark")))
    return stats.join(relative_statistics(returns), "run_id").join(falls, "run_id").join(portfolio_averages(weights, turned, returns), "run_id", "left")
