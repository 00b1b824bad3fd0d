"""Tables behind the charts of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.asof import asof_join, snapshot_asof
from tickerloom.operators.weights import size_bucket
from tickerloom.schemas import CASH


def _last_day(df: DataFrame) -> DataFrame:
    return df.join(df.groupBy("run_id").agg(F.max("date").alias("date")), ["run_id", "date"], "left_semi")


def position_count(weights: DataFrame) -> DataFrame:
    """(run_id, date, positions): names with weight, cash apart."""
    return weights.groupBy("run_id", "date").agg(F.count_if((F.col("symbol") != CASH) & (F.col("weight") > 1e-9)).alias("positions"))


def top_holdings(weights: DataFrame, n: int = 20) -> DataFrame:
    """(run_id, symbol, weight, place) of the last day."""
    place = F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("weight"), "symbol"))
    return _last_day(weights).where("symbol <> 'CASH' and weight > 1e-9").withColumn("place", place).where(F.col("place") <= n).select("run_id", "symbol", "weight", "place")


def active_positions(weights: DataFrame, universe: DataFrame, n: int = 10) -> DataFrame:
    """(run_id, symbol, active_weight, side, place): the most over- and underweight names of the last day against the free-float benchmark; zeros are dropped."""
    own = _last_day(weights).where("symbol <> 'CASH'").select("run_id", "date", "symbol", "weight")
    days = snapshot_asof(own.select("run_id", "date").distinct(), universe, "date")
    bench = days.join(universe.where("free_float_market_cap_inr > 0"), "quarter_end_date").select("run_id", "date", "symbol", (F.col("free_float_market_cap_inr") / F.sum("free_float_market_cap_inr").over(Window.partitionBy("run_id"))).alias("bench"))
    both = own.join(bench, ["run_id", "date", "symbol"], "full_outer")
    both = both.select("run_id", "symbol", (F.coalesce("weight", F.lit(0.0)) - F.coalesce("bench", F.lit(0.0))).alias("active_weight")).where("abs(active_weight) > 1e-9")
    parts = []
    for side, order in (("over", F.desc("active_weight")), ("under", F.asc("active_weight"))):
        place = F.row_number().over(Window.partitionBy("run_id").orderBy(order, "symbol"))
        parts.append(both.withColumns({"side": F.lit(side), "place": place}).where(F.col("place") <= n))
    return parts[0].unionByName(parts[1])


def concentration(weights: DataFrame) -> DataFrame:
    """(run_id, place, symbol, cumulative_weight, hhi) of the last day by descending weight."""
    own = _last_day(weights).where("symbol <> 'CASH' and weight > 1e-9")
    w = Window.partitionBy("run_id").orderBy(F.desc("weight"), "symbol")
    return own.select("run_id", F.row_number().over(w).alias("place"), "symbol", F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_weight"), F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("run_id")).alias("hhi"))


def last_known_group(weights: DataFrame, membership: DataFrame) -> DataFrame:
    """weights with grp, the symbol's group in the latest snapshot on or before the day that names it; membership (quarter_end_date, symbol, grp)."""
    out = asof_join(weights, membership.select("symbol", F.col("quarter_end_date").alias("_known"), "grp"), ["symbol"], "date", "_known")
    return out.withColumn("grp", F.when(F.col("symbol") == CASH, CASH).otherwise(F.coalesce("grp", F.lit("unclassified")))).drop("_known")


def group_weights(weights: DataFrame, membership: DataFrame) -> DataFrame:
    """(run_id, date, grp, weight) over time."""
    return last_known_group(weights, membership).groupBy("run_id", "date", "grp").agg(F.sum("weight").alias("weight")).where("abs(weight) > 1e-9")


def size_bucket_weights(weights: DataFrame, universe: DataFrame, buckets: dict) -> DataFrame:
    return group_weights(weights, universe.select("quarter_end_date", "symbol", size_bucket(F.col("rank"), buckets).alias("grp")))


def groups_by_mean_weight(grouped: DataFrame) -> DataFrame:
    """(run_id, grp, mean_weight), heaviest first."""
    return grouped.groupBy("run_id", "grp").agg(F.avg("weight").alias("mean_weight")).orderBy("run_id", F.desc("mean_weight"), "grp")


def end_contribution(contribution: DataFrame) -> DataFrame:
    """(run_id, sector, cum_contrib_net_pct) of the last day, without zeros, largest first."""
    return _last_day(contribution).where("abs(cum_contrib_net_pct) > 1e-9").select("run_id", "sector", "cum_contrib_net_pct").orderBy("run_id", F.desc("cum_contrib_net_pct"), "sector")


def end_tilt(active: DataFrame) -> DataFrame:
    """(run_id, sector, active_wt) of the last day, without zeros, largest first."""
    return _last_day(active).where("abs(active_wt) > 1e-9").select("run_id", "sector", "active_wt").orderBy("run_id", F.desc("active_wt"), "sector")


def trade_bars(turned: DataFrame) -> DataFrame:
    """(run_id, trade_date, one_way_turnover, drag_bps)."""
    return turned.select("run_id", "trade_date", "one_way_turnover", "drag_bps")
