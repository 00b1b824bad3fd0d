"""The pool of a rebalance, its eligibility filters and the selection by score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.asof import snapshot_asof
from tickerloom.operators.signals import KEYS


def pool(tables, rebalances: DataFrame, configs: DataFrame) -> DataFrame:
    """The universe as of each rebalance with the run's configuration, the day's index, filled close, listing age, ADV and group."""
    days = F.broadcast(tables.cal.select(F.col("date").alias("rebal_date"), "cal_idx"))
    at = snapshot_asof(rebalances.select("run_id", "rebal_date"), tables.universe, "rebal_date").join(days, "rebal_date")
    names = at.join(tables.universe, "quarter_end_date").join(configs, "run_id")
    series = tables.series.select("symbol", "closes", "advs", "first_idx")
    out = names.join(series, "symbol", "left").withColumns({"close": F.get("closes", "cal_idx"), "adv": F.get("advs", "cal_idx"), "history_days": F.col("cal_idx") - F.col("first_idx") + 1}).drop("closes", "advs", "first_idx")
    return out.join(tables.sectors.select("symbol", F.col("sector").alias("_sector")), "symbol", "left").withColumn("sector", F.coalesce("_sector", F.lit("UNCLASSIFIED"))).drop("_sector")


def eligible(names: DataFrame, extra: list | None = None, tables=None) -> DataFrame:
    """names that pass every filter of their run; a null threshold is off, a null value fails a threshold that is on."""
    free = F.try_divide("free_float_shares", "shares_outstanding")
    kept = names.where(
        (F.col("max_universe_rank").isNull() | (F.col("rank") <= F.col("max_universe_rank")))
        & ~F.coalesce(F.array_contains("exclude_symbols", F.col("symbol")), F.lit(False))
        & (F.col("min_free_float_pct").isNull() | (free >= F.col("min_free_float_pct")))
        & ((F.coalesce("min_history_days", F.lit(0)) <= 0) | (F.col("history_days") >= F.col("min_history_days")))
        & ((F.coalesce("min_price", F.lit(0.0)) <= 0) | (F.col("close") >= F.col("min_price")))
        & (F.col("min_adv_inr").isNull() | (F.col("adv") >= F.col("min_adv_inr")))
    )
    for f in extra or []:
        kept = f(tables, kept)
    return kept


def selected(names: DataFrame, scored: DataFrame) -> DataFrame:
    """names with their score; with signal_top_n the best n by score and rank, else with signal_top_quantile those at or above the quantile, both without unscored names."""
    both = names.join(scored, [*KEYS, "symbol"], "left")
    k = Window.partitionBy(*KEYS)
    place = F.row_number().over(k.orderBy(F.col("score").desc_nulls_last(), "rank", "symbol"))
    # a percentile per run: each run has its own quantile, so the sorted scores are interpolated directly
    n = F.count("score").over(k)
    at = (1 - F.col("signal_top_quantile")) * (n - 1)
    up = F.row_number().over(k.orderBy(F.col("score").asc_nulls_last(), "rank", "symbol")) - 1
    ranked = both.withColumns({"_place": place, "_n": n, "_at": at, "_up": up})
    low = F.max(F.when(F.col("_up") == F.floor("_at"), F.col("score"))).over(k)
    high = F.max(F.when(F.col("_up") == F.ceil("_at"), F.col("score"))).over(k)
    ranked = ranked.withColumn("_edge", low + (high - low) * (F.col("_at") - F.floor("_at")))
    by_n = F.col("signal_top_n").isNotNull() & F.col("score").isNotNull() & (F.col("_place") <= F.col("signal_top_n"))
    by_q = F.col("signal_top_n").isNull() & F.col("signal_top_quantile").isNotNull() & (F.col("score") >= F.col("_edge"))
    off = (F.col("signal_top_n").isNull() & F.col("signal_top_quantile").isNull()) | (F.col("_n") == 0)
    return ranked.where(by_n | by_q | off).drop("_place", "_n", "_at", "_up", "_edge")
