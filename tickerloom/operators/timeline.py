"""Trading calendar, period ends, rebalance schedule and trade dates.

A calendar has a row a day, so it stays at thousands of rows whatever the number of symbols; it is the one table
that is numbered in a single window and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def calendar(prices: DataFrame) -> DataFrame:
    """(date, cal_idx): the distinct dates of a panel, numbered from 0."""
    days = prices.select("date").where("date is not null").distinct()
    return days.withColumn("cal_idx", (F.row_number().over(Window.orderBy("date")) - 1).cast("int"))


def period_ends(bounds: DataFrame, freq: str = "Q") -> DataFrame:
    """bounds (start, end, ...) with a row for each month, quarter or year end within them, as period_end."""
    months = F.expr("sequence(trunc(start, 'MM'), trunc(`end`, 'MM'), interval 1 month)")
    ends = bounds.where("start <= `end`").withColumn("period_end", F.explode(F.transform(months, F.last_day)))
    step = {"M": F.lit(True), "Q": F.month("period_end") % 3 == 0, "A": F.month("period_end") == 12}[freq]
    return ends.where((F.col("period_end") >= F.col("start")) & (F.col("period_end") <= F.col("end")) & step)


def quarter_ends(cal: DataFrame) -> DataFrame:
    """(quarter_end_date) within a calendar's span."""
    bounds = cal.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return period_ends(bounds.where("start is not null"), "Q").select(F.col("period_end").alias("quarter_end_date"))


def calendar_asof(dates: DataFrame, cal: DataFrame, on: str, tolerance_days: int | None = None) -> DataFrame:
    """dates with snap_date and snap_idx, the last calendar day on or before each; at most tolerance_days earlier."""
    keys = dates.select(on).distinct()
    days = F.broadcast(cal.select(F.col("date").alias("_d"), F.col("cal_idx").alias("_i")))
    near = keys.join(days, F.col("_d") <= F.col(on)).groupBy(on).agg(F.max("_d").alias("snap_date"), F.max("_i").alias("snap_idx"))
    if tolerance_days is not None:
        near = near.where(F.datediff(on, "snap_date") <= tolerance_days)
    return dates.join(near, on)


def snap_to_calendar(candidates: DataFrame, cal: DataFrame, first_snapshot: DataFrame, on: str = "period_end") -> DataFrame:
    """candidates with rebal_date: the trading day on or before; the next one if there is none before, or if it lies before the first snapshot.

    first_snapshot has one row (first_snapshot). Equal rebal_dates of one run become one.
    """
    days = F.broadcast(cal.select(F.col("date").alias("_d")))
    keys = candidates.select(on).distinct().join(F.broadcast(first_snapshot), F.lit(True), "left")
    near = keys.join(days, F.lit(True)).groupBy(on).agg(
        F.max(F.when(F.col("_d") <= F.col(on), F.col("_d"))).alias("back"), F.min(F.when(F.col("_d") >= F.col(on), F.col("_d"))).alias("ahead"), F.first("first_snapshot").alias("first"))
    snapped = near.select(on, F.when(F.col("back").isNull() | (F.col("back") < F.col("first")), F.coalesce("ahead", "back")).otherwise(F.col("back")).alias("rebal_date"))
    return candidates.join(snapped, on).where("rebal_date is not null").drop(on, "start", "end").distinct()


def schedule(configs: DataFrame, cal: DataFrame, universe: DataFrame) -> DataFrame:
    """(run_id, rebal_date) of every config (run_id, start, end, rebal_freq, custom_rebal_dates); null bounds mean the calendar's."""
    first = universe.agg(F.min("quarter_end_date").alias("first_snapshot"))
    span = F.broadcast(cal.agg(F.min("date").alias("_first"), F.max("date").alias("_last")))
    bounds = configs.join(span, F.lit(True)).select("run_id", "rebal_freq", "custom_rebal_dates", F.coalesce("start", "_first").alias("start"), F.coalesce("end", "_last").alias("end"))
    parts = [period_ends(bounds.where(F.col("rebal_freq") == f), f).select("run_id", "period_end") for f in ("M", "Q", "A")]
    custom = bounds.where("rebal_freq = 'custom'").withColumn("period_end", F.explode("custom_rebal_dates")).where("period_end between start and `end`").select("run_id", "period_end")
    candidates = custom
    for p in parts:
        candidates = candidates.unionByName(p)
    return snap_to_calendar(candidates, cal, first).select("run_id", "rebal_date")


def trade_dates(rebalances: DataFrame, cal: DataFrame) -> DataFrame:
    """rebalances (run_id, rebal_date, rebal_offset) with trade_idx and trade_date, offset trading days later, at most the last day; of rebalances with one trade date the last stays."""
    last = F.broadcast(cal.agg(F.max("cal_idx").alias("_last")))
    days = F.broadcast(cal)
    at = rebalances.join(days.select(F.col("date").alias("rebal_date"), "cal_idx"), "rebal_date").join(last, F.lit(True))
    at = at.withColumn("trade_idx", F.least(F.col("cal_idx") + F.col("rebal_offset"), F.col("_last"))).drop("cal_idx", "_last")
    at = at.join(days.select(F.col("cal_idx").alias("trade_idx"), F.col("date").alias("trade_date")), "trade_idx")
    return at.groupBy("run_id", "trade_idx", "trade_date").agg(F.max("rebal_date").alias("rebal_date"))
