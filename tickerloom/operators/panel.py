"""Long panels: reshaping, upserts, the dense price panel and traded value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickerloom.operators.timeline import calendar
from tickerloom.schemas import PRICE_FIELDS

KEYS = ["date", "symbol", "parameter"]


def melt_panel(wide: DataFrame, parameters: list[str] | None = None) -> DataFrame:
    """Columns to rows (date, symbol, parameter, value); nulls are dropped."""
    names = parameters or [c for c in wide.columns if c not in ("date", "symbol")]
    typed = wide.select("date", "symbol", *(F.col(c).cast("double").alias(c) for c in names))
    return typed.unpivot(["date", "symbol"], names, "parameter", "value").where("value is not null")


def pivot_panel(panel: DataFrame, parameters: list[str] | None = None) -> DataFrame:
    """(date, symbol) with a column for each parameter of a fixed list; of repeated rows the largest value counts."""
    names = parameters or PRICE_FIELDS
    return panel.where(F.col("parameter").isin(names)).groupBy("date", "symbol").agg(*(F.max(F.when(F.col("parameter") == n, F.col("value"))).alias(n) for n in names))


def keep_newest(df: DataFrame, keys: list[str], priority: list) -> DataFrame:
    """One row for each key: the first by priority, a total order."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*priority))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """existing with the rows of new in the place of rows with equal keys; of repeated keys in new the largest row by its other columns."""
    keys = keys or KEYS
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [F.col(c).desc_nulls_last() for c in both.columns if c not in keys and c != "_new"]
    return keep_newest(both, keys, [F.desc("_new"), *rest]).drop("_new")


def dense_returns(quotes: DataFrame, cal: DataFrame | None = None) -> DataFrame:
    """(symbol, date, cal_idx, close_raw, volume, close, ret, first_close, last_valid): every symbol on every calendar day.

    quotes (date, symbol, close, volume) is one row a day and symbol. close is filled forward, ret is its simple
    return, 0 where there is none; last_valid is the last day with a close of its own.
    """
    cal = cal if cal is not None else calendar(quotes)
    days = cal.agg(F.max("cal_idx").alias("n"))
    grid = quotes.select("symbol").where("symbol is not null").distinct().join(F.broadcast(days), F.lit(True)).select("symbol", F.explode(F.sequence(F.lit(0), "n")).alias("cal_idx"))
    seen = quotes.join(F.broadcast(cal), "date").select("symbol", "cal_idx", F.col("close").alias("close_raw"), F.col("volume").cast("double").alias("volume"))
    w = Window.partitionBy("symbol").orderBy("cal_idx")
    whole = Window.partitionBy("symbol")
    full = grid.join(seen, ["symbol", "cal_idx"], "left").join(F.broadcast(cal), "cal_idx")
    full = full.withColumn("close", F.last("close_raw", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    full = full.withColumn("ret", F.coalesce(F.try_divide("close", F.lag("close").over(w)) - 1, F.lit(0.0)))
    full = full.withColumn("last_valid", F.max(F.when(F.col("close_raw").isNotNull(), F.col("date"))).over(whole))
    full = full.withColumn("first_close", F.min_by("close_raw", F.when(F.col("close_raw").isNotNull(), F.col("cal_idx"))).over(whole))
    return full.select("symbol", "date", "cal_idx", "close_raw", "volume", "close", "ret", "first_close", "last_valid")


def rolling_median(value: Column, window: WindowSpec, least: int) -> Column:
    """The exact median over a bounded frame, null below `least` values: its few values are sorted for each row, without a map of them."""
    values = F.sort_array(F.collect_list(value).over(window))
    # an outer lambda binds the array, so it is sorted once
    middle = F.transform(F.array(values), lambda x: (F.get(x, F.floor((F.size(x) - 1) / 2).cast("int")) + F.get(x, F.floor(F.size(x) / 2).cast("int"))) / 2)[0]
    return F.when(F.count(value).over(window) >= least, middle)


def with_adv(dense: DataFrame, rows: int = 30, least: int = 10) -> DataFrame:
    """dense with adv: exact rolling median of traded value over the last rows, null below `least` values."""
    w = Window.partitionBy("symbol").orderBy("cal_idx").rowsBetween(-(rows - 1), 0)
    return dense.withColumn("adv", rolling_median(F.col("close_raw") * F.col("volume"), w, least))


def by_symbol(dense: DataFrame) -> DataFrame:
    """(symbol, closes, advs, rets, first_close, first_idx, last_valid): a row a symbol of a dense panel with adv; arrays hold a value a calendar day, so a day's value is get(closes, cal_idx)."""
    day = F.struct("cal_idx", "close", "adv", "ret")
    packed = dense.groupBy("symbol").agg(
        F.array_sort(F.collect_list(day)).alias("_d"), F.first("first_close").alias("first_close"), F.first("last_valid").alias("last_valid"),
        F.min(F.when(F.col("close_raw").isNotNull(), F.col("cal_idx"))).alias("first_idx"))
    return packed.select("symbol", F.col("_d.close").alias("closes"), F.col("_d.adv").alias("advs"), F.col("_d.ret").alias("rets"), "first_close", "first_idx", "last_valid")


def adv(dense: DataFrame, rows: int = 30, least: int = 10) -> DataFrame:
    """(symbol, date, cal_idx, adv)."""
    return with_adv(dense, rows, least).select("symbol", "date", "cal_idx", "adv")


def value_asof(dates: DataFrame, panel: DataFrame, cal: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """dates (with symbol) joined with a dense panel's columns on the last calendar day on or before each."""
    from tickerloom.operators.timeline import calendar_asof

    at = calendar_asof(dates, cal, on).drop("snap_date")
    return at.join(panel.select("symbol", F.col("cal_idx").alias("snap_idx"), *columns), ["symbol", "snap_idx"], "left").drop("snap_idx")


def backfill_from_daily(daily: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of the daily files for symbols with a window (symbol, first, last), in one scan."""
    w = windows.select("symbol", "first", "last")
    return daily.join(w, "symbol").where("date between first and last").drop("first", "last")


def life_windows(history: DataFrame, default_start, today, lookback_days: int = 0) -> DataFrame:
    """(symbol, first, last): the later of the default start and first seen less the lookback, to the earlier of today and last seen."""
    first = F.greatest(F.lit(default_start).cast("date"), F.date_sub("first_seen_date", lookback_days))
    return history.select("symbol", first.alias("first"), F.least(F.lit(today).cast("date"), F.col("last_seen_date")).alias("last"))


def primary_else_fallback(wanted: DataFrame, primary: DataFrame, fallback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The primary panel with fallback rows for wanted symbols without primary rows; and the symbols that neither has."""
    have = primary.select("symbol").distinct()
    missing = wanted.select("symbol").distinct().join(have, "symbol", "left_anti")
    filled = fallback.join(missing, "symbol", "left_semi")
    gaps = missing.join(fallback.select("symbol").distinct(), "symbol", "left_anti").select(F.lit("prices").alias("script"), "symbol", F.lit("NoPriceData").alias("reason"), F.lit(None).cast("string").alias("error_msg"))
    return primary.unionByName(filled), gaps


def vendor_long(frame: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A vendor's wide frame (date with time, symbol, fields) as a long panel of days without null rows; and the wanted symbols that it leaves empty."""
    fields = [c for c in PRICE_FIELDS if c in frame.columns]
    long = melt_panel(frame.withColumn("date", F.to_date("date")), fields)
    missing = wanted.select("symbol").distinct().join(long.select("symbol").distinct(), "symbol", "left_anti")
    return long, missing
