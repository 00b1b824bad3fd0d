"""Strategy configurations and their execution: one plan for any number of runs."""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators import attribution, holdings, metrics, panel, select, signals, timeline, weights
from tickerloom.sources.staging import staged, staged_by


@dataclass
class Config:
    """One run. Null thresholds and caps are off."""

    run_id: str
    start: datetime.date | None = None
    end: datetime.date | None = None
    rebal_freq: str = "Q"
    custom_rebal_dates: list | None = None
    rebal_offset: int = 1
    weighting: str = "ffmcap"
    tilt_gamma: float = 0.5
    score_threshold: float = 0.0
    signal: str | None = None
    signal_top_n: int | None = None
    signal_top_quantile: float | None = None
    winsor_sigma: float = 3.0
    reporting_lag_days: int = 60
    max_stock_wt: float | None = 0.20
    max_sector_wt: float | None = None
    max_size_bucket_wt: dict | None = None
    min_price: float = 1.0
    min_adv_inr: float | None = None
    min_history_days: int = 0
    max_universe_rank: int | None = None
    min_free_float_pct: float | None = None
    exclude_symbols: list = field(default_factory=list)
    tcost_base: float = 15.0
    tcost_k: float = 8.0
    tcost_floor: float = 10.0
    tcost_ceiling: float = 150.0
    cash_buffer: float = 0.0
    benchmark: str = "default"


SCHEMA = """run_id string, start date, end date, rebal_freq string, custom_rebal_dates array<date>, rebal_offset int, weighting string,
    tilt_gamma double, score_threshold double, signal string, signal_top_n int, signal_top_quantile double, winsor_sigma double,
    reporting_lag_days int, max_stock_wt double, max_sector_wt double, max_size_bucket_wt map<string,double>, min_price double, min_adv_inr double,
    min_history_days int, max_universe_rank int, min_free_float_pct double, exclude_symbols array<string>, tcost_base double, tcost_k double,
    tcost_floor double, tcost_ceiling double, cash_buffer double, benchmark string"""

SIZE_BUCKETS = {"large": (1, 100), "mid": (101, 250), "small": (251, None)}


def configs_table(spark: SparkSession, configs: list[Config]) -> DataFrame:
    for c in configs:
        if c.signal is None and c.weighting in ("score_weighted", "ffmcap_tilt"):
            raise ValueError(f"{c.run_id}: {c.weighting} needs a signal")
        if c.signal_top_n is not None and c.signal_top_quantile is not None:
            raise ValueError(f"{c.run_id}: signal_top_n and signal_top_quantile exclude each other")
    return spark.createDataFrame([dataclasses.astuple(c) for c in configs], SCHEMA)


def recorded(configs: DataFrame, extra: list[Callable] | None = None) -> DataFrame:
    """configs as they are kept with their results: with extra_filters, the names of the user's filters; signals are names already."""
    names = [getattr(f, "__name__", type(f).__name__) for f in extra or []]
    return configs.withColumn("extra_filters", F.array(*map(F.lit, names)).cast("array<string>"))


@dataclass
class Market:
    """Panels that all runs share. dense, adv, series and financials have the names that are ever in the universe, as pools and holdings have no others; cal has the days of all quotes."""

    cal: DataFrame
    dense: DataFrame
    adv: DataFrame
    series: DataFrame
    universe: DataFrame
    sectors: DataFrame
    financials: DataFrame
    benchmark: DataFrame

    @classmethod
    def build(cls, quotes: DataFrame, universe: DataFrame, sectors: DataFrame, financials: DataFrame, benchmark: DataFrame, cal: DataFrame | None = None) -> Market:
        """The panels staged once: calendar (cal, if it is staged already), dense prices with traded value, the same as arrays in buckets of symbols, universe and the rest."""
        cal, universe = cal if cal is not None else staged(timeline.calendar(quotes)), staged(universe)
        named = lambda df: df.join(universe.select("symbol").distinct(), "symbol", "left_semi").select(*df.columns)
        both = staged(panel.with_adv(panel.dense_returns(staged(named(quotes)), cal)))
        return cls(cal, both.drop("adv"), both.select("symbol", "date", "cal_idx", "adv"), staged_by(panel.by_symbol(both), "symbol"), universe, staged(sectors), staged(named(financials)), staged(benchmark))


@dataclass
class Result:
    """Tables of all runs, by run_id."""

    configs: DataFrame
    targets: DataFrame
    segments: DataFrame
    weights: DataFrame
    trades: DataFrame
    costed: DataFrame
    turnover: DataFrame
    returns: DataFrame

    def summary(self) -> DataFrame:
        return metrics.summary(self.returns, self.weights, self.turnover)

    def contribution(self, market: Market) -> DataFrame:
        return attribution.sector_contribution(self.weights, self.trades, self.costed, self.returns, market.sectors, market)

    def active_sectors(self, market: Market) -> DataFrame:
        return attribution.active_sector_weights(self.weights, market.universe, market.sectors)


def targets(market: Market, configs: DataFrame, extra: list[Callable] | None = None, buckets: dict | None = None) -> DataFrame:
    """(run_id, rebal_date, symbol, sector, raw_weight, weight) of every rebalance of every run; rebalances without a name are left out."""
    rebalances = staged(timeline.schedule(configs, market.cal, market.universe))
    names = select.eligible(select.pool(market, rebalances, configs), extra, market)
    names = names.withColumn("size_bucket", weights.size_bucket(F.col("rank"), buckets or SIZE_BUCKETS))
    names = staged(names)
    chosen = staged(select.selected(names, signals.scores(market, names)))
    return weights.with_cash(weights.capped(staged(weights.raw_weights(chosen))))


def run_bounds(configs: DataFrame, cal: DataFrame) -> DataFrame:
    """(run_id, first_idx, last_idx): the trading days of each run; the calendar is searched once for each distinct pair of bounds."""
    spans = configs.select("start", "end").distinct()
    inside = (F.col("start").isNull() | (F.col("date") >= F.col("start"))) & (F.col("end").isNull() | (F.col("date") <= F.col("end")))
    found = spans.join(F.broadcast(cal), inside).groupBy(F.col("start").alias("_start"), F.col("end").alias("_end")).agg(F.min("cal_idx").alias("first_idx"), F.max("cal_idx").alias("last_idx"))
    return configs.join(found, F.col("start").eqNullSafe(F.col("_start")) & F.col("end").eqNullSafe(F.col("_end"))).select("run_id", "first_idx", "last_idx")


def run_strategies(market: Market, configs: DataFrame, extra: list[Callable] | None = None, buckets: dict | None = None) -> Result:
    """Run all configurations together; the panels are read once whatever their number."""
    wanted = staged(targets(market, configs, extra, buckets))
    at = wanted.select("run_id", "rebal_date").distinct().join(configs.select("run_id", "rebal_offset"), "run_id")
    trade = timeline.trade_dates(at, market.cal)
    bounds = run_bounds(configs, market.cal)
    segs = staged(holdings.segments(trade, bounds))
    vals = staged(holdings.values(wanted, segs, market))
    trades = staged(holdings.trades_table(wanted, segs, vals))
    costed = staged(holdings.costs(trades, configs, market))
    turned = staged(holdings.turnover(trades, costed))
    idle = holdings.cash_before_first_trade(segs, bounds, market.cal)
    returns = staged(holdings.returns_table(holdings.gross_returns(vals), idle, turned, holdings.benchmark_returns(market.benchmark, market.cal)))
    held = holdings.daily_weights(vals).unionByName(idle.select("run_id", "cal_idx", "date", F.lit("CASH").alias("symbol"), F.lit(1.0).alias("weight")))
    return Result(recorded(configs, extra), wanted, segs, staged(held), trades, costed, turned, returns)
