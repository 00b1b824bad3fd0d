"""Cross-sectional signals. A signal maps (tables, pool) to (run_id, rebal_date, symbol, raw), once for all runs and dates.

pool has run_id, rebal_date, cal_idx (the rebalance's day), symbol and the run's configuration.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.asof import asof_join

Signal = Callable[["Tables", DataFrame], DataFrame]  # noqa: F821
KEYS = ["run_id", "rebal_date"]


def standardised(df: DataFrame, value: str, by: list[str], sigma, out: str) -> DataFrame:
    """df with out: z-scores of value within by, clipped at sigma, then z-scores again; no spread gives 0.

    A NULL sigma clips nothing; NULL values stay NULL and don't count.
    """
    w = Window.partitionBy(*by)
    sigma = sigma if not isinstance(sigma, int | float) else F.lit(float(sigma))

    def z(c):
        sd = F.stddev_samp(c).over(w)
        return F.when(F.col(c).isNotNull(), F.when(sd.isNull() | (sd == 0), 0.0).otherwise((F.col(c) - F.avg(c).over(w)) / sd))

    clipped = F.when(sigma.isNull(), F.col("_z")).otherwise(F.greatest(-sigma, F.least(sigma, F.col("_z"))))
    first = df.withColumn("_z", z(value)).withColumn("_z", F.when(F.col("_z").isNotNull(), clipped))
    return first.withColumn(out, z("_z")).drop("_z")


def momentum_12_1(tables, pool: DataFrame) -> DataFrame:
    """Close 21 trading days back over close 251 days back, less 1, on the global calendar; none before 252 days exist."""
    at = pool.where("cal_idx >= 251").select(*KEYS, "symbol", "cal_idx").join(tables.series.select("symbol", "closes"), "symbol")
    raw = F.try_divide(F.get("closes", F.col("cal_idx") - 21), F.get("closes", F.col("cal_idx") - 251)) - 1
    return at.select(*KEYS, "symbol", raw.alias("raw")).where("raw is not null")


def vol_inverse(tables, pool: DataFrame) -> DataFrame:
    """One over the standard deviation of the last 252 filled returns; none with fewer than 60 calendar rows."""
    at = pool.where("cal_idx >= 59").select(*KEYS, "symbol", "cal_idx").join(tables.series.select("symbol", "rets"), "symbol")
    last = at.select(*KEYS, "symbol", F.slice("rets", F.greatest(F.col("cal_idx") - 251, F.lit(0)) + 1, F.least(F.col("cal_idx") + 1, F.lit(252))).alias("r"))
    total = lambda f: F.aggregate("r", F.lit(0.0), lambda a, x: a + f(x))
    mean = last.withColumn("m", total(lambda x: x) / F.size("r"))
    vol = F.sqrt(total(lambda x: (x - F.col("m")) * (x - F.col("m"))) / (F.size("r") - 1))
    return mean.select(*KEYS, "symbol", vol.alias("vol")).where("vol > 0").select(*KEYS, "symbol", (1 / F.col("vol")).alias("raw"))


def earnings_growth_yoy(tables, pool: DataFrame) -> DataFrame:
    """Growth of the last net profit, reported by the lag, over that of at least 365 days before; a prior of 0 gives none."""
    profit = tables.financials.where("parameter = 'net_profit'").select("symbol", "date", "value")
    at = pool.select(*KEYS, "symbol", F.date_sub("rebal_date", F.col("reporting_lag_days").cast("int")).alias("known"))
    last = asof_join(at, profit.select("symbol", F.col("date").alias("last_date"), F.col("value").alias("last")), ["symbol"], "known", "last_date", how="inner")
    last = last.withColumn("known_before", F.date_sub("known", 365))
    both = asof_join(last, profit.select("symbol", F.col("date").alias("prior_date"), F.col("value").alias("prior")), ["symbol"], "known_before", "prior_date", how="inner")
    growth = (F.col("last") - F.col("prior")) / F.abs("prior")
    return both.where("prior <> 0 and last is not null").select(*KEYS, "symbol", growth.alias("raw"))


def compose(*parts: tuple[Signal, float]) -> Signal:
    """The weighted sum of standardised signals; a symbol that one lacks counts as 0 there."""

    def signal(tables, pool: DataFrame) -> DataFrame:
        sigma = pool.select(*KEYS, F.col("winsor_sigma").alias("_s")).distinct()
        rows = None
        for part, weight in parts:
            z = standardised(part(tables, pool).join(sigma, KEYS), "raw", KEYS, F.col("_s"), "z")
            own = z.select(*KEYS, "symbol", (F.col("z") * weight).alias("raw"))
            rows = own if rows is None else rows.unionByName(own)
        return rows.groupBy(*KEYS, "symbol").agg(F.sum("raw").alias("raw"))

    return signal


SIGNALS: dict[str, Signal] = {
    "momentum_12_1": momentum_12_1, "vol_inverse": vol_inverse, "earnings_growth_yoy": earnings_growth_yoy,
    "mom_lvol": compose((momentum_12_1, 0.5), (vol_inverse, 0.5)),
}


def scores(tables, pool: DataFrame, name_column: str = "signal") -> DataFrame:
    """(run_id, rebal_date, symbol, score): each run's registered signal, standardised."""
    used = [r[0] for r in pool.select(name_column).where(f"{name_column} is not null").distinct().collect()]  # names of the registry
    rows = None
    for name in sorted(used):
        if name not in SIGNALS:
            raise ValueError(f"no signal {name}; there are {', '.join(SIGNALS)}")
        own = SIGNALS[name](tables, pool.where(F.col(name_column) == name))
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        return pool.where("1 = 0").select(*KEYS, "symbol", F.lit(None).cast("double").alias("score"))
    sigma = pool.select(*KEYS, F.col("winsor_sigma").alias("_s")).distinct()
    return standardised(rows.join(sigma, KEYS), "raw", KEYS, F.col("_s"), "score").select(*KEYS, "symbol", "score")
