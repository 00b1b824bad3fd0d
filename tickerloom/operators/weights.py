"""Target weights: schemes, caps in closed form, cash.

One cap over groups of weights that sum to 1 needs no iteration. With groups in descending order of weight and r
their 0-based place, scale_r = (1 - r * cap) / (weight of the groups from r on). Group r is capped if its
weight times scale_r exceeds the cap; capped groups come first, and the first other group's scale holds for all the rest.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.operators.signals import KEYS
from tickerloom.schemas import CASH
from tickerloom.sources.staging import staged

PASSES = 20
CONVERGED = 1e-10


class InfeasibleCap(ValueError):
    """A cap that no weights can meet."""


def _normalised(raw: Column) -> Column:
    return raw / F.sum(raw).over(Window.partitionBy(*KEYS))


#: Raw weights by scheme, from a name's row.
SCHEMES: dict[str, Callable[[], Column]] = {
    "equal": lambda: F.lit(1.0),
    "ffmcap": lambda: F.when(F.col("free_float_market_cap_inr") > 0, F.col("free_float_market_cap_inr")),
    "score_weighted": lambda: F.greatest(F.lit(0.0), F.col("score") - F.col("score_threshold")),
    "ffmcap_tilt": lambda: F.when(F.col("free_float_market_cap_inr") > 0, F.col("free_float_market_cap_inr") * F.exp(F.col("tilt_gamma") * F.coalesce("score", F.lit(0.0)))),
}


def raw_weights(names: DataFrame) -> DataFrame:
    """names with raw_weight by their run's weighting, summing to 1 in each rebalance; only positive weights stay."""
    scheme = F.lit(None).cast("double")
    for name, f in SCHEMES.items():
        scheme = F.when(F.col("weighting") == name, f()).otherwise(scheme)
    weighed = names.withColumn("_w", scheme)
    bad = weighed.where("weighting in ('score_weighted', 'ffmcap_tilt')").groupBy(*KEYS, "weighting").agg(F.count("score").alias("n"), F.sum("_w").alias("w"))
    bad = bad.where("n = 0 or (weighting = 'score_weighted' and coalesce(w, 0) <= 0)").limit(20).collect()
    if bad:
        raise ValueError("no weights from scores at " + ", ".join(f"{r.run_id} {r.rebal_date}" for r in bad))
    return weighed.where("_w > 0").withColumn("raw_weight", _normalised(F.col("_w"))).drop("_w")


def infeasible(df: DataFrame, group: str, cap: str) -> DataFrame:
    """(run_id, rebal_date, cap, n): rebalances whose n groups can't hold all weight under their cap."""
    n = df.where(F.col(cap).isNotNull()).groupBy(*KEYS, F.col(cap).alias("cap")).agg(F.count_distinct(group).alias("n"))
    return n.where(F.col("cap") * F.col("n") < 1 - 1e-12)


def _check(df: DataFrame, group: str, cap: str) -> None:
    bad = infeasible(df, group, cap).limit(20).collect()
    if bad:
        raise InfeasibleCap(f"{cap} can't hold at " + ", ".join(f"{r.run_id} {r.rebal_date} ({r.n} groups)" for r in bad))


def cap_groups(df: DataFrame, group: str, cap: str, weight: str = "weight") -> DataFrame:
    """df with its weights so that no group exceeds the column cap; the excess goes to the others in proportion. A null cap is off."""
    sums = df.groupBy(*KEYS, group, cap).agg(F.sum(weight).alias("_W"))
    k = Window.partitionBy(*KEYS)
    down = k.orderBy(F.desc("_W"), group)
    sums = sums.withColumns({"_r": F.row_number().over(down) - 1, "_tail": F.sum("_W").over(down.rowsBetween(0, Window.unboundedFollowing))})
    sums = sums.withColumn("_scale", (1 - F.col("_r") * F.col(cap)) / F.col("_tail"))
    sums = sums.withColumn("_capped", F.col("_W") * F.col("_scale") > F.col(cap) * (1 + 1e-15))
    rest = F.min_by(F.when(~F.col("_capped"), F.col("_scale")), F.when(~F.col("_capped"), F.col("_r"))).over(k)
    factor = F.when(F.col(cap).isNull(), 1.0).when(F.col("_capped") | rest.isNull(), F.col(cap) / F.col("_W")).otherwise(rest)
    return df.join(sums.select(*KEYS, group, factor.alias("_f")), [*KEYS, group]).withColumn(weight, F.col(weight) * F.col("_f")).drop("_f")


def size_bucket(rank: Column, buckets: dict[str, tuple[int, int | None]]) -> Column:
    """The name of the first bucket whose ranks, both ends included, hold a rank; else other."""
    out = F.lit("other")
    for name, (low, high) in reversed(buckets.items()):
        inside = rank >= low if high is None else rank.between(low, high)
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def cap_bucket(df: DataFrame, bucket: str, cap: Column, weight: str = "weight") -> DataFrame:
    """df with one named size bucket at most at its cap; the excess goes to all others in proportion."""
    own = F.sum(F.when(F.col("size_bucket") == bucket, F.col(weight)).otherwise(0.0)).over(Window.partitionBy(*KEYS))
    over = df.withColumn("_own", own).withColumn("_cap", cap)
    bad = over.where("_own > _cap and _own >= 1 - 1e-12").select(*KEYS).distinct().limit(20).collect()
    if bad:
        raise InfeasibleCap(f"nothing takes the excess of {bucket} at " + ", ".join(f"{r.run_id} {r.rebal_date}" for r in bad))
    factor = F.when(F.col("_own") > F.col("_cap"), F.when(F.col("size_bucket") == bucket, F.col("_cap") / F.col("_own")).otherwise((1 - F.col("_cap")) / (1 - F.col("_own")))).otherwise(1.0)
    return over.withColumn(weight, F.col(weight) * factor).drop("_own", "_cap")


def capped(df: DataFrame, moving: list[int] | None = None) -> DataFrame:
    """df with weight from raw_weight under max_stock_wt, max_sector_wt and the map max_size_bucket_wt, to a joint fixed point.

    One kind of cap is exact in one pass. With several, each pass works on the rebalances that the last one still moved; those
    that have converged are set aside. The number of rebalances that still move after each pass is added to `moving`.
    """
    df = df.withColumn("weight", F.col("raw_weight"))
    used = df.agg(F.max(F.col("max_stock_wt").isNotNull()).alias("stock"), F.max(F.col("max_sector_wt").isNotNull()).alias("sector"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.map_keys("max_size_bucket_wt"))))).alias("buckets")).first()
    steps = []
    if used.stock:
        _check(df, "symbol", "max_stock_wt")
        steps.append(lambda x: cap_groups(x, "symbol", "max_stock_wt"))
    if used.sector:
        _check(df, "sector", "max_sector_wt")
        steps.append(lambda x: cap_groups(x, "sector", "max_sector_wt"))
    for name in used.buckets or []:
        steps.append(lambda x, name=name: cap_bucket(x, name, F.col("max_size_bucket_wt")[name]))
    if len(steps) <= 1:
        return steps[0](df) if steps else df
    # rebalances under one kind of cap are done after one pass, and need no second one to say so
    kinds = F.col("max_stock_wt").isNotNull().cast("int") + F.col("max_sector_wt").isNotNull().cast("int") + F.coalesce(F.size(F.map_filter("max_size_bucket_wt", lambda k, v: v.isNotNull())), F.lit(0))
    done: list[DataFrame] = []
    for _ in range(PASSES):
        after = df.withColumn("_before", F.col("weight"))
        for step in steps:
            after = step(after)
        change = F.max(F.abs(F.col("weight") - F.col("_before"))).over(Window.partitionBy(*KEYS))
        after = staged(after.withColumn("_moves", (change > CONVERGED) & (kinds > 1)).drop("_before"))
        done.append(after.where("not _moves").drop("_moves"))
        df = after.where("_moves").drop("_moves")
        n = df.select(*KEYS).distinct().count()
        if moving is not None:
            moving.append(n)
        if not n:
            return functools.reduce(DataFrame.unionByName, done)
    raise InfeasibleCap(f"the caps have no joint fixed point after {PASSES} passes")


def with_cash(targets: DataFrame) -> DataFrame:
    """(run_id, rebal_date, symbol, sector, raw_weight, weight) with the cash buffer as a row of its own."""
    scaled = targets.select(*KEYS, "symbol", "sector", "raw_weight", (F.col("weight") * (1 - F.coalesce("cash_buffer", F.lit(0.0)))).alias("weight"))
    cash = targets.where("cash_buffer > 0").groupBy(*KEYS).agg(F.max("cash_buffer").alias("weight"))
    return scaled.unionByName(cash.select(*KEYS, F.lit(CASH).alias("symbol"), F.lit(CASH).alias("sector"), F.lit(0.0).alias("raw_weight"), "weight"))
