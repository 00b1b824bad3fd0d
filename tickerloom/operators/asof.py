"""As-of joins."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, tolerance_days: int | None = None, how: str = "left") -> DataFrame:
    """left with the columns of the last row of right whose keys are equal and whose date is not later.

    Both sides are sorted once by key and date, and each left row takes the last right row before it: one
    shuffle and no growth, however many rows a key has. tolerance_days bounds how much earlier the right row may
    be. Rows of either side with a null date or key match nothing; left rows without a key stay out of the shuffle. Of
right rows with one date the greatest by their other columns counts.
    """
    extra = [c for c in right.columns if c not in by and c != right_on]
    value = F.struct(F.col(right_on).alias(f"_{right_on}"), *(F.col(c) for c in extra))
    whole = functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in by], F.lit(True))
    rows_right = right.where(F.col(right_on).isNotNull()).where(whole).select(*by, F.col(right_on).alias("_at"), F.lit(0).alias("_side"), value.alias("_right"), F.lit(None).cast(left.select(F.struct("*").alias("s")).schema["s"].dataType).alias("_left"))
    rows_left = left.where(whole).select(*by, F.col(left_on).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(rows_right.schema["_right"].dataType).alias("_right"), F.struct("*").alias("_left"))
    order = Window.partitionBy(*by).orderBy("_at", "_side", "_right")
    found = rows_left.unionByName(rows_right).withColumn("_found", F.last("_right", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("_side = 1")
    if tolerance_days is not None:
        near = F.datediff("_at", f"_found._{right_on}") <= tolerance_days
        found = found.withColumn("_found", F.when(near, F.col("_found")))
    out_date = right_on if right_on not in left.columns else f"{right_on}_asof"
    keyless = left.where(~whole).select(F.struct("*").alias("_left"), F.lit(None).cast(rows_right.schema["_right"].dataType).alias("_found"))
    found = found.select("_left", "_found").unionByName(keyless)
    out = found.select("_left.*", F.col(f"_found._{right_on}").alias(out_date), *(F.col("_found")[c].alias(c) for c in extra))
    return out.where(F.col(out_date).isNotNull()) if how == "inner" else out


def snapshot_asof(dates: DataFrame, snapshots: DataFrame, on: str, snap: str = "quarter_end_date") -> DataFrame:
    """dates with the latest snapshot date on or before each; snapshots is a short list of dates."""
    keys = dates.select(on).distinct()
    near = keys.join(F.broadcast(snapshots.select(snap).distinct()), F.col(snap) <= F.col(on)).groupBy(on).agg(F.max(snap).alias(snap))
    return dates.join(F.broadcast(near), on)
