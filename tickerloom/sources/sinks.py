"""Tables that runs write again and again: reports by run date, and keyed tables whose partitions are rewritten where rows change.

A write replaces whole partitions and leaves the others' files as they are, so it can be repeated: what a lost run has written, the next
run of the same rows writes again. New content is staged before it replaces anything it was read from.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tickerloom.operators.panel import upsert
from tickerloom.schemas import require_columns
from tickerloom.sources.staging import staged

#: Layout of the report tables.
CHECKS = "name STRING, status STRING, metric DOUBLE, detail STRING, run_date DATE, check_group STRING"
OUTLIERS = "symbol STRING, date DATE, close DOUBLE, change DOUBLE, run_date DATE"


def replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Write df by partitions; those that it has rows of are replaced, the others stay. Each partition is written by one task."""
    df.repartition(*partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_checks(checks: DataFrame, path: str, run_date, check_group: str) -> None:
    """Checks (name, status, metric, detail) as the result of a group of checks on a day; an earlier result of both is replaced."""
    own = require_columns(checks, ["name", "status", "metric", "detail"], "checks").select("name", "status", F.col("metric").cast("double").alias("metric"), "detail")
    replace_partitions(own.withColumns({"run_date": F.lit(run_date).cast("date"), "check_group": F.lit(check_group)}), path, ["run_date", "check_group"])


def write_outliers(outliers: DataFrame, path: str, run_date) -> None:
    """Outliers (symbol, date, close, change) of a day, also none of them; an earlier result is replaced."""
    own = require_columns(outliers, ["symbol", "date", "close", "change"], "outliers").select("symbol", "date", "close", "change", F.lit(run_date).cast("date").alias("run_date"))
    own = staged(own)
    if own.isEmpty():  # a day without rows has no partition to replace
        at = own.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/run_date={run_date}")
        at.getFileSystem(own.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
        return
    # moves of one day's run go to as many files as there are shuffle partitions
    own.repartition("symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def read_report(spark: SparkSession, path: str, schema: str, run_date=None, check_group: str | None = None) -> DataFrame:
    """A report table, or the partitions of a day or of a group of checks; without any file an empty table."""
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], schema)
    if run_date is not None:
        rows = rows.where(F.col("run_date") == F.lit(run_date).cast("date"))
    return rows.where(F.col("check_group") == check_group) if check_group is not None else rows


def key_bucket(column: str, buckets: int) -> Column:
    """A partition column for tables keyed by something that no date bounds."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partitions: dict[str, Column]) -> int:
    """Put the rows of new into the Parquet table at path, in the place of rows with equal keys; returns how many partitions changed.

    partitions are columns that follow from the keys, so rows of one key lie in one partition. Only partitions that new has
    rows of are read and rewritten; the driver holds their values, not more than there are partitions. Rows without a key
    column are an error, as nothing could replace them. An empty table makes no change.
    """
    names = list(partitions)
    new = staged(new.withColumns(partitions))
    if not new.where(functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])).isEmpty():
        raise ValueError(f"rows without {' or '.join(keys)} can't be upserted")
    touched = [r.asDict() for r in new.select(*names).distinct().collect()]
    if not touched:
        return 0
    try:
        existing = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        replace_partitions(upsert(new.limit(0), new, keys), path, names)
        return len(touched)
    # literals prune the scan to the touched partitions
    here = functools.reduce(Column.__or__, [functools.reduce(Column.__and__, [F.col(n).eqNullSafe(F.lit(v)) for n, v in t.items()]) for t in touched])
    own = existing.where(here).select(*(F.col(f.name).cast(new.schema[f.name].dataType).alias(f.name) if f.name in new.columns else F.col(f.name) for f in existing.schema.fields))
    replace_partitions(staged(upsert(own, new, keys)), path, names)
    return len(touched)


def upsert_panel(spark: SparkSession, path: str, new: DataFrame) -> int:
    """Newer rows of a long panel (date, symbol, parameter, value), stored by parameter and year."""
    return upsert_table(spark, path, new.select("date", "symbol", "parameter", F.col("value").cast("double").alias("value")), ["date", "symbol", "parameter"], {"parameter": F.col("parameter"), "year": F.year("date")})


def upsert_shares(spark: SparkSession, path: str, new: DataFrame) -> int:
    """Newer share counts, keyed by symbol and date, stored by year."""
    return upsert_table(spark, path, new, ["symbol", "date"], {"year": F.year("date")})


def upsert_classification(spark: SparkSession, path: str, new: DataFrame, buckets: int = 16) -> int:
    """Newer classifications, one a symbol, stored in buckets of symbols."""
    return upsert_table(spark, path, new, ["symbol"], {"bucket": key_bucket("symbol", buckets)})
