"""Tables written on the way, in the folder that driver and executors share.

A staged table has a short plan, is computed once however often it is read, and outlives a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders of local applications without spark.checkpoint.dir.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a local session without one gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="staging-")
    return _local[context.applicationId]


def staged(df: DataFrame) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, key: str) -> DataFrame:
    """staged in buckets of the key, as many as there are shuffle partitions: joins on the key don't shuffle the table again."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"staged_{uuid.uuid4().hex}"
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key).option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)
