"""Input tables, and tables written on the way in the folder that all executors share."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Arrow batches of texts that fit a small executor twice over.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of a few MB, unless the session has sizes of its own."""
    for key, small in _BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, small)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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
        _local[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tables-")
    return _local[context.applicationId]


#: Paths of the tables that the current call has written on the way, if it has asked for them.
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


@contextmanager
def on_the_way() -> Iterator[list[str]]:
    """The paths of tables that are written within, by this thread; see release."""
    token = _on_the_way.set([])
    try:
        yield _on_the_way.get()
    finally:
        _on_the_way.reset(token)


def release(spark: SparkSession, paths: list[str], kept: DataFrame) -> None:
    """Delete those of the tables that nothing reads any more, which are all but those that `kept` reads, and take them off the list."""
    needed = " ".join(kept.inputFiles())
    for path in list(paths):
        if path.rpartition("/")[2] not in needed:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            paths.remove(path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read again: a short lineage that a lost executor can't undo."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _on_the_way.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """The size of all texts, for choosing how many blocks to deal them into."""
    return docs.select(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0


def block_count(size: int, block_bytes: int, least: int = 48) -> int:
    """Blocks of about block_bytes for so many bytes; their number grows with the input, their size does not."""
    return max(least, math.ceil(size / block_bytes))
