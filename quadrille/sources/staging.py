"""Tables written to a folder that driver and executors share, so that what follows reads them as they are."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share: the session's checkpoint folder; a local one only where the session is local."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quadrille-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch(spark)}/{tag}-{uuid.uuid4().hex}"


_left: dict[str, SparkSession] = {}


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written and read back: computed once, whatever reads it, and not again when executors are lost.

    It goes when the program ends, or with ``unstage``.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    _left[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in tables:
        path = df._staged
        _left.pop(path, None)
        jpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)


@atexit.register
def release() -> None:
    """Remove all that is still staged."""
    for path, spark in list(_left.items()):
        with suppress(Exception):  # the session may be over
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def tasks_of(spark: SparkSession) -> int:
    """For steps whose work is in the CPU, not in bytes, by which Spark would gather them in one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
