"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all word and line rules here: U+0020 and U+0009 to U+000D.
WS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Where the session names none, a local one (tests on one machine) makes and sets
    one; on a cluster that is an error, since a machine's own folder is lost with it.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quadrille-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


_left: dict[str, SparkSession] = {}

#: Bytes of rows that go to a Python worker at a time; at Spark's 64 MB, the rows, their columns and their values in Python add up.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bound Arrow batches by BATCH_BYTES in what runs within; the session's own bound holds again afterwards."""
    setting, most = BATCH_BYTES
    was = spark.conf.get(setting)
    spark.conf.set(setting, most)
    try:
        yield
    finally:
        spark.conf.set(setting, was)


def staged(df: DataFrame, tag: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back; also its path.

    This cuts the lineage, and what was computed survives lost executors. What an
    operator doesn't remove by itself, since its result still reads it, goes with
    ``release``, at the end of the program at the latest.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _left[path] = spark
    with small_batches(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    _left.pop(path, None)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@atexit.register
def release() -> None:
    """Remove all that is still staged; results that read it can't be computed afterwards."""
    for path, spark in list(_left.items()):
        with suppress(Exception):  # the session may be over
            unstage(spark, path)


#: No more keys than this can be hot, so they may be broadcast and salted.
HOT_KEYS, SALTS = 1000, 64


def met(rows: DataFrame, found: DataFrame, keys: list[str], by: list[str], count: str = "n", how: str = "inner") -> DataFrame:
    """``rows`` joined (``how``: inner or left) with ``found`` on ``keys``, where one key may hold any share of the rows.

    ``found`` (best staged) has one row per key, with the number of that key's rows in
    ``count``, which goes. Keys of over a HOT_KEYS-th of all those rows, of which there
    are fewer than HOT_KEYS, are dealt out to SALTS tasks each, by a hash of ``by``.
    """
    total = found.agg(F.sum(count)).first()[0] or 0
    hot = found.filter(F.col(count) > total // HOT_KEYS)
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col(count) > total // HOT_KEYS, SALTS - 1).otherwise(0))).alias("__salt")
    spread = F.broadcast(hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys]))
    same = [F.col(k) == F.col(f"__hot_{k}") for k in keys]
    dealt = rows.join(spread, same, "left").withColumn("__salt", F.when(F.col(f"__hot_{keys[0]}").isNotNull(), F.pmod(F.xxhash64(*by), F.lit(SALTS))).otherwise(0).cast("int"))
    dealt = dealt.drop(*[f"__hot_{k}" for k in keys])
    return dealt.join(found.select(*[c for c in found.columns if c != count], salts), [*keys, "__salt"], how).drop("__salt")


def barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once a row, however often they are used.

    A plain ``withColumn`` may be merged into each of its uses.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def packed(df: DataFrame, id_col: str, text_col: str, record: str = "__rec") -> DataFrame:
    """(record, __id, __text): the whole row in one struct, beside id and text.

    Internal columns then never clash with whatever else a table carries.
    """
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(record),
        F.col(f"`{id_col}`").alias("__id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"),
    )


def unpacked(df: DataFrame, source: DataFrame, extra: dict[str, Column], record: str = "__rec") -> DataFrame:
    """The columns of ``source`` out of the record, those in ``extra`` replaced or added."""
    kept = [extra[c].alias(c) if c in extra else F.col(record).getField(c).alias(c) for c in source.columns]
    return df.select(*kept, *[v.alias(c) for c, v in extra.items() if c not in source.columns])


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())
