"""File listings, keyed CSV tables, job files and small reports."""

from __future__ import annotations

import configparser
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quadrille.sources.staging import staged, unstage


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, folder, stem, suffix, mtime, position) of the files in a folder, or in its subfolders for patterns like ``*/*.csv``.

    Only names and times are read. ``position`` counts the sorted paths of all from 1;
    a listing has a row a file, so one sort of it is small.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", os.path.basename(pattern)).load(f"{folder}/{os.path.dirname(pattern)}".rstrip("/"))
    name = F.element_at(F.split("path", "/"), -1)
    stem, suffix = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    rows = files.select("path", F.element_at(F.split("path", "/"), -2).alias("folder"), stem.alias("stem"), suffix.alias("suffix"), F.unix_micros("modificationTime").alias("mtime"))
    return numbered(rows, "path", "position")


def numbered(df: DataFrame, order: str | list[str], column: str = "row_no") -> DataFrame:
    """Add the 1-based place of each row in the order of ``order`` (rows that tie in any order), out of a sort by ranges and the ranges' sizes.

    The sorted rows are written once, with the task that wrote them and their place in it,
    and sizes and rows are both read from there: another run of the sort would deal them
    out anew. The sizes are a row a task; no task holds the table.
    """
    spark = df.sparkSession
    laid = staged(df.orderBy(*([order] if isinstance(order, str) else order)).withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__id", 33)
    sizes = {r[0]: r[1] for r in laid.groupBy(part.alias("p")).count().collect()}
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    offsets = spark.createDataFrame(starts or [(0, 0)], "__p long, __before long")
    placed = laid.withColumn("__p", part).join(F.broadcast(offsets), "__p")
    return placed.withColumn(column, F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1) + 1).drop("__p", "__before", "__id")


def reindexed(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of ``right`` numbered as their keys stand in ``left``, sorted by ``order``; keys that ``left`` lacks go, keys that ``right`` lacks get nulls."""
    places = numbered(left.select(key, order), order)
    return places.select(key, "row_no").join(right, key, "left")


def chunked(df: DataFrame, order: str, size: int = 100) -> DataFrame:
    """Add ``chunk``: rows in order, ``size`` to a chunk, from 0."""
    return numbered(df, order, "__no").withColumn("chunk", F.floor((F.col("__no") - 1) / size)).drop("__no")


def read_keyed(spark: SparkSession, path: str | list[str], key: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A CSV table with a header; types are inferred, but ``key`` stays text, leading zeros and all.

    ``columns`` are the only ones parsed.
    """
    seen = spark.read.csv(path, header=True, inferSchema=True).schema
    if key is not None and key not in seen.names:
        raise ValueError(f"{path}: missing fields: {key}")
    schema = StructType([StructField(f.name, StringType() if f.name == key else f.dataType) for f in seen.fields])
    out = spark.read.csv(path, header=True, schema=schema)
    return out.select(*[F.col(f"`{c}`") for c in columns]) if columns else out


def measured(df: DataFrame, measure: str, key: str, drop: tuple[str, ...] = ("geom",)) -> DataFrame:
    """The order of report columns: the measure, the key, and the other fields but ``drop`` as they stood."""
    return df.select(measure, key, *[F.col(f"`{c}`") for c in df.columns if c not in (measure, key, *drop)])


def plain_text(df: DataFrame) -> DataFrame:
    """Text fields, and the items of lists of them, with invalid characters replaced; binary ones are read as text."""
    made = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        fix = lambda x: F.make_valid_utf8(x.cast("string"))
        made.append((fix(c) if kind in ("string", "binary") else F.array_join(F.transform(c, fix), ",") if kind in ("array<string>", "array<binary>") else c).alias(f.name))
    return df.select(*made)


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> str:
    """A folder of CSV files with headers, one a partition; parents are made, what is there is refused unless ``overwrite``."""
    plain_text(df).write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True)
    return path


def write_failures(df: DataFrame, path: str, keys: list[str]) -> bool:
    """A CSV of (keys, reason) of the rows with a reason, if there are any; whether there were."""
    failed = staged(df.filter(F.col("reason").isNotNull()).select(*keys, "reason"), "failures")
    there = not failed.isEmpty()
    if there:
        write_csv(failed, path, overwrite=True)
    unstage(failed)
    return there


def summary(counts: DataFrame, name: str, value: str) -> str:
    """``name=value`` with separators of thousands, sorted, of a small table of counters."""
    text = F.concat(F.col(name), F.lit("="), F.format_number(F.col(value), 0))
    return " ".join(r[0] for r in counts.orderBy(name).select(text).collect())


def read_jobs(path: str) -> tuple[dict[str, str], list[dict[str, str]]]:
    """The project and the jobs, in order, of a job file of sections ``[project]`` and ``[job:NAME]``; it is small and read by the driver.

    Values that start with ``./`` or ``../`` are paths relative to the file.
    """
    parsed = configparser.ConfigParser(interpolation=None, inline_comment_prefixes=("#", ";"))
    with open(path, encoding="utf-8") as f:
        parsed.read_file(f)
    if "project" not in parsed:
        raise ValueError(f"{path}: no [project] section")
    base = os.path.dirname(os.path.abspath(path))
    full = lambda v: os.path.normpath(os.path.join(base, v)) if v.startswith(("./", "../")) else v
    section = lambda name: {k: full(v) for k, v in parsed[name].items()}
    jobs = [{"name": n.removeprefix("job:"), **section(n)} for n in parsed.sections() if n.startswith("job:")]
    if len({j["name"] for j in jobs}) < len(jobs) or not jobs:
        raise ValueError(f"{path}: no jobs, or two of one name")
    return section("project"), jobs


def placed(spark: SparkSession, folder: str, path: str) -> str:
    """The one data file in a written folder, moved to ``path``; for small results that others read as a single file."""
    made = spark._jvm.org.apache.hadoop.fs.Path
    source, target = made(folder), made(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    (part,) = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(part, target):
        raise FileExistsError(f"{path} can't be made")
    fs.delete(source, True)
    return path
