"""The newest results of declared jobs, side by side per group, as CSV or layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.operators import attributes as T
from quadrille.sources import files, geopackage

#: The class names whose areas are derived.
CLASSES = ("forests", "grasslands", "shrubland", "water_snow", "wetlands")


@dataclass(frozen=True)
class Group:
    """Jobs, in the order of their columns, and the stem of what is written."""

    name: str
    output: str
    jobs: tuple[str, ...]


def found(listed: DataFrame, group: Group, suffix: str, folder: str | None = None) -> list[str] | None:
    """Paths of the newest file of each of a group's jobs; None if there is none of any, an error if only of some.

    Declared jobs are few, and so is what reaches the driver: a path a job.
    """
    some = listed.filter(F.col("suffix") == suffix)
    if folder is not None:
        some = some.filter(F.col("folder") == folder)
    stamped = T.stamped(some).filter(F.col("job").isin(list(group.jobs)))
    ts = F.coalesce("ts", F.lit("0001-01-01").cast("timestamp"))
    newest = {r["job"]: r["path"] for r in stamped.groupBy("job").agg(F.max_by("path", F.struct(ts, "mtime", "path")).alias("path")).collect()}
    if not newest:
        return None
    missing = sorted(set(group.jobs) - set(newest))
    if missing:
        raise FileNotFoundError(f"missing {suffix} results of {group.output}: {', '.join(missing)}")
    return [newest[j] for j in group.jobs]


def geometry_conflicts(a: DataFrame, b: DataFrame, key: str) -> list[str]:
    """Up to ten keys whose geometries differ or are missing on either side."""
    both = a.select(key, F.col("geom").alias("x")).join(b.select(key, F.col("geom").alias("y")), key, "left")
    area = G.difference_area(G.from_wkb("x"), G.from_wkb("y"))
    return [r[0] for r in both.filter(~F.coalesce(area <= 1e-9, F.lit(False))).select(key).orderBy(key).limit(10).collect()]


def combined(spark: SparkSession, paths: list[str], suffix: str, key: str, check_geometry: bool = False) -> DataFrame:
    """The files of one group side by side on a text key, class areas derived; a layer keeps the first file's geometry."""
    if suffix == ".csv":
        frames = [(p, files.read_keyed(spark, p, key)) for p in paths]
    else:
        geopackage.register(spark)
        read = lambda p, shape: spark.read.format("geopackage").option("includeGeometry", str(shape).lower()).load(p).drop("fid")
        frames = [(p, read(p, k == 0 or check_geometry)) for k, p in enumerate(paths)]
    for path, df in frames:
        T.require(df, [key])
    frames = [(p, df.withColumn(key, F.col(key).cast("string"))) for p, df in frames]
    if check_geometry and suffix == ".gpkg":
        for path, df in frames[1:]:
            differ = geometry_conflicts(frames[0][1], df, key)
            if differ:
                raise ValueError(f"{path}: geometries that differ: {', '.join(differ)}")
        frames = [frames[0], *[(p, df.drop("geom")) for p, df in frames[1:]]]
    return T.class_areas(T.combine(frames, key, ignore=("geom",)), list(CLASSES))


def combine_results(spark: SparkSession, results: str, output: str, groups: list[Group], key: str = "GEOID", stamp: str | None = None, check_geometry: bool = False) -> list[str]:
    """Write every group that has results, and return the paths; it is an error if none has.

    ``results`` holds the files themselves, or a folder for each group.
    """
    nested = not files.listing(spark, results, "*/*").isEmpty() if _folders(spark, results, groups) else False
    listed = files.listing(spark, results, "*/*" if nested else "*")
    stamp = stamp or spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy_MM_dd_HH_mm_ss")).first()[0]
    written = []
    for group in groups:
        for suffix in (".csv", ".gpkg"):
            paths = found(listed, group, suffix, group.name if nested else None)
            if paths is None:
                continue
            df, path = combined(spark, paths, suffix, key, check_geometry), f"{output}/{group.output}_{stamp}{suffix}"
            if suffix == ".csv":
                files.write_csv(df, path)
            else:
                df.write.format("geopackage").mode("append").option("layer", group.output).save(path.removeprefix("file:"))
            written.append(path)
    if not written:
        raise RuntimeError(f"no complete group of results in {results}")
    return written


def _folders(spark: SparkSession, results: str, groups: list[Group]) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(results).getFileSystem(spark._jsc.hadoopConfiguration())
    return any(fs.isDirectory(path(f"{results}/{g.name}")) for g in groups)
