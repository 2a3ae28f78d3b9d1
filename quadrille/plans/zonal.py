"""A run of zonal jobs out of a job file: each raster is read once for all zones that ask for it."""

from __future__ import annotations

import glob
import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.functions.systems import System
from quadrille.functions.systems import system as numbered_system
from quadrille.operators import rasters as R
from quadrille.operators import spatial as S
from quadrille.operators.attributes import require
from quadrille.sources import files, geopackage
from quadrille.sources import rasters as RF
from quadrille.sources.staging import new_path, staged

#: Operations on rasters, and what ``rasters.zonal_stats`` calls them; operations on layers.
RASTER_OPERATIONS = {"sum": "sum", "mean": "mean", "stdev": "stdev", "valid_count": "valid_count", "total_count": "total_count", "area_ha_valid": "area_ha_valid", "area_ha_total": "area_ha_total", "proportion_valid_nonzero": "proportion_valid_nonzero"}
LAYER_OPERATIONS = ("intersect_area_ha", "intersect_length_km")


@dataclass(frozen=True)
class Zones:
    vector: str
    layer: str | None
    key: str


@dataclass(frozen=True)
class Job:
    name: str
    zones: Zones
    operations: tuple[str, ...]
    rasters: tuple[str, ...]
    measure: tuple[str, str | None] | None
    csv: str | None
    gpkg: str | None


def jobs_of(path: str) -> list[Job]:
    """The jobs of a file, checked before any of them runs: fields, operations, and that there are rasters for a pattern."""
    out = []
    for j in files.read_jobs(path)[1]:
        missing = [f for f in ("agg_vector", "agg_field", "operations") if not j.get(f)]
        if missing:
            raise ValueError(f"{j['name']}: missing fields: {', '.join(missing)}")
        operations = tuple(o.strip() for o in j["operations"].split(",") if o.strip())
        unknown = [o for o in operations if o not in RASTER_OPERATIONS and o not in LAYER_OPERATIONS]
        if unknown:
            raise ValueError(f"{j['name']}: unknown operations: {', '.join(unknown)}")
        found = tuple(sorted(glob.glob(j["base_raster_pattern"]))) if "base_raster_pattern" in j else ()
        if any(o in RASTER_OPERATIONS for o in operations) and not found:
            raise FileNotFoundError(f"{j['name']}: no raster matches {j.get('base_raster_pattern', '(no pattern)')}")
        stems = [stem_of(f) for f in found]
        if len(set(stems)) < len(stems):
            raise ValueError(f"{j['name']}: rasters of the same name: {', '.join(sorted(s for s in set(stems) if stems.count(s) > 1))}")
        measure = (j["base_measure_vector"], j.get("base_measure_layer")) if "base_measure_vector" in j else None
        if any(o in LAYER_OPERATIONS for o in operations) and measure is None:
            raise ValueError(f"{j['name']}: missing fields: base_measure_vector")
        out.append(Job(j["name"], Zones(j["agg_vector"], j.get("agg_layer"), j["agg_field"]), operations, found, measure, j.get("output_csv"), j.get("output_gpkg")))
    return out


def stem_of(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[0]


def read_layer(spark: SparkSession, path: str, layer: str | None, geometry: str = "rings") -> tuple[DataFrame, System]:
    reader = spark.read.format("geopackage").option("geometry", geometry)
    df = (reader.option("layer", layer) if layer else reader).load(path)
    return df, geopackage.definition_of(path, layer)


def zone_rows(spark: SparkSession, zones: Zones) -> tuple[DataFrame, System]:
    """(key as text, geom) of a zone layer, and its system."""
    df, system = read_layer(spark, zones.vector, zones.layer)
    require(df, [zones.key])
    return df.select(F.col(f"`{zones.key}`").cast("string").alias("key"), "geom"), system


def raster_values(spark: SparkSession, jobs: list[Job]) -> DataFrame | None:
    """(zones, key, raster, one column an operation), staged: for each raster all zone sets that ask for it go through one reading."""
    asked: dict[str, dict[Zones, None]] = {}
    for job in jobs:
        for path in job.rasters:
            asked.setdefault(path, {})[job.zones] = None
    numbers = {z: n for n, z in enumerate(dict.fromkeys(j.zones for j in jobs))}
    parts = []
    for path, sets in asked.items():
        info, grid = RF.raster_info(spark, path).first(), RF.raster_grid(path)
        tiles = RF.read_raster(spark, path)
        stacked = []
        for zones in sets:
            rows, system = zone_rows(spark, zones)
            geom = G.reprojected(F.col("geom"), system, numbered_system(info["srid"])) if info["srid"] else F.col("geom")
            stacked.append(rows.select(F.struct(F.lit(numbers[zones]).alias("zones"), "key").alias("zone"), geom.alias("geom")))
        stats = R.zonal_stats(tiles, reduce(DataFrame.union, stacked), grid, "zone")
        parts.append(stats.select("zone.zones", "zone.key", F.lit(path).alias("raster"), *[F.col(c).cast("double").alias(o) for o, c in RASTER_OPERATIONS.items()]))
    return staged(reduce(DataFrame.union, parts), "zonal") if parts else None


def measured(spark: SparkSession, job: Job, cell: float) -> DataFrame:
    """(key, the job's layer operations) in a system in metres."""
    zones, system = zone_rows(spark, job.zones)
    work = system if system.metric() else numbered_system(5070)
    zones = zones.withColumn("geom", G.reprojected(F.col("geom"), system, work))
    out = zones.select("key")
    for operation in job.operations:
        if operation == "intersect_area_ha":
            df, other = read_layer(spark, *job.measure)
            features = df.select(G.reprojected(F.col("geom"), other, work).alias("geom"))
            out = out.join(S.overlay_area(zones, features, "key", cell), "key")
        elif operation == "intersect_length_km":
            df, other = read_layer(spark, *job.measure, "wkb")
            lines = df.select(F.explode(G.reprojected(G.lines_from_wkb("geom"), other, work)).alias("geom"))
            out = out.join(S.overlay_length(zones, lines, "key", cell), "key")
    return out


def run_jobs(spark: SparkSession, path: str, cell: float = 10_000.0, overwrite: bool = False) -> dict[str, dict[str, str]]:
    """Run all jobs of a file; the paths written, by job and kind.

    A job's table has the zones' fields and, for each operation and raster, a column
    ``<operation>_<raster stem>``, or the layer operation's own name. Zones that nothing
    meets stay. Rasters are in the zones' systems or are given theirs.
    """
    geopackage.register(spark)
    jobs = jobs_of(path)
    values = raster_values(spark, jobs)
    numbers = {z: n for n, z in enumerate(dict.fromkeys(j.zones for j in jobs))}
    written: dict[str, dict[str, str]] = {}
    for job in jobs:
        layer, _ = read_layer(spark, job.zones.vector, job.zones.layer)
        layer = layer.withColumn(job.zones.key, F.col(f"`{job.zones.key}`").cast("string"))
        kept = F.col(f"`{job.zones.key}`")
        out = layer
        wanted = [o for o in job.operations if o in RASTER_OPERATIONS]
        if wanted:
            mine = values.filter(F.col("zones") == numbers[job.zones])
            wide = [F.max(F.when(F.col("raster") == r, F.col(o))).alias(f"{o}_{stem_of(r)}") for r in job.rasters for o in wanted]
            table = mine.groupBy(F.col("key").alias("__key")).agg(*wide)
            out = out.join(table, kept == F.col("__key"), "left").drop("__key")
        if job.measure:
            table = measured(spark, job, cell).withColumnRenamed("key", "__key")
            out = out.join(table, kept == F.col("__key"), "left").drop("__key")
        # A row a zone: small beside what it was made of, and both files are made of it.
        out = staged(out, "zonal-table")
        written[job.name] = {}
        if job.csv:
            if overwrite and os.path.exists(job.csv):
                os.remove(job.csv)
            draft = files.write_csv(out.drop("geom", "fid").coalesce(1), new_path(spark, "zonal-csv"))
            written[job.name]["csv"] = files.placed(spark, draft, job.csv)
        if job.gpkg:
            srid = geopackage.system_of(job.zones.vector, job.zones.layer)
            out.coalesce(1).write.format("geopackage").mode("overwrite" if overwrite else "append").option("layer", job.name).option("srid", srid).save(job.gpkg)
            written[job.name]["gpkg"] = job.gpkg
    return written
