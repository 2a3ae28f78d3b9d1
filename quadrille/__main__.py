"""``python -m quadrille COMMAND``: combine results, run zonal jobs, write masks, clip lands."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quadrille.operators.rasters import read_reclass
from quadrille.plans.combine import Group, combine_results
from quadrille.plans.products import land_layers
from quadrille.plans.zonal import run_jobs
from quadrille.sources import files, geopackage, rasters


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quadrille", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    combine = commands.add_parser("combine", help="the newest results of each job, side by side")
    combine.add_argument("results")
    combine.add_argument("output")
    combine.add_argument("--groups", required=True, help="JSON file of [{name, output, jobs}]")
    combine.add_argument("--key", default="GEOID")
    combine.add_argument("--check-geometry", action="store_true")
    zonal = commands.add_parser("zonal", help="the zonal jobs of a job file")
    zonal.add_argument("jobs")
    zonal.add_argument("--cell", type=float, default=10_000.0)
    zonal.add_argument("--overwrite", action="store_true")
    masks = commands.add_parser("masks", help="a mask of a class raster for each reclass table")
    masks.add_argument("raster")
    masks.add_argument("folder")
    masks.add_argument("tables", nargs="+", help="CSV files with the columns id and reclass")
    masks.add_argument("--overwrite", action="store_true")
    lands = commands.add_parser("lands", help="all and public lands inside a boundary")
    lands.add_argument("features")
    lands.add_argument("boundary")
    lands.add_argument("output")
    lands.add_argument("--tolerance", type=float, default=15.0)
    lands.add_argument("--cell", type=float, default=50_000.0)
    lands.add_argument("--overwrite", action="store_true")
    return out


def existing(*paths: str) -> None:
    lost = [p for p in paths if not os.path.exists(p)]
    if lost:
        raise FileNotFoundError(f"not there: {', '.join(lost)}")


def run(spark: SparkSession, arguments: list[str]) -> list[str]:
    """Lines that say what was written."""
    a = parser().parse_args(arguments)
    if a.command == "combine":
        existing(a.results, a.groups)
        with open(a.groups, encoding="utf-8") as f:
            groups = [Group(g["name"], g["output"], tuple(g["jobs"])) for g in json.load(f)]
        return combine_results(spark, a.results, a.output, groups, a.key, check_geometry=a.check_geometry)
    if a.command == "zonal":
        existing(a.jobs)
        return [f"{job} {kind} {path}" for job, made in run_jobs(spark, a.jobs, a.cell, a.overwrite).items() for kind, path in made.items()]
    if a.command == "masks":
        existing(a.raster, *a.tables)
        tables = {os.path.splitext(os.path.basename(t))[0]: read_reclass(spark, t) for t in a.tables}
        return list(rasters.write_masks(spark, a.raster, tables, a.folder, overwrite=a.overwrite).values())
    existing(a.features, a.boundary)
    from quadrille.functions import geometry as G

    geopackage.register(spark)
    system, edge_system = geopackage.definition_of(a.features), geopackage.definition_of(a.boundary)
    work = system if system.metric() else geopackage.numbered_system(5070)
    read = lambda path, s: spark.read.format("geopackage").option("geometry", "rings").load(path).withColumn("geom", G.reprojected(F.col("geom"), s, work))
    srid = geopackage.system_of(a.features) if work == system else 5070
    counts = land_layers(read(a.features, system), read(a.boundary, edge_system), a.output, srid, a.tolerance, a.cell, a.overwrite)
    return [files.summary(spark.createDataFrame(sorted(counts.items()), "name string, n long"), "name", "n")]


if __name__ == "__main__":
    for line in run(SparkSession.builder.appName("quadrille").getOrCreate(), sys.argv[1:]):
        print(line)
