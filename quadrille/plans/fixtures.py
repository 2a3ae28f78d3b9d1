"""Zones, features, lines and rasters derived from the standard tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.operators.rasters import Grid, tiles_of
from quadrille.sources.staging import scratch, tasks_of

CELL = 50.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt to all cores by a key: a table of narrow rows is a few splits to Spark, whatever is made of each of them."""
    return df.repartition(tasks_of(df.sparkSession), key)


def zones(spark: SparkSession, sf_dir: str, height: float = 200.0) -> DataFrame:
    """25 boxes of width 200 with text keys."""
    n = F.col("n_nationkey")
    x, y = (n % 5) * 200.0, F.floor(n / 5) * height
    return table(spark, sf_dir, "nation").select(F.lpad(n.cast("string"), 3, "0").alias("geoid"), "n_name", G.box(x, y, x + 200, y + height).alias("geom"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square per part."""
    k, s = F.col("p_partkey"), F.col("p_size")
    x, y = (k * 37) % 1000, (k * 91) % 1000
    rows = spread(table(spark, sf_dir, "part").select(k, s, "p_retailprice"), "p_partkey")
    # As the output of a generator a square is made once, and no filter on it moves ahead of the dealing.
    return rows.select(k.alias("fid"), s.alias("size"), "p_retailprice", F.inline(F.array(F.struct(G.box(x, y, x + s, y + s).alias("geom")))))


def triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower left half of each square."""
    r = F.col("geom")[0]
    return features(spark, sf_dir).withColumn("geom", F.array(F.array(r[0], r[1], r[2], r[3], r[6], r[7], r[0], r[1])))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level line per part."""
    k, s = F.col("p_partkey"), F.col("p_size")
    x, y = ((k * 37) % 1000).cast("double"), ((k * 91) % 1000 + 0.5).cast("double")
    return table(spark, sf_dir, "part").select(F.array(x, y, x + s, y).alias("geom"))


def grid() -> Grid:
    """The square that features lie in."""
    return Grid(0.0, 0.0, 10.0, 10.0, 100, 100, 32)


def event_grid(spark: SparkSession, sf_dir: str) -> Grid:
    """100 columns and a row for every 100 events, 100 rows at least."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return replace(grid(), height=max(100, (-1 if last is None else last) // 100 + 1))


def event_zones(spark: SparkSession, sf_dir: str, grid: Grid) -> DataFrame:
    """The zones, as high as it takes for five of them to span the grid."""
    return zones(spark, sf_dir, grid.height * grid.dy / 5)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a pixel of ``event_grid``; errors are no data."""
    e = table(spark, sf_dir, "events")
    return e.select(F.floor(F.col("event_id") / 100).cast("int").alias("row"), (F.col("event_id") % 100).cast("int").alias("col"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "event_type")


def raster(spark: SparkSession, sf_dir: str, grid: Grid) -> DataFrame:
    return tiles_of(pixels(spark, sf_dir), grid)
