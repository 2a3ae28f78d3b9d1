"""Raster tiles as rows: (xoff, yoff, w, h, data), data being the pixels row by row, null for no data."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A class raster has one byte or two a pixel, so no table is longer.
MOST_CLASSES = 65536


@dataclass(frozen=True)
class Grid:
    """Pixel (row, col) has its centre at x0 + (col + 0.5) * dx, y0 + (row + 0.5) * dy."""

    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int
    block: int = 256
    #: The height of blocks that are not square, else 0.
    block_h: int = 0

    @property
    def high(self) -> int:
        return self.block_h or self.block

    @property
    def blocks(self) -> int:
        return -(-self.width // self.block) * -(-self.height // self.high)

    @property
    def tolerance(self) -> float:
        """What may be thinned away of polygons before they are burnt: half a pixel."""
        return 0.5 * max(abs(self.dx), abs(self.dy))

    @property
    def pixel_ha(self) -> float:
        return abs(self.dx * self.dy) / 1e4


def tiles_of(pixels: DataFrame, grid: Grid) -> DataFrame:
    """Tiles out of (row, col, value); pixels that are not there hold no data. A group is one tile of bounded size.

    Of several values for one pixel the largest counts. Entries are sorted and the gaps
    between them filled, so the work is linear in a tile's pixels.
    """
    at = lambda c, b: (F.floor(F.col(c) / b) * b).cast("int")
    placed = pixels.withColumn("xoff", at("col", grid.block)).withColumn("yoff", at("row", grid.high))
    placed = placed.withColumn("w", F.least(F.lit(grid.block), grid.width - F.col("xoff"))).withColumn("h", F.least(F.lit(grid.high), grid.height - F.col("yoff")))
    k = ((F.col("row") - F.col("yoff")) * F.col("w") + F.col("col") - F.col("xoff")).cast("int")
    made = placed.groupBy("xoff", "yoff", "w", "h").agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), F.col("value").alias("v")))).alias("e"))
    made = made.withColumn("e", F.filter("e", lambda x, i: F.coalesce(F.get("e", i + 1)["k"] != x["k"], F.lit(True))))
    kind = dict(pixels.dtypes)["value"]
    none = lambda n: F.array_repeat(F.lit(None).cast(kind), n.cast("int"))
    filled = F.flatten(F.transform("e", lambda x, i: F.concat(none(x["k"] - F.when(i > 0, F.get("e", i - 1)["k"]).otherwise(-1) - 1), F.array(x["v"]))))
    return made.select("xoff", "yoff", "w", "h", F.concat(filled, none(F.col("w") * F.col("h") - 1 - F.element_at("e", -1)["k"])).alias("data"))


def spans(features: DataFrame, grid: Grid, carry: list[str]) -> DataFrame:
    """(carry, row, c0, c1): runs of pixels whose centres are inside a polygon, by crossings of each pixel row.

    Each edge gives its crossings with the pixel rows that it spans; sorted by row and
    place, every two of a polygon's crossings bound a run.
    """
    def edges(r: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), (F.size(r) / 2).cast("int") - 2), lambda i: F.slice(r, 2 * i + 1, 4))

    def crossings(s: Column) -> Column:
        y1, y2 = (s[1] - grid.y0) / grid.dy - 0.5, (s[3] - grid.y0) / grid.dy - 0.5
        first = F.greatest(F.ceil(F.least(y1, y2)), F.lit(0).cast("long"))
        last = F.least(F.ceil(F.greatest(y1, y2)) - 1, F.lit(grid.height - 1).cast("long"))
        x = lambda r: (s[0] + (r - y1) / (y2 - y1) * (s[2] - s[0]) - grid.x0) / grid.dx
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda r: F.struct(r.alias("row"), x(r).alias("x")))).otherwise(F.array().cast("array<struct<row:bigint,x:double>>"))

    flat = features.filter(F.size("geom") > 0).select(*carry, F.array_sort(F.flatten(F.transform(F.flatten(F.transform(F.filter("geom", lambda r: F.size(r) >= 4), edges)), crossings))).alias("x"))
    c0 = lambda i: F.greatest(F.ceil(F.get("x", 2 * i)["x"] - 0.5), F.lit(0).cast("long"))
    c1 = lambda i: F.least(F.ceil(F.get("x", 2 * i + 1)["x"] - 0.5) - 1, F.lit(grid.width - 1).cast("long"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("x") / 2).cast("int") - 1), lambda i: F.struct(F.get("x", 2 * i)["row"].alias("row"), c0(i).alias("c0"), c1(i).alias("c1")))
    return flat.filter(F.size("x") >= 2).select(*carry, F.inline(pairs)).filter("c0 <= c1")


def dealt(runs: DataFrame, grid: Grid) -> DataFrame:
    """Runs cut at tile borders: (xoff, yoff, w, h) added, rows and columns counted within the tile."""
    b = grid.block
    runs = runs.withColumn("yoff", (F.floor(F.col("row") / grid.high) * grid.high).cast("int")).withColumn("bx", F.explode(F.sequence(F.floor(F.col("c0") / b), F.floor(F.col("c1") / b))))
    runs = runs.withColumn("xoff", (F.col("bx") * b).cast("int")).drop("bx")
    runs = runs.withColumn("w", F.least(F.lit(b), grid.width - F.col("xoff"))).withColumn("h", F.least(F.lit(grid.high), grid.height - F.col("yoff")))
    a, e = F.greatest("c0", "xoff") - F.col("xoff"), F.least(F.col("c1"), F.col("xoff") + F.col("w") - 1) - F.col("xoff")
    return runs.withColumn("row", (F.col("row") - F.col("yoff")).cast("int")).withColumn("c0", a.cast("int")).withColumn("c1", e.cast("int"))


def burn(features: DataFrame, grid: Grid, value: str, order: str) -> DataFrame:
    """Tiles of doubles, each pixel with the value of the last polygon in ``order`` that covers it.

    Runs of pixels go to their tile, of equal runs only the last one, and are painted
    there in order; so what a tile receives is bounded by its size.
    """
    runs = dealt(spans(features.select("geom", F.col(value).cast("double").alias("value"), F.col(order).alias("order")), grid, ["value", "order"]), grid)
    tile = ["xoff", "yoff", "w", "h"]
    last = runs.groupBy(*tile, "row", "c0", "c1").agg(F.max_by("value", "order").alias("value"), F.max("order").alias("order"))

    def paint(rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[tile].iloc[:1].copy()
        data = np.full((int(out["h"].iloc[0]), int(out["w"].iloc[0])), np.nan)
        for row, c0, c1, value in rows.sort_values("order", kind="stable")[["row", "c0", "c1", "value"]].itertuples(index=False):
            data[row, c0 : c1 + 1] = value
        # A pixel without a value is NaN until it is null: a polygon's own null paints as none.
        out["data"] = pd.Series([data.ravel()], index=out.index, dtype=object)
        return out

    made = last.groupBy(*tile).applyInPandas(paint, "xoff int, yoff int, w int, h int, data array<double>")
    return made.select(*tile, F.transform("data", lambda v: F.when(~F.isnan(v), v)).alias("data"))


def zonal_stats(tiles: DataFrame, zones: DataFrame, grid: Grid, key: str) -> DataFrame:
    """Per zone total_count, valid_count, sum, mean, stdev, area_ha_valid, area_ha_total and proportion_valid_nonzero.

    The runs of a zone in a tile meet that tile once and are summed as slices of its
    data, so no pixel becomes a row. Tiles that are not stored hold no data, but their
    pixels count. Deviations are summed around each part's mean and the parts merged
    around the zone's. Zones without pixels stay: counts and sum 0, else null.
    """
    runs = dealt(spans(zones.select(key, "geom"), grid, [key]), grid)
    runs = runs.groupBy(key, "xoff", "yoff").agg(F.collect_list(F.struct("row", "c0", "c1")).alias("runs"), F.sum(F.col("c1") - F.col("c0") + 1).alias("total"))
    met = runs.join(tiles.select("xoff", "yoff", "w", "data"), ["xoff", "yoff"], "left")
    cut = F.flatten(F.transform("runs", lambda r: F.slice("data", r["row"] * F.col("w") + r["c0"] + 1, r["c1"] - r["c0"] + 1)))
    valid = F.transform(F.filter(cut, lambda v: v.isNotNull() & ~F.isnan(v)), lambda v: v.cast("double"))
    add = lambda f: F.aggregate("vs", F.lit(0.0), lambda s, v: s + f(v))
    held = F.array().cast("array<double>")
    parts = met.select(key, "total", F.when(F.col("data").isNull(), held).otherwise(valid).alias("vs"))
    parts = parts.select(key, "total", "vs", F.size("vs").cast("long").alias("n"), add(lambda v: v).alias("s"), F.size(F.filter("vs", lambda v: v != 0)).cast("long").alias("nonzero"))
    parts = parts.withColumn("m", F.col("s") / F.nullif("n", F.lit(0))).withColumn("m2", add(lambda v: (v - F.col("m")) * (v - F.col("m")))).drop("vs")
    of_zone = W.partitionBy(key)
    parts = parts.withColumn("mean", F.sum("s").over(of_zone) / F.nullif(F.sum("n").over(of_zone), F.lit(0)))
    off = F.col("m") - F.col("mean")
    sums = parts.groupBy(key).agg(
        F.sum("total").alias("total_count"), F.sum("n").alias("valid_count"), F.sum("s").alias("sum"), F.first("mean").alias("mean"),
        F.sum(F.when(F.col("n") > 0, F.col("m2") + F.col("n") * off * off)).alias("squares"), F.sum("nonzero").alias("nonzero"),
    )
    n = F.nullif(F.col("valid_count"), F.lit(0))
    zero = F.lit(0).cast("long")
    return zones.select(key).join(sums, key, "left").select(
        key, F.coalesce("total_count", zero).alias("total_count"), F.coalesce("valid_count", zero).alias("valid_count"), F.coalesce("sum", F.lit(0.0)).alias("sum"),
        "mean", F.sqrt(F.col("squares") / n).alias("stdev"),
        (F.coalesce("valid_count", zero) * grid.pixel_ha).alias("area_ha_valid"), (F.coalesce("total_count", zero) * grid.pixel_ha).alias("area_ha_total"), (F.col("nonzero") / n).alias("proportion_valid_nonzero"),
    )


def read_reclass(spark: SparkSession, path: str) -> dict[int, int]:
    """A reclass table out of a CSV with the columns id and reclass; ids may occur once. A class table is small, so it is read whole."""
    rows = spark.read.csv(path, header=True, inferSchema=True).select("id", "reclass").limit(MOST_CLASSES + 1).collect()
    twice = sorted(k for k, n in Counter(r["id"] for r in rows).items() if n > 1)
    if twice or len(rows) > MOST_CLASSES:
        raise ValueError(f"{path}: repeated ids {twice[:10]}" if twice else f"{path}: more than {MOST_CLASSES} classes")
    table = {r["id"]: r["reclass"] for r in rows}
    check_table(table)
    return table


def check_table(table: dict[int, int]) -> None:
    if not table or set(table.values()) - {0, 1}:
        raise ValueError(f"a reclass table maps to 0 and 1, not {sorted(set(table.values()) - {0, 1})}")


def looked_up(table: dict[int, int], nodata: int):
    codes = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    return lambda v: F.coalesce(F.try_element_at(codes, v.cast("int")), F.lit(nodata)).cast("double")


def reclassify(tiles: DataFrame, tables: dict[str, dict[int, int]], nodata: int = 255) -> DataFrame:
    """Tiles of one mask per table out of one scan: ``mask`` and data of 0, 1 or, for other classes and no data, ``nodata``."""
    masks = []
    for name, table in sorted(tables.items()):
        check_table(table)
        masks.append(F.struct(F.lit(name).alias("mask"), F.transform("data", looked_up(table, nodata)).alias("data")))
    return tiles.select("xoff", "yoff", "w", "h", F.inline(F.array(*masks)))


def masked(tiles: DataFrame, mask: DataFrame) -> DataFrame:
    """Pixels stay where the mask is 1."""
    m = mask.select("xoff", "yoff", F.col("data").alias("m"))
    return tiles.join(m, ["xoff", "yoff"], "left").select("xoff", "yoff", "w", "h", F.transform("data", lambda v, i: F.when(F.get("m", i) == 1, v)).alias("data"))


def weighted_total(tiles: DataFrame, grid: Grid) -> DataFrame:
    """(total): the sum of valid, finite pixels times the pixel's hectares."""
    part = F.aggregate(F.filter("data", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(0.0), lambda s, v: s + v)
    return tiles.agg((F.coalesce(F.sum(part), F.lit(0.0)) * grid.pixel_ha).alias("total"))


def burnt_totals(tiles: DataFrame, mask: DataFrame, grid: Grid) -> DataFrame:
    """(burnt, total, masked_total) in one pass: pixels with data, their weighted total, and that of those under a mask's ones."""
    met = tiles.join(mask.select("xoff", "yoff", F.col("data").alias("m")), ["xoff", "yoff"], "left")
    finite = lambda v: v.isNotNull() & (F.abs(v) < float("inf"))
    add = lambda c: F.aggregate(F.filter(c, finite), F.lit(0.0), lambda s, v: s + v)
    under = F.transform("data", lambda v, i: F.when(F.get("m", i) == 1, v))
    total = lambda c: F.coalesce(F.sum(add(c)), F.lit(0.0)) * grid.pixel_ha
    return met.agg(F.sum(F.size(F.filter("data", lambda v: v.isNotNull()))).cast("long").alias("burnt"), total(F.col("data")).alias("total"), total(under).alias("masked_total"))


def reconciled(raster_total: DataFrame, table_total: DataFrame) -> DataFrame:
    """(raster_total, table_total, difference, percent): two one-row totals side by side; percent is null for a table total of 0."""
    both = raster_total.select(F.col("total").alias("raster_total")).crossJoin(F.broadcast(table_total.select(F.col("total").alias("table_total"))))
    off = F.col("raster_total") - F.col("table_total")
    return both.select("raster_total", "table_total", off.alias("difference"), (off / F.nullif(F.col("table_total"), F.lit(0.0)) * 100).alias("percent"))
