"""Raster files: tiles and strips of GeoTIFF as rows, and rows of tiles as GeoTIFF.

``spark.read.format("geotiff")`` after ``register(spark)``. Files have to be on a file
system that the driver and all executors mount.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from quadrille.kernel import tiff
from quadrille.operators.rasters import Grid, check_table, reclassify
from quadrille.sources.staging import staged, unstage

TILES_A_TASK = 64
#: Spark's types of samples; unsigned ones fit the next larger.
TYPES = {"u1": IntegerType(), "i1": IntegerType(), "u2": IntegerType(), "i2": IntegerType(), "i4": IntegerType(), "u4": LongType(), "i8": LongType(), "f4": FloatType(), "f8": DoubleType()}
#: Names of sample types for writing.
KINDS = {"uint8": "u1", "int8": "i1", "uint16": "u2", "int16": "i2", "uint32": "u4", "int32": "i4", "int64": "i8", "float32": "f4", "float64": "f8"}
#: Tiles whose sizes are summed up in one piece, when places in a file are dealt out.
SUMMED = 4096


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


@dataclass
class Blocks(InputPartition):
    first: int
    last: int


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, band: int, tiles: int):
        self.path, self.schema, self.band, self.tiles = local(path), schema, band, tiles
        self.raster = tiff.read_directory(self.path)
        if not 1 <= band <= self.raster.bands:
            raise ValueError(f"{path}: no band {band} among {self.raster.bands}")

    def partitions(self) -> list[InputPartition]:
        n = self.raster.blocks
        return [Blocks(a, min(a + self.tiles, n)) for a in range(0, n, self.tiles)]

    def read(self, part: Blocks) -> Iterator[pa.RecordBatch]:
        """One batch a block. What equals the file's value for no data is null; a block that is not stored holds no data."""
        r, wanted = self.raster, to_arrow_schema(self.schema)
        before = r.blocks * (self.band - 1) if r.planar == 2 else 0
        with open(self.path, "rb") as f:
            offsets = tiff.entries(f, r.offsets, r.order, before + part.first, part.last - part.first).tolist()
            sizes = tiff.entries(f, r.sizes, r.order, before + part.first, part.last - part.first).tolist()
            for k, at, size in zip(range(part.first, part.last), offsets, sizes, strict=True):
                x, y = k % r.across * r.block_w, k // r.across * r.block_h
                w, h = min(r.block_w, r.width - x), min(r.block_h, r.height - y)
                f.seek(at)
                # Strips end with the raster, tiles go on past its edges.
                data = tiff.block_of(f.read(size), r, r.block_h if r.tiled else h, self.band - 1)[:h, :w].ravel() if size else None
                none = np.ones(w * h, bool) if data is None else np.zeros(w * h, bool) if r.nodata is None else np.isnan(data) if r.nodata != r.nodata else data == np.dtype(data.dtype).type(r.nodata)
                values = pa.array(np.zeros(w * h, r.dtype) if data is None else data, mask=none).cast(wanted.field("data").type.value_type)
                columns = {c: pa.array([v], pa.int32()) for c, v in (("xoff", x), ("yoff", y), ("w", w), ("h", h))}
                columns["data"] = pa.ListArray.from_arrays(pa.array([0, w * h], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([columns[c].cast(wanted.field(c).type) for c in wanted.names], schema=wanted)


class GeoTiff(DataSource):
    """Options: ``band`` (from 1) and ``tilesPerTask``. Rows are (xoff, yoff, w, h, data), a row a stored tile or strip."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> StructType:
        kind = TYPES[tiff.read_directory(local(self.options["path"])).dtype]
        return StructType([*[StructField(c, IntegerType()) for c in ("xoff", "yoff", "w", "h")], StructField("data", ArrayType(kind))])

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.options["path"], schema, int(self.options.get("band", 1)), int(self.options.get("tilesPerTask", TILES_A_TASK)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoTiff)


def read_raster(spark: SparkSession, path: str, band: int = 1) -> DataFrame:
    register(spark)
    return spark.read.format("geotiff").option("band", band).load(path)


def raster_grid(path: str) -> Grid:
    """The grid of a file: place, pixel size, extent and blocks."""
    r = tiff.read_directory(local(path))
    return Grid(*r.transform, r.width, r.height, r.block_w, r.block_h)


def raster_info(spark: SparkSession, path: str) -> DataFrame:
    """One row: size, bands, sample type, blocks, place and pixel size, value for no data and reference system."""
    r = tiff.read_directory(local(path))
    names = {v: k for k, v in KINDS.items()}
    row = (path, r.width, r.height, r.bands, names.get(r.dtype, r.dtype), r.block_w, r.block_h, r.blocks, *r.transform, r.nodata, r.srid)
    return spark.createDataFrame([row], "path string, width int, height int, bands int, dtype string, block_w int, block_h int, blocks long, x0 double, y0 double, dx double, dy double, nodata double, srid int")


def encode_by(raster: tiff.Raster, level: int):
    """Tasks: the stored bytes of each tile; tiles at the edges are filled up with no data."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind = np.dtype(raster.dtype)
        for part in parts:
            out = []
            for w, h, data in zip(part["w"].tolist(), part["h"].tolist(), part["data"], strict=True):
                block = np.full((raster.block_h, raster.block_w), 0 if raster.nodata is None else raster.nodata, kind)
                if data is not None:
                    if len(data) != w * h:
                        raise ValueError(f"a tile of {w} x {h} pixels has {len(data)} values")
                    values = np.asarray(data, object if kind.kind in "ui" and np.asarray(data).dtype == object else None)
                    none = pd.isna(values)
                    if none.any() and raster.nodata is None:
                        raise ValueError("there are pixels without data, but no value for them")
                    filled = np.where(none, raster.nodata, values).astype(np.float64 if kind.kind == "f" else np.int64) if none.any() else values
                    if kind.kind in "ui":
                        whole = np.asarray(filled).astype(np.int64)
                        limits = np.iinfo(kind)
                        if (whole != np.asarray(filled, float)).any() or whole.min() < limits.min or whole.max() > limits.max:
                            raise ValueError(f"a value is no {kind.name}")
                        filled = whole
                    block[:h, :w] = np.asarray(filled).astype(kind).reshape(h, w)
                elif raster.nodata is None:
                    raise ValueError("there are tiles without data, but no value for their pixels")
                out.append(tiff.encoded(block, raster.compression, raster.predictor, level))
            yield pd.DataFrame({"k": part["k"], "size": [len(b) for b in out], "bytes": out})

    return run


def place_by(path: str, offsets_at: int, sizes_at: int, entry: int):
    """Tasks: every tile, and its entries in the directory, at their places in the file; writing a tile again changes nothing."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = "<Q" if entry == 8 else "<I"
        n, f = 0, os.open(path, os.O_WRONLY)
        try:
            for part in parts:
                for k, at, data in zip(part["k"].tolist(), part["at"].tolist(), part["bytes"], strict=True):
                    os.pwrite(f, data, at)
                    os.pwrite(f, struct.pack(code, at), offsets_at + k * entry)
                    os.pwrite(f, struct.pack(code, len(data)), sizes_at + k * entry)
                    n += 1
            os.fsync(f)
        finally:
            os.close(f)
        yield pd.DataFrame({"n": [n]})

    return run


def write_raster(tiles: DataFrame, grid: Grid, path: str, dtype: str = "float32", nodata: float | None = None, srid: int | None = None, compression: str = "deflate", level: int = 6, predictor: int = 1, overwrite: bool = False) -> str:
    """One GeoTIFF of one band out of tiles (xoff, yoff, w, h, data) of ``grid``; null is no data, and so are tiles that are not there.

    Tasks encode the tiles and stage their bytes. Places in the file follow from sums of
    sizes (the driver sees one for SUMMED tiles), and tasks write the tiles and their
    directory entries there, so no pixel passes through the driver and a task that runs
    again writes the same. The file gets its name when all is in place; one of that name
    is refused, or replaced then with ``overwrite``, and may be what the tiles are read from.
    """
    spark, path = tiles.sparkSession, local(path)
    if os.path.exists(path) and not overwrite:
        raise FileExistsError(f"{path} is there already; overwrite it or name another file")
    block_h = grid.block_h or grid.block
    if grid.block % 16 or block_h % 16:
        raise ValueError("tiles of a file are multiples of 16 pixels wide and high")
    raster = tiff.Raster(grid.width, grid.height, 1, KINDS[dtype], grid.block, block_h, tiff.CODECS[compression], predictor, 1, "<", None if nodata is None else float(nodata), (grid.x0, grid.y0, grid.dx, grid.dy), srid, (0, 0), (0, 0))
    rows = spark.range(raster.blocks).select(F.col("id").alias("k"), (F.col("id") % raster.across * grid.block).cast("int").alias("xoff"), (F.floor(F.col("id") / raster.across) * block_h).cast("int").alias("yoff"))
    rows = rows.join(tiles.select("xoff", "yoff", "data"), ["xoff", "yoff"], "left")
    rows = rows.select("k", F.least(F.lit(grid.block), grid.width - F.col("xoff")).alias("w"), F.least(F.lit(block_h), grid.height - F.col("yoff")).alias("h"), "data")
    stored = staged(rows.mapInPandas(encode_by(raster, level), "k long, size long, bytes binary"), "tiles")
    piece = F.floor(F.col("k") / SUMMED)
    sums = {r["p"]: (r["s"], r["n"]) for r in stored.groupBy(piece.alias("p")).agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()}
    if sum(n for _, n in sums.values()) != raster.blocks:
        raise ValueError("two tiles have the same place")
    head, offsets_at, sizes_at, entry = tiff.directory(raster, sum(s for s, _ in sums.values()))
    at, starts = len(head), []
    for p in sorted(sums):
        starts.append((p, at))
        at += sums[p][0]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    draft = f"{path}.draft-{uuid.uuid4().hex}"
    try:
        with open(draft, "wb") as f:
            f.write(head)
            f.truncate(at)
        before = F.sum("size").over(W.partitionBy("p").orderBy("k")) - F.col("size")
        places = stored.select("k", "size", piece.alias("p")).withColumn("before", before).join(F.broadcast(spark.createDataFrame(starts, "p long, start long")), "p")
        put = stored.select("k", "bytes").join(places.select("k", (F.col("start") + F.col("before")).alias("at")), "k")
        put.mapInPandas(place_by(draft, offsets_at, sizes_at, entry), "n long").agg(F.sum("n")).collect()
        os.replace(draft, path)
    except BaseException:
        with suppress(FileNotFoundError):
            os.remove(draft)
        raise
    unstage(stored)
    return path


def write_masks(spark: SparkSession, path: str, tables: dict[str, dict[int, int]], folder: str, nodata: int = 255, overwrite: bool = False) -> dict[str, str]:
    """A mask file of bytes for each reclass table, out of one scan of a class raster of one band: 0, 1, or ``nodata``; the paths by name."""
    info = tiff.read_directory(local(path))
    if info.bands != 1:
        raise ValueError(f"{path}: {info.bands} bands, not one")
    for table in tables.values():
        check_table(table)
    grid = raster_grid(path)
    if info.block_w % 16 or info.block_h % 16:
        raise ValueError(f"{path}: blocks of {info.block_w} x {info.block_h} pixels; retile it first")
    masks = staged(reclassify(read_raster(spark, path), tables, nodata), "masks")
    out = {}
    for name in sorted(tables):
        tiles = masks.filter(F.col("mask") == name)
        out[name] = write_raster(tiles, grid, f"{folder}/{name}.tif", "uint8", nodata, info.srid, "zstd", 9, overwrite=overwrite)
    unstage(masks)
    return out


def retiled(tiles: DataFrame, grid: Grid, block: int) -> tuple[DataFrame, Grid]:
    """Tiles or strips of ``grid`` as square tiles of ``block`` pixels, and their grid; pixels of a row travel in one piece."""
    new = replace(grid, block=block, block_h=0)
    at = F.sequence(F.lit(0), F.col("h") - 1)
    rows = tiles.select("xoff", "w", "data", "yoff", F.explode(at).alias("i"))
    rows = rows.select((F.col("yoff") + F.col("i")).alias("row"), "xoff", "w", F.slice("data", F.col("i") * F.col("w") + 1, F.col("w")).alias("v"))
    rows = rows.withColumn("bx", F.explode(F.sequence(F.floor(F.col("xoff") / block), F.floor((F.col("xoff") + F.col("w") - 1) / block))))
    a, e = F.greatest("xoff", F.col("bx") * block), F.least(F.col("xoff") + F.col("w"), (F.col("bx") + 1) * block)
    rows = rows.select("row", (F.col("bx") * block).cast("int").alias("x"), a.alias("at"), F.slice("v", (a - F.col("xoff") + 1).cast("int"), (e - a).cast("int")).alias("v"))
    place = (F.floor(F.col("row") / block) * block).cast("int")
    made = rows.groupBy(F.col("x").alias("xoff"), place.alias("yoff")).agg(F.array_sort(F.collect_list(F.struct("row", "at", "v"))).alias("e"))
    w, h = F.least(F.lit(block), grid.width - F.col("xoff")), F.least(F.lit(block), grid.height - F.col("yoff"))
    return made.select("xoff", "yoff", w.alias("w"), h.alias("h"), F.flatten(F.transform("e", lambda x: x["v"])).alias("data")), new
