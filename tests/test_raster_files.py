"""Raster files: what is written comes back, whatever the blocks, codecs and sample types; files of others; what is refused."""

import os
import struct
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.kernel import tiff
from quadrille.operators import rasters as R
from quadrille.sources.rasters import raster_grid, raster_info, read_raster, retiled, write_masks, write_raster

GRID = R.Grid(100.0, 900.0, 10.0, -10.0, 70, 45, 32)


def pixels_of(rows, width, height):
    out = {}
    for r in rows:
        assert len(r["data"]) == r["w"] * r["h"]
        for i, v in enumerate(r["data"]):
            out[r["yoff"] + i // r["w"], r["xoff"] + i % r["w"]] = v
    assert len(out) == width * height
    return out


def sample(spark, grid, kind="double"):
    n = F.col("id")
    rows = spark.range(grid.width * grid.height).filter("id % 3 != 0 OR id > 2000").select(F.floor(n / grid.width).cast("int").alias("row"), (n % grid.width).cast("int").alias("col"), F.when(n % 7 > 0, (n * 37 % 251).cast(kind)).alias("value"))
    want = {(i // grid.width, i % grid.width): i * 37 % 251 if (i % 3 or i > 2000) and i % 7 else None for i in range(grid.width * grid.height)}
    return R.tiles_of(rows, grid), want


@pytest.mark.parametrize(
    ("dtype", "compression", "predictor", "block", "block_h"),
    [("uint8", "zstd", 1, 32, 0), ("float32", "lzw", 1, 16, 48), ("float64", "deflate", 3, 64, 16), ("int16", "lzw", 2, 80, 0), ("int32", "none", 1, 16, 0), ("uint16", "deflate", 2, 32, 0), ("float32", "zstd", 3, 32, 0)],
)
def test_round_trip(spark, tmp_path, dtype, compression, predictor, block, block_h):
    grid = replace(GRID, block=block, block_h=block_h)
    tiles, want = sample(spark, grid)
    path = write_raster(tiles, grid, str(tmp_path / "a" / "r.tif"), dtype, 255 if dtype[0] == "u" else -9999, 5070, compression, predictor=predictor)
    assert raster_grid(path) == replace(grid, block_h=block_h or block)
    got = read_raster(spark, path)
    assert got.rdd.getNumPartitions() == -(-grid.blocks // 64) and pixels_of(got.collect(), 70, 45) == want
    info = raster_info(spark, path).first()
    assert (info["dtype"], info["blocks"], info["srid"], info["bands"], info["nodata"]) == (dtype, grid.blocks, 5070, 1, 255.0 if dtype[0] == "u" else -9999.0)
    square, new = retiled(got, raster_grid(path), 16)
    assert pixels_of(square.collect(), 70, 45) == want and new.blocks == square.count()
    assert os.listdir(tmp_path / "a") == ["r.tif"]


def test_one_tile_south_up_and_nan(spark, tmp_path):
    grid = R.Grid(0.5, -3.25, 0.25, 0.5, 5, 4, 16)
    tiles, want = sample(spark, grid)
    path = write_raster(tiles, grid, str(tmp_path / "r.tif"), "float64", float("nan"), 4326)
    assert raster_grid(path) == replace(grid, block_h=16) and raster_info(spark, path).first()["srid"] == 4326
    assert pixels_of(read_raster(spark, path).collect(), 5, 4) == want and R.Grid(0, 0, 3, -4, 1, 1).tolerance == 2


def test_absent_tiles_hold_no_data_and_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "r.tif")
    write_raster(sample(spark, GRID)[0].limit(0), GRID, path, "uint8", 7)
    assert set(pixels_of(read_raster(spark, path).collect(), 70, 45).values()) == {None}
    with pytest.raises(FileExistsError):
        write_raster(sample(spark, GRID)[0], GRID, path, "uint8", 7)
    before = open(path, "rb").read()
    for tiles, dtype, nodata, message in ((sample(spark, GRID)[0], "uint8", None, "no value for"), (sample(spark, GRID)[0].withColumn("data", F.transform("data", lambda v: v + 300)), "uint8", 0, "is no uint8"), (sample(spark, GRID)[0].withColumn("data", F.slice("data", 1, 3)), "uint8", 0, "3 values")):
        with pytest.raises(Exception, match=message):
            write_raster(tiles, GRID, path, dtype, nodata, overwrite=True)
    double = sample(spark, GRID)[0]
    with pytest.raises(ValueError, match="two tiles"):
        write_raster(double.union(double), GRID, path, "uint8", 255, overwrite=True)
    assert open(path, "rb").read() == before and os.listdir(tmp_path) == ["r.tif"]
    # In place: what is read is what is replaced.
    write_raster(sample(spark, GRID)[0], GRID, path, "int16", -1, overwrite=True)
    write_raster(read_raster(spark, path).withColumn("data", F.transform("data", lambda v: F.when(v > 100, v))), GRID, path, "int16", -1, overwrite=True)
    assert {v for v in pixels_of(read_raster(spark, path).collect(), 70, 45).values() if v is not None} == {v for v in sample(spark, GRID)[1].values() if v is not None and v > 100}


def test_strips_of_another_writer(spark, tmp_path):
    """Big-endian strips of three interleaved bands with differences, the last strip shorter; and bands in planes."""
    h, w, strip = 10, 6, 4
    image = np.arange(h * w * 3, dtype=np.uint16).reshape(h, w, 3) * 911
    for planar in (1, 2):
        blocks = []
        for band in range(1 if planar == 1 else 3):
            for y in range(0, h, strip):
                part = image[y : y + strip] if planar == 1 else image[y : y + strip, :, band : band + 1]
                blocks.append(tiff.deflated(np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1])).astype(">u2").tobytes(), 8, 6))
        n = len(blocks)
        tags = [(256, 3, 1, w << 16), (257, 3, 1, h << 16), (258, 3, 3, 300), (259, 3, 1, 8 << 16), (262, 3, 1, 1 << 16), (273, 4, n, 400), (277, 3, 1, 3 << 16), (278, 3, 1, strip << 16), (279, 4, n, 500), (284, 3, 1, planar << 16), (317, 3, 1, 2 << 16)]
        data = bytearray(600)
        data[:8] = struct.pack(">2sHI", b"MM", 42, 8)
        data[8 : 8 + 2 + 12 * len(tags)] = struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", *t) for t in tags)
        data[300:306] = struct.pack(">3H", 16, 16, 16)
        at = 600
        for k, b in enumerate(blocks):
            struct.pack_into(">I", data, 400 + 4 * k, at)
            struct.pack_into(">I", data, 500 + 4 * k, len(b))
            at += len(b)
        path = str(tmp_path / f"s{planar}.tif")
        with open(path, "wb") as f:
            f.write(bytes(data) + b"".join(blocks))
        for band in (1, 2, 3):
            got = pixels_of(read_raster(spark, path, band).collect(), w, h)
            assert got == {(y, x): int(image[y, x, band - 1]) for y in range(h) for x in range(w)}
    with pytest.raises(Exception, match="no band 4"):
        read_raster(spark, path, 4).collect()
    with pytest.raises(ValueError, match="3 bands"):
        write_masks(spark, path, {"a": {1: 1}}, str(tmp_path))
    (tmp_path / "no.tif").write_bytes(b"GIF89a..........")
    with pytest.raises(ValueError, match="not a tagged image"):
        raster_grid(str(tmp_path / "no.tif"))


def test_codec_of_repeated_strings():
    rng = np.random.default_rng(2)
    for data in (b"", b"a", b"aaaaaaa", bytes(rng.integers(0, 4, 60_000, dtype=np.uint8)), bytes(rng.integers(0, 256, 60_000, dtype=np.uint8)), bytes(65536)):
        assert tiff.unlzw(tiff.lzw(data)) == data


def test_large_files_get_wide_offsets():
    raster = tiff.Raster(10_000_000, 1_000_000, 1, "u1", 256, 256, 8, 1, 1, "<", 255.0, (0.0, 0.0, 30.0, -30.0), 5070, (0, 0), (0, 0))
    small, large = tiff.directory(replace(raster, width=1000, height=1000), 1000), tiff.directory(replace(raster, width=1000, height=1000), 5 << 30)
    assert small[3] == 4 and small[0][2] == 42 and large[3] == 8 and large[0][2] == 43
