"""Layers are written and read in batches, by tasks that go with a file's bytes; every geometry is as when it is taken alone."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.kernel import wkb
from quadrille.plans import zonal
from quadrille.plans.products import land_layers
from quadrille.sources import geopackage

BOX = [0.0, 0.0, 9.0, 0.0, 9.0, 9.0, 0.0, 9.0, 0.0, 0.0]
HOLE = [1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0, 1.0, 1.0, 1.0]
TRIANGLE = [5.0, 5.0, 7.0, 5.0, 5.0, 8.0, 5.0, 5.0]
ROWS = [[BOX], [TRIANGLE], None, [], [BOX, HOLE], [BOX[::-1]], [[v + 20 for v in BOX], TRIANGLE], [[0.0, 0.0, 1.0, 1.0, 3.0, 3.0, 0.0, 0.0]], [[0.0, 0.0, 2.0, 2.0, 2.0, 0.0, 0.0, 2.0, 0.0, 0.0]], [[v * 1e-9 + 1e6 for v in BOX]]]


def rings(row):
    return [np.array(r).reshape(-1, 2) for r in row]


def test_batches_are_as_single_geometries():
    blobs = [None if row is None else wkb.multipolygon(rings(row)) for row in ROWS]
    got, boxes = wkb.encoded([None if row is None else [np.array(r) for r in row] for row in ROWS])
    assert got == blobs
    assert boxes[0].tolist() == [0.0, 9.0, 0.0, 9.0] and boxes[6].tolist() == [5.0, 29.0, 5.0, 29.0] and np.isnan(boxes[2:4]).all()
    points = np.array(BOX, ">f8").tobytes()
    other = [struct.pack(">BII", 0, 3, 1) + struct.pack(">I", 5) + points, wkb.ONE_RING + struct.pack("<I", 5) + np.array(BOX[::-1]).tobytes(), wkb.ONE_RING + struct.pack("<I", 4) + np.zeros(8).tobytes()]
    blobs += other
    want = [None if b is None else [r.ravel().tolist() for r in wkb.polygon_rings(b)] for b in blobs]
    assert [None if g is None else [r.tolist() for r in g] for g in wkb.decoded(blobs)] == want
    assert want[-1] == [] and want[-3] == [BOX]


def test_rings_are_written_and_read_as_their_binary_is(spark, tmp_path):
    geopackage.register(spark)
    df = spark.createDataFrame([(k if k % 2 else None, row) for k, row in enumerate(ROWS, 1)], "fid long, geom array<array<double>>").withColumn("t", F.lit("2026-03-29 12:30:00").cast("timestamp")).coalesce(1)
    df.write.format("geopackage").mode("append").save(f"{tmp_path}/rings")
    df.withColumn("geom", G.to_wkb("geom")).write.format("geopackage").mode("append").save(f"{tmp_path}/binary")
    read = lambda name, how: spark.read.format("geopackage").option("geometry", how).load(f"{tmp_path}/{name}")
    want = list(map(tuple, read("binary", "wkb").select("fid", G.from_wkb("geom"), "t").orderBy("fid").collect()))
    assert len(want) == len(ROWS) and want[0] == (1, [BOX], "2026-03-29 12:30:00")
    for name, how in (("rings", "wkb"), ("rings", "rings"), ("binary", "rings")):
        df = read(name, how)
        assert list(map(tuple, df.select("fid", G.from_wkb("geom") if how == "wkb" else "geom", "t").orderBy("fid").collect())) == want


@pytest.mark.parametrize("far", [1_000_000_000, 40_000])
def test_ids_far_apart_are_no_tasks(spark, tmp_path, far):
    geopackage.register(spark)
    spark.createDataFrame([(1, [BOX]), (far, [BOX])], "fid long, geom array<array<double>>").coalesce(1).write.format("geopackage").mode("append").save(f"{tmp_path}/far")
    read = spark.read.format("geopackage").option("rowsPerTask", 10_000).load(f"{tmp_path}/far")
    assert read.rdd.getNumPartitions() == 1 and read.count() == 2


def test_rows_without_a_layer_are_not_lost(spark, tmp_path):
    geopackage.register(spark)
    spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "n int, kind string").write.format("geopackage").mode("append").option("layerColumn", "kind").save(f"{tmp_path}/l")
    assert {k: spark.read.format("geopackage").load(f"{tmp_path}/l/{k}").count() for k in ("a", "None")} == {"a": 2, "None": 1}


def test_zone_layers_are_decoded_by_the_process_that_reads_them(spark, tmp_path):
    geopackage.register(spark)
    spark.createDataFrame([("a", [BOX]), ("b", [BOX, HOLE])], "k string, geom array<array<double>>").coalesce(1).write.format("geopackage").mode("append").save(f"{tmp_path}/z")
    rows, system = zonal.zone_rows(spark, zonal.Zones(f"{tmp_path}/z", "layer", "k"))
    assert "EvalPython" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, rows.collect())) == [("a", [BOX]), ("b", [BOX, HOLE])] and system.metric()


def test_land_layers_are_written_without_a_pass_for_their_binary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(G, "to_wkb", None)
    names = ["Mang_Type", "Own_Type", "Mang_Name", "Own_Name", "Des_Tp", "Pub_Access"]
    land = spark.createDataFrame([(1, [BOX]), (2, [TRIANGLE])], "fid long, geom array<array<double>>").select("fid", "geom", *[F.lit("FED" if c == "Mang_Type" else None).cast("string").alias(c) for c in names])
    edge = spark.createDataFrame([([[v * 9 - 9 for v in BOX]],)], "geom array<array<double>>")
    assert land_layers(land, edge, f"{tmp_path}/out", tolerance=0.1, cell=50.0) == {"ok": 2, "all": 2, "public": 2}
    got = spark.read.format("geopackage").option("geometry", "rings").load(f"{tmp_path}/out/layers/public")
    assert sorted((r[0], r[1]) for r in got.select("source_fid", G.area(F.col("geom"))).collect()) == [(1, 81.0), (2, 3.0)]
