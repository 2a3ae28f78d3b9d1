"""What is refused, and with which message; and cases that the queries don't hold."""

import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.kernel import overlay as K
from quadrille.operators import attributes as T
from quadrille.operators import rasters as R
from quadrille.operators.spatial import boundary_union, clip, dissolve, spatial_join
from quadrille.plans import values as V
from quadrille.plans.combine import Group, combine_results

RING = "geom array<array<double>>"


def box(x1, y1, x2, y2):
    return [[float(v) for v in (x1, y1, x2, y1, x2, y2, x1, y2, x1, y1)]]


def test_combine_refuses(spark):
    t = lambda rows, c: spark.createDataFrame(rows, f"k string, {c}")
    a = t([("1", 1.0), ("2", None)], "m double")
    with pytest.raises(ValueError, match="repeated keys"):
        T.combine([("a", a), ("b", t([("1", 1.0), ("1", 1.0)], "n double"))], "k")
    with pytest.raises(ValueError, match="keys without a partner in b"):
        T.combine([("a", a), ("b", t([("1", 1.0)], "n double"))], "k")
    with pytest.raises(ValueError, match="keys without a partner in a"):
        T.combine([("a", a), ("b", t([("1", 1.0), ("2", 1.0), ("3", 1.0)], "n double"))], "k")
    with pytest.raises(ValueError, match="columns that differ"):
        T.combine([("a", a), ("b", t([("1", 2.0), ("2", None)], "m double"))], "k")
    same = T.combine([("a", a), ("b", t([("1", 1.0), ("2", float("nan"))], "m double"))], "k")
    assert sorted(map(tuple, same.collect())) == [("1", 1.0), ("2", None)]
    with pytest.raises(ValueError, match="class forests"):
        T.class_areas(a.withColumn("area_ha_valid_reclassified_NLCD2023_forests_x", F.lit(1)), ["forests"])
    with pytest.raises(ValueError, match="missing fields: q, z"):
        T.require(a, ["z", "k", "q"])


def test_combine_driver_refuses(spark, tmp_path):
    groups = [Group("counties", "out", ("a", "b"))]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "other.csv").write_text("GEOID,x\n1,2\n")
    with pytest.raises(RuntimeError, match="no complete group"):
        combine_results(spark, str(tmp_path / "r"), str(tmp_path / "o"), groups)
    (tmp_path / "r" / "a_20260101_000000.csv").write_text("GEOID,x\n001,2\n")
    with pytest.raises(FileNotFoundError, match="missing .csv results of out: b"):
        combine_results(spark, str(tmp_path / "r"), str(tmp_path / "o"), groups)
    (tmp_path / "r" / "b.csv").write_text("GEOID,y\n001,3\n")
    (path,) = combine_results(spark, str(tmp_path / "r"), str(tmp_path / "o"), groups, stamp="s")
    assert path.endswith("out_s.csv") and spark.read.csv(path, header=True).collect() == [("001", "2", "3")]


def test_values(spark):
    table = spark.createDataFrame([("01", "2.5"), ("2", "x"), (None, "1"), ("3", "4")], "k string, v string")
    values = V.value_table(table, "k", ["v"])
    assert sorted(map(tuple, values.collect())) == [(1, 2.5), (3, 4.0)]
    got = V.valued(spark.createDataFrame([("001", 9.0, 1), ("7", 9.0, 2)], "k string, v double, fid int"), values, "k").collect()
    assert [(r["k"], r["v"], r["fid"]) for r in got] == [(1, 2.5, 1)]
    with pytest.raises(ValueError, match="repeated keys"):
        V.value_table(table.union(table), "k", ["v"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        V.valued(spark.createDataFrame([("a", 1)], "k string, fid int"), values, "k").collect()


def test_systems(spark):
    rows = spark.createDataFrame([(box(0, 0, 1, 1),)], RING)
    with pytest.raises(Exception, match="no area in the reference system 3857"):
        rows.select(G.area_ha(F.col("geom"), F.lit(3857))).collect()
    with pytest.raises(ValueError, match="no way"):
        G.reprojected(F.col("geom"), 3857, 5070)
    with pytest.raises(ValueError, match="no reference system"):
        G.processing_system(None)
    assert G.processing_system(32633, 1.0) == 32633 and G.processing_system(2263, 0.3048) == G.processing_system(4326) == 5070


def test_rasters(spark, tmp_path):
    grid = R.Grid(0.0, 0.0, 1.0, 1.0, 8, 8, 4)
    pixels = spark.createDataFrame([(0, 0, 1e9), (0, 1, 1e9 + 1), (0, 1, 5.0)], "row int, col int, value double")
    zones = spark.createDataFrame([("z", box(0, 0, 8, 8)), ("out", box(20, 20, 21, 21))], f"k string, {RING}")
    got = {r["k"]: r for r in R.zonal_stats(R.tiles_of(pixels, grid), zones, grid, "k").collect()}
    assert (got["z"]["total_count"], got["z"]["valid_count"]) == (64, 2) and abs(got["z"]["stdev"] - 0.5) < 1e-9
    assert (got["out"]["total_count"], got["out"]["sum"], got["out"]["stdev"], got["out"]["mean"]) == (0, 0.0, None, None)
    burnt = R.burn(spark.createDataFrame([(1, 5, box(0, 0, 6, 6)), (2, 7, box(4, 4, 8, 8))], f"fid int, v int, {RING}"), grid, "v", "fid")
    assert sorted((r["xoff"], r["yoff"], r["data"].count(5.0), r["data"].count(7.0)) for r in burnt.collect()) == [(0, 0, 16, 0), (0, 4, 8, 0), (4, 0, 8, 0), (4, 4, 0, 16)]
    for text, message in (("id,reclass\n1,1\n1,0\n", "repeated ids"), ("id,reclass\n1,2\n", "0 and 1"), ("id,reclass\n", "0 and 1")):
        (tmp_path / "t.csv").write_text(text)
        with pytest.raises(ValueError, match=message):
            R.read_reclass(spark, str(tmp_path / "t.csv"))


def test_seamless_dissolve(spark):
    zones = spark.createDataFrame([("a", "A", box(0, 0, 100, 100)), ("b", "B", box(500, 0, 501, 1))], f"k string, name string, {RING}")
    parts = spark.createDataFrame([(i, box(i * 3, 10, i * 3 + 5, 60)) for i in range(40)], f"fid int, {RING}")
    (got,) = dissolve(zones, parts, "k", 10.0, carry=("name",)).collect()
    assert (got["k"], got["name"], got["first_fid"], len(got["geom"]), len(got["geom"][0])) == ("a", "A", 0, 1, 10)
    union = boundary_union(parts.select("geom"), 10.0).first()["geom"]
    assert len(union) == 1 and len(union[0]) == 10
    with pytest.raises(ValueError, match="no polygon"):
        boundary_union(parts.select("geom").limit(0), 10.0)


def test_large_geometries_meet_small_ones_once(spark):
    rows = [(0, box(0, 0, 5000, 5000))] + [(i, box(i * 10, i * 10, i * 10 + 3, i * 10 + 3)) for i in range(1, 60)]
    df = spark.createDataFrame(rows, f"fid int, {RING}")
    pairs = [(r["l"]["fid"], r["r"]["fid"]) for r in spatial_join(df, df, 5.0).select("l", "r").collect()]
    assert len(pairs) == len(set(pairs)) == 60 + 2 * 59


def test_failure_rows(spark):
    rows = [(1, [[]]), (2, [[0.0, 0.0, 1.0]]), (3, box(0, 0, 1, 1)), (4, [[0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 0.0, 0.0]]), (5, [[0.0, 0.0, float("nan"), 0.0, 1.0, 1.0, 0.0, 0.0]])]
    out = clip(spark.createDataFrame(rows, f"fid int, {RING}"), spark.createDataFrame([(box(0, 0, 9, 9),)], RING), 0.01, 5.0).collect()
    assert {r["fid"]: r["status"] for r in out} == {1: "error", 2: "error", 3: "ok", 4: "error", 5: "error"} and all((r["reason"] is None) == (r["status"] == "ok") for r in out)


def test_repair():
    import numpy as np

    ring = lambda g: [np.array(g[0]).reshape(-1, 2)]
    nested = ring(box(0, 0, 4, 4)) + ring(box(1, 1, 2, 2))
    assert K.area(K.mended(nested)) == 16 and K.area(K.mended(ring(box(0, 0, 1, 1)) + ring(box(2, 0, 3, 1)))) == 2
    hole = [nested[0], nested[1][::-1]]
    assert K.mended(hole) == hole and K.mended([np.array([[0, 0], [1, 1], [2, 2], [0, 0]], float)]) == []
    assert K.area(K.mended([nested[0][::-1]])) == 16
