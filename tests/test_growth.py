"""Work that grows with the rows, not with the cells that they cover or with how often they repeat each other."""

from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.operators import spatial as S
from quadrille.plans import fixtures as X

RINGS = "geom array<array<double>>"


def box(x1, y1, x2, y2):
    return [[float(v) for v in (x1, y1, x2, y1, x2, y2, x1, y2, x1, y1)]]


def test_boxes_of_a_billion_cells_are_not_cut(spark):
    zones = spark.createDataFrame([("a", box(0, 0, 1000, 1000)), ("b", box(1000, 0, 1100, 1000))], f"k string, {RINGS}")
    features = spark.createDataFrame([(2.0, box(500, 0, 1500, 500)), (3.0, box(1, 1, 2, 2)), (5.0, box(1000, 500, 1000, 600))], f"v double, {RINGS}")
    got = {r["k"]: round(r["intersect_area_ha"], 9) for r in S.overlay_area(zones, features, "k", 0.02).collect()}
    assert got == {"a": 25.0001, "b": 5.0}
    got = {r["k"]: round(r["allocated"], 9) for r in S.allocate(zones, features, "k", F.col("v"), 0.02).collect()}
    assert got == {"a": 4.0, "b": 0.2}


def test_boxes_and_others_on_both_sides_are_as_when_all_are_cut(spark):
    triangle = [[0.0, 0.0, 30.0, 0.0, 0.0, 30.0, 0.0, 0.0]]
    clockwise = [[0.0, 0.0, 0.0, 9.0, 9.0, 9.0, 9.0, 0.0, 0.0, 0.0]]
    rows = [(0, box(1, 1, 12, 7)), (1, triangle), (2, box(5, 5, 40, 40)), (3, None), (4, []), (5, clockwise), (6, box(3, 3, 3, 8))]
    layer = spark.createDataFrame(rows, f"k int, {RINGS}")
    pairs = lambda df: {(r["a"], r["b"]): round(r["n"], 6) for r in df.groupBy(F.col("l.k").alias("a"), F.col("r.k").alias("b")).agg(F.sum("area").alias("n")).collect()}
    got, want = pairs(S.overlapped(layer, layer, 4.0)), pairs(S.shared(S.cut(layer, 4.0), S.cut(layer, 4.0), 4.0))
    assert got == want and {(0, 1), (1, 0), (1, 1), (0, 2)} <= set(got)


def test_a_level_is_dealt_out_only_where_the_other_side_can_meet_it(spark):
    wide = spark.createDataFrame([("a", box(0, 0, 1000, 1000))], f"k string, {RINGS}")
    small = spark.createDataFrame([(i, box(i, i, i + 10, i + 10)) for i in range(50)], f"i int, {RINGS}")
    pairs = S.spatial_join(wide, small, 1.0)
    assert pairs.count() == 50 == S.spatial_join(small, wide, 1.0).count()
    assert S.spatial_join(small, small, 1.0).count() == sum(abs(a - b) <= 10 for a in range(50) for b in range(50))


def test_equal_features_and_pieces_are_united_once(spark, monkeypatch):
    zones = spark.createDataFrame([("a", box(0, 0, 100, 100))], f"k string, {RINGS}")
    rows = [(1000 - i, box(10, 10, 20, 30)) for i in range(500)] + [(2000 + i, box(-5 - i, -5, 200, 5)) for i in range(500)]
    seen, real = [], S.united_cells

    def counted(pieces, *rest):
        seen.append(pieces.count())
        return real(pieces, *rest)

    monkeypatch.setattr(S, "united_cells", counted)
    (row,) = S.dissolve(zones, spark.createDataFrame(rows, f"fid int, {RINGS}"), "k", 50.0).withColumn("a", G.area(F.col("geom"))).collect()
    assert (round(row["a"], 6), row["first_fid"]) == (200.0 + 500.0, 501)
    assert seen == [3]


def test_parts_that_fill_a_box_are_that_box():
    assert S.filled_box([box(0, 0, 5, 5), box(5, 0, 7, 5)]) == box(0, 0, 7, 5) == S.filled_box([box(0, 0, 7, 5)])
    assert S.filled_box([box(0, 0, 5, 5), box(5, 0, 7, 4)]) is None
    assert S.filled_box([[[0.0, 0.0, 2.0, 1.0, 1.0, 3.0, -1.0, 2.0, 0.0, 0.0]]]) is None
    assert S.filled_box([box(0, 0, 5, 5), [[0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0]]]) is None


def test_features_are_dealt_to_all_cores(spark):
    assert X.features(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
