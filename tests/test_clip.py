"""A boundary of several rows: all of them count, and where they overlap once; outside is what the box around them all leaves out."""

from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.operators.spatial import clip
from quadrille.plans import catalog


def test_all_rows_of_the_boundary(spark):
    box = lambda x1, y1, x2, y2: [[float(v) for v in (x1, y1, x2, y1, x2, y2, x1, y2, x1, y1)]]
    edge = spark.createDataFrame([(box(0, 0, 10, 10),), (box(5, 0, 20, 10),), (box(100, 100, 110, 110),)], "geom array<array<double>>")
    rows = [(1, box(2, 2, 18, 4)), (2, box(101, 101, 103, 103)), (3, box(50, 50, 51, 51)), (4, box(20, 0, 22, 10)), (7, box(111, 0, 112, 1)), (5, None), (6, box(15, 5, 105, 105)), (1, box(2, 2, 18, 4))]
    got = clip(spark.createDataFrame(rows, "fid long, geom array<array<double>>"), edge, tolerance=0.01, cell=10.0)
    got = sorted((r["fid"], r["status"], round(r["a"], 6)) for r in got.withColumn("a", G.area(F.col("geom"))).collect())
    assert got == [(1, "ok", 32.0), (1, "ok", 32.0), (2, "ok", 4.0), (3, "no_area", 0.0), (4, "no_area", 0.0), (5, "empty", 0.0), (6, "ok", 50.0), (7, "outside", 0.0)]


def test_the_query_cuts_every_part_and_fails_copies_only(spark):
    d, over = "/root/testdata/sf0.001", lambda a, b, c, d: max(0, min(b, d) - max(a, c))
    want = {}
    for k, s in spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_size").collect():
        x, y = k * 37 % 1000, k * 91 % 1000
        area = over(x, x + s, 0, 500) * over(y, y + s, 0, 500) + over(x, x + s, 700, 800) * over(y, y + s, 700, 900)
        want[k] = ("outside" if x > 800 or y > 900 else "ok" if area else "no_area", area)
        if k % 50 == 7:
            want[-k] = ("error", 0)
    rows = catalog.QUERIES["clip_to_boundary"](spark, d).collect()
    assert len(rows) == len(want) and {r["fid"]: (r["status"], r["area"]) for r in rows} == want
    assert any(want[-k][0] == "ok" for k in want if k < 0)
