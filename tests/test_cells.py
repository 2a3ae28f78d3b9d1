"""Cut cells against whole polygons, and every operator on large and small geometries, both ways."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.kernel import cells as C
from quadrille.kernel import overlay as K
from quadrille.operators import spatial as S

RING = "geom array<array<double>>"


def box(x1, y1, x2, y2):
    return [[float(v) for v in (x1, y1, x2, y1, x2, y2, x1, y2, x1, y1)]]


def rings(g):
    return [np.array(r).reshape(-1, 2) for r in g]


def star(rng, n, x, y, size):
    a = np.sort(rng.random(n)) * 2 * np.pi
    r = size * (0.5 + rng.random(n))
    p = np.round(np.stack([x + r * np.cos(a), y + r * np.sin(a)], 1), 3)
    return [np.vstack([p, p[:1]])]


def test_cells_hold_all_of_a_polygon():
    rng = np.random.default_rng(7)
    for cell in (4.0, 3.7, 50.0):
        for _ in range(4):
            outer = star(rng, 60, rng.random() * 9, -3.0, 20)
            poly = K.overlay([outer, star(rng, 9, 3, -3, 3)], lambda w: (w[:, 0] > 0) & (w[:, 1] <= 0))
            made = [(i, j, p) for a, e, j, p in C.cut(poly, cell) for i in range(a, e + 1)]
            assert len({(i, j) for i, j, _ in made}) == len(made)
            square = lambda i, j: rings(box(i * cell, j * cell, (i + 1) * cell, (j + 1) * cell))
            for i, j, part in made:
                want = K.area(K.intersection(poly, square(i, j)))
                assert abs((cell * cell if part is None else K.area(part)) - want) < 1e-6
            assert abs(sum(cell * cell if p is None else K.area(p) for _, _, p in made) - K.area(poly)) < 1e-6
            grain = C.snap_of(cell)
            back = K.straightened(K.union([p or square(i, j) for i, j, p in made], grain))
            assert K.difference_area(back, poly) < 1e-6 and len(back) == len(poly)


def test_halving_is_linear_in_the_vertices():
    a = np.linspace(0, 2 * np.pi, 100_001)
    r = 1000 + 20 * np.sin(900 * a)
    ring = np.stack([r * np.cos(a), r * np.sin(a)], 1)
    ring[-1] = ring[0]
    made = [(i, j, p) for a, e, j, p in C.cut([ring], 50.0) for i in range(a, e + 1)]
    whole, largest = sum(p is None for _, _, p in made), max(len(np.vstack(p)) for _, _, p in made if p is not None)
    assert whole > 1000 and largest < 2000
    assert abs(sum(2500.0 if p is None else K.area(p) for _, _, p in made) - K.signed_area(ring)) < 1e-3


def test_lines_are_cut_at_borders():
    line = np.array([[-1.0, 0.5], [3.5, 0.5], [3.5, 4.5], [3.0, 4.5]])
    made = C.cut_line(line, 1.0)
    assert [(i, j) for i, j, _ in made] == [(-1, 0), (0, 0), (1, 0), (2, 0), (3, 0), (3, 1), (3, 2), (3, 3), (3, 4)]
    assert abs(sum(np.hypot(*np.diff(p, axis=0).T).sum() for _, _, p in made) - 9) < 1e-12


LARGE = [(0, box(0, 0, 5000, 5000)), (1, box(0, 0, 40, 40)), (2, [[0.0, 0.0, 700.0, 0.0, 0.0, 700.0, 0.0, 0.0]]), (3, box(9000, 9000, 9001, 9001))]
SMALL = [(i, box(i * 10, i * 10, i * 10 + 3, i * 10 + 3)) for i in range(60)] + [(90, [[100.0, 5.0, 130.0, 20.0, 100.0, 40.0, 100.0, 5.0]]), (91, box(4999, 4999, 5002, 5002)), (92, None), (93, [])]


BOTH = [(1000 + i, g) for i, g in LARGE] + SMALL


@pytest.mark.parametrize(("left", "right"), [(LARGE, SMALL), (BOTH, BOTH), (LARGE, []), ([], LARGE)])
@pytest.mark.parametrize("cell", [20.0, 0.7])
def test_all_sizes_meet(spark, left, right, cell):
    if cell < 1 and (len(left), len(right)) != (len(LARGE), len(SMALL)):
        pytest.skip("one case is enough for three levels")
    if cell < 1:
        left = [(i, g) for i, g in left if i != 0] + [(0, box(0, 0, 300, 300))]
    a, b = (spark.createDataFrame(rows, f"fid int, {RING}").withColumn("v", F.lit(2.0)) for rows in (left, right))
    lost = lambda g: not g
    common = {(i, j): K.area(K.intersection(rings(g), rings(h))) for i, g in left if not lost(g) for j, h in right if not lost(h)}
    touch = sorted((i, j) for i, g in left if not lost(g) for j, h in right if not lost(h) if K.intersects(rings(g), rings(h)))
    got = S.spatial_join(a, b, cell, exact=True).select(F.col("l.fid"), F.col("r.fid")).collect()
    assert sorted(map(tuple, got)) == touch
    zone = lambda i: sum(x for (k, _), x in common.items() if k == i)
    area = {r["fid"]: r["intersect_area_ha"] for r in S.overlay_area(a, b, "fid", cell).collect()}
    assert set(area) == {i for i, _ in left} and all(abs(v * 1e4 - zone(i)) < 1e-5 for i, v in area.items())
    full = {j: K.area(rings(h)) for j, h in right if not lost(h)}
    value = {r["fid"]: r["allocated"] for r in S.allocate(a, b, "fid", F.col("v"), cell).collect()}
    assert all(abs(v - sum(2 * x / full[j] for (k, j), x in common.items() if k == i)) < 1e-6 for i, v in value.items())
    lines = spark.createDataFrame([([float(x) for p in h[0][:8] for x in [p]],) for _, h in right if not lost(h)], "geom array<double>")
    length = {r["fid"]: r["intersect_length_km"] for r in S.overlay_length(a, lines, "fid", cell).collect()}
    want = {i: 0 if lost(g) else sum(K.length_within(np.array(h[0][:8]).reshape(-1, 2), rings(g)) for _, h in right if not lost(h)) for i, g in left}
    assert set(length) == set(want) and all(abs(length[i] * 1000 - want[i]) < 1e-6 for i in want)


@pytest.mark.parametrize("cell", [90.0])
def test_dissolve_and_clip_of_all_sizes(spark, cell):
    zones, parts = (spark.createDataFrame(rows, f"fid int, {RING}") for rows in (LARGE, SMALL))
    for a, b, left, right in ((zones, parts, LARGE, SMALL), (parts.filter("fid < 92"), zones, SMALL, LARGE)):
        got = {r["k"]: r for r in S.dissolve(a.withColumnRenamed("fid", "k"), b, "k", cell).collect()}
        all_right = K.union([rings(h) for _, h in right if h])
        for i, g in left:
            want = K.intersection(rings(g), all_right) if g else []
            assert (i in got) == bool(want)
            if want:
                assert K.difference_area(rings(got[i]["geom"]), want) < 1e-5 and len(got[i]["geom"]) == len(K.straightened(want))
                assert got[i]["first_fid"] == min(j for j, h in right if h and K.area(K.intersection(rings(g), rings(h))) > 0)
        clipped = {r["fid"]: r for r in S.clip(a, b, 0.001, cell).collect()}
        for i, g in left:
            if i < 92 and g:
                want = K.area(K.intersection(rings(g), all_right))
                assert (clipped[i]["status"] == "ok") == (want > 0) and abs(K.area(rings(clipped[i]["geom"] or [])) - want) < 1e-5
    counts = {r["status"]: r["n"] for r in S.counted(S.clip(parts, zones.filter("fid = 1"), 0.001, cell)).collect()}
    assert counts == {"ok": 4, "empty": 2, "outside": 57, "no_area": 1} and sum(counts.values()) == len(SMALL)


def test_boundary_of_many_points(spark):
    """Features wholly inside keep their points; those at the edge are cut; no row of a pair holds the boundary."""
    a = np.linspace(0, 2 * np.pi, 100_001)
    ring = np.stack([50_000 + 40_000 * np.cos(a) + 30 * np.sin(5000 * a), 50_000 + 40_000 * np.sin(a)], 1)
    ring[-1] = ring[0]
    edge = spark.createDataFrame([([ring.ravel().tolist()],)], RING)
    rows = [(k, box(x, y, x + 500, y + 500)) for k, (x, y) in enumerate((x, y) for x in range(0, 100_000, 9000) for y in range(0, 100_000, 9000))]
    rows.append((len(rows), box(89_800, 49_800, 90_300, 50_300)))
    cells = S.boundary_cells(edge, 2000.0)
    most = cells.agg(F.max(G.n_points(F.col("geom"))), F.count_if(F.col("geom").isNull())).first()
    assert most[0] < 5000 and most[1] > 1000
    out = S.clip(spark.createDataFrame(rows, f"fid int, {RING}"), edge, 0.01, 2000.0).select("fid", "status", G.area(F.col("geom")).alias("a"), G.n_points(F.col("geom")).alias("n")).collect()
    far = {k: max(np.hypot(x - 50_000, y - 50_000) for x, y in np.array(g).reshape(-1, 2)) for k, g in rows}
    near = {k: min(np.hypot(x - 50_000, y - 50_000) for x, y in np.array(g).reshape(-1, 2)) for k, g in rows}
    for r in out:
        if far[r["fid"]] < 39_900:
            assert (r["status"], r["a"], r["n"]) == ("ok", 250_000.0, 5)
        elif near[r["fid"]] > 41_000:
            assert r["status"] in ("outside", "no_area")
    total = cells.agg(F.sum(F.when(F.col("geom").isNull(), 4e6).otherwise(G.area(F.col("geom"))))).first()[0]
    assert abs(total - K.signed_area(ring)) < 1 and any(0 < r["a"] < 250_000 for r in out)


def test_exploded_polygons(spark):
    two = box(0, 0, 9, 9) + [[float(v) for v in (1, 1, 1, 2, 2, 2, 2, 1, 1, 1)]] + box(20, 0, 21, 1)
    got = G.exploded(spark.createDataFrame([(1, two), (2, [])], f"fid int, {RING}")).select("fid", "part", F.size("geom").alias("n"), G.area(F.col("geom")).alias("a")).collect()
    assert {(n, a) for _, _, n, a in got} == {(2, 80.0), (1, 1.0)} and sorted(r['part'] for r in got) == [0, 1]
