"""Overlay against identities of areas, and well-known binary round trips."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.kernel import wkb
from quadrille.kernel.overlay import area, contains, crossings, defect, depths, difference_area, even_odd, intersection, intersects, length_within, mended_by, overlay, simplify, union


def box(x1, y1, x2, y2):
    return [np.array([[x1, y1], [x2, y1], [x2, y2], [x1, y2], [x1, y1]], float)]


def star(rng, n, x, y):
    a = np.sort(rng.random(n)) * 2 * np.pi
    r = 0.5 + rng.random(n)
    p = np.stack([x + r * np.cos(a), y + r * np.sin(a)], 1)
    return [np.vstack([p, p[:1]])]


def test_boxes():
    assert area(intersection(box(0, 0, 2, 2), box(1, 1, 3, 3))) == 1
    assert area(intersection(box(0, 0, 2, 2), box(2, 0, 3, 3))) == 0 and intersects(box(0, 0, 2, 2), box(2, 0, 3, 3))
    assert area(union([box(0, 0, 2, 2), box(1, 1, 3, 3), box(2, 0, 3, 1)])) == 8
    assert not intersects(box(0, 0, 1, 1), box(2, 2, 3, 3)) and intersects(box(0, 0, 9, 9), box(2, 2, 3, 3))
    assert length_within(np.array([[-1, 1], [5, 1.0]]), box(0, 0, 2, 2)) == 2


def test_hole_survives_binary():
    d = overlay([box(0, 0, 4, 4), box(1, 1, 2, 2)], lambda w: (w[:, 0] > 0) & (w[:, 1] <= 0))
    assert len(d) == 2 and area(d) == 15 and area(wkb.polygon_rings(wkb.multipolygon(d))) == 15


def test_repair_of_bow_tie():
    bow = [np.array([[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]], float)]
    assert crossings(bow) and abs(area(even_odd(bow)) - 2) < 1e-9


def test_random_polygons():
    rng = np.random.default_rng(1)
    for _ in range(25):
        a, b = star(rng, 30, 0, 0), star(rng, 30, rng.random(), rng.random())
        i, u = area(intersection(a, b)), area(union([a, b]))
        assert abs(i + u - area(a) - area(b)) < 1e-9 and abs(difference_area(a, b) - (u - i)) < 1e-9
        g = rng.random((4000, 2)) * 5 - 2
        assert abs((contains(a, g[:, 0], g[:, 1]) & contains(b, g[:, 0], g[:, 1])).mean() * 25 - i) < 0.5
        assert not crossings(simplify(a, 0.05))


LADDER = [
    ("square", [box(0, 0, 4, 4)[0]], "valid", None, 16),
    ("hole", [box(0, 0, 4, 4)[0], box(1, 1, 2, 2)[0][::-1]], "valid", None, 15),
    ("island in a hole", [box(0, 0, 9, 9)[0], box(1, 1, 8, 8)[0][::-1], box(2, 2, 3, 3)[0]], "valid", None, 33),
    ("bow tie", [np.array([[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]], float)], "even-odd", "edges cross", 2),
    ("pinched", [np.array([[0, 0], [2, 0], [2, 2], [4, 2], [4, 4], [2, 4], [2, 2], [0, 2], [0, 0]], float)], "even-odd", "touches itself", 8),
    ("nested", [box(0, 0, 4, 4)[0], box(1, 1, 2, 2)[0]], "winding", "lies in another", 16),
    ("twice", [box(0, 0, 4, 4)[0], np.roll(box(0, 0, 4, 4)[0][:-1], 1, axis=0)[[0, 1, 2, 3, 0]]], "winding", "there twice", 16),
    ("overlapping", [box(0, 0, 2, 2)[0], box(1, 1, 3, 3)[0]], "even-odd", "edges cross", 6),
    ("wrong way", [box(0, 0, 4, 4)[0][::-1]], "normalised", "in no outer ring", 16),
    ("collapsed beside", [box(0, 0, 4, 4)[0], np.array([[9, 9], [8, 8], [7, 7], [9, 9]], float)], "normalised", "collapsed", 16),
    ("collapsed", [np.array([[0, 0], [1, 1], [2, 2], [0, 0]], float)], "none", "collapsed", 0),
    ("open", [np.array([[0, 0], [1, 1], [2, 2]], float)], "none", "fewer than four", 0),
    ("nothing", [], "none", None, 0),
]


@pytest.mark.parametrize(("name", "rings", "rung", "reason", "size"), LADDER)
def test_repair_ladder(name, rings, rung, reason, size):
    out, by, why = mended_by(rings)
    assert by == rung and (why is None if reason is None else reason in why) and abs(area(out) - size) < 1e-9
    assert not out or defect(out) is None


def test_many_rings_are_nested_right():
    rings = [box(10 * k, 0, 10 * k + 9, 9)[0] for k in range(200)] + [box(10 * k + 1, 1, 10 * k + 8, 8)[0][::-1] for k in range(200)] + [box(10 * k + 2, 2, 10 * k + 3, 3)[0] for k in range(200)]
    assert depths(rings).tolist() == [0] * 200 + [1] * 200 + [2] * 200 and defect(rings) is None


def test_collections_keep_their_polygons(spark):
    ring = lambda r: struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes()
    line = struct.pack("<BI", 1, 2) + ring(np.array([[0, 0], [5, 5]], float))
    polygon = struct.pack("<BII", 1, 3, 1) + ring(box(0, 0, 2, 2)[0])
    inner = struct.pack("<BII", 1, 7, 2) + line + struct.pack("<BII", 1, 3, 1) + ring(LADDER[3][1][0] + 10)
    data = struct.pack("<BII", 1, 7, 3) + line + polygon + inner
    assert area(wkb.polygon_rings(data)[:1]) == 4 and len(wkb.lines(data)) == 2
    rows = spark.createDataFrame([(1, data), (2, line), (3, None)], "k int, g binary").select("k", F.inline(F.array(G.repair_of(G.from_wkb("g")))))
    got = {r["k"]: (r["rung"], r["geom"]) for r in rows.collect()}
    assert got[1][0] in ("valid", "even-odd") and abs(sum(area([np.array(r).reshape(-1, 2)]) for r in got[1][1]) - 6) < 1e-9 and got[2] == ("none", None) and got[3] == (None, None)
