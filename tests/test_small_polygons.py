"""Shorter ways for small convex polygons and for short edges give what the general ones give."""

import numpy as np

from quadrille.kernel import geodesic as D
from quadrille.kernel import overlay as K


def ring(*points):
    return [np.array([*points, points[0]], float)]


def test_convex_polygons_share_what_the_overlay_says():
    rng = np.random.default_rng(5)
    some = [ring(*(rng.integers(0, 9, 2) + 4 * np.stack([np.cos(a), np.sin(a)], 1).round(int(rng.integers(0, 3))))) for a in (np.sort(rng.uniform(0, 2 * np.pi, rng.integers(3, 8))) for _ in range(60))]
    some = [p for p in some if K.convex(p, K.grid_of(p))]
    told = 0
    for a in some:
        for b in some:
            got = K.convex_intersection(a, b, K.grid_of(a + b))
            if got is not None:
                want = K.overlay([a, b], lambda w: (w > 0).all(axis=1))
                assert abs(K.area(got) - K.area(want)) < 1e-9 and bool(got) == bool(want)
                assert not got or K.defect(got) is None
                told += 1
    assert told > 500


def test_what_is_not_clearly_convex_is_left_to_the_overlay():
    star = [(np.cos(k * 0.8 * np.pi), np.sin(k * 0.8 * np.pi)) for k in range(5)]
    for points in (star, [(0, 0), (0, 1), (1, 0)], [(0, 0), (1, 0), (2, 0), (0, 2)], [(0, 0), (4, 0), (1, 1), (0, 4)], [(0, 0), (1, 0), (1, 1e-14)], [(0, 0), (1, 0), (np.nan, 1)]):
        assert K.convex(ring(*points), 2.0**-44) is None
    assert K.convex([], 1.0) is None and len(K.convex(ring((0, 0), (1, 0), (0, 1)), 2.0**-44)) == 3


def test_short_edges_need_few_nodes():
    rng = np.random.default_rng(3)
    lon, lat = rng.uniform(-180, 180, 500), rng.uniform(-89, 89, 500)
    ends = lon, lat, lon + rng.uniform(-0.5, 0.5, 500), lat + rng.uniform(-0.5, 0.5, 500)
    few, many = (D.areas_by(*ends, 6378137.0, 1 / 298.257223563, rule) for rule in (D.FEW, D.MANY))
    assert np.abs(few - many).max() < 1e-2 and np.abs(many).max() > 1e11
