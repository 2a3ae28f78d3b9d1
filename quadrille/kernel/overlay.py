"""Boolean overlay of polygons: node all edges, find both sides of each, keep the borders of the result.

A polygon is a list of closed (n, 2) rings, outer ones counter-clockwise, holes clockwise.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

Rings = list[np.ndarray]
#: Coordinates are snapped to this fraction of the largest one.
SNAP = 2.0**-44
BLOCK = 256
#: No edge of real data lies in this direction, so the turned rays meet no edge lengthwise.
TURN = np.array([np.cos(0.7391), np.sin(0.7391)])


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def area(rings: Rings) -> float:
    return sum(signed_area(r) for r in rings)


def grid_of(rings: Rings) -> float:
    top = max((float(np.abs(r).max()) for r in rings), default=1.0)
    return 2.0 ** np.ceil(np.log2(max(top, 1e-300) * SNAP))


def segments(rings: Rings, grid: float) -> np.ndarray:
    """(n, 4) snapped segments of positive length."""
    parts = [np.hstack([r[:-1], r[1:]]) for r in rings if len(r) > 1]
    if not parts:
        return np.zeros((0, 4))
    s = np.round(np.vstack(parts) / grid) * grid
    return s[(s[:, :2] != s[:, 2:]).any(axis=1)]


def meetings(s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``s`` and ``t`` whose bounding boxes touch."""
    lo, hi = np.minimum(t[:, :2], t[:, 2:]), np.maximum(t[:, :2], t[:, 2:])
    low, high = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
    order, found = np.argsort(low[:, 0]), [np.zeros((0, 2), int)]
    for a in range(0, len(s), BLOCK):
        rows = order[a : a + BLOCK]
        near = np.flatnonzero((lo[:, 0] <= high[rows, 0].max()) & (hi[:, 0] >= low[rows[0], 0]))
        i, j = np.nonzero(((low[rows, None] <= hi[near]) & (high[rows, None] >= lo[near])).all(axis=2))
        found.append(np.stack([rows[i], near[j]], axis=1))
    pairs = np.concatenate(found)
    return pairs[:, 0], pairs[:, 1]


def cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]


def split(s: np.ndarray, owner: np.ndarray, grid: float) -> tuple[np.ndarray, np.ndarray, bool]:
    """Cut segments where others cross or touch them, once; whether there was anything to cut."""
    i, j = meetings(s, s)
    i, j = i[i < j], j[i < j]
    p, r, q, v = s[i, :2], s[i, 2:] - s[i, :2], s[j, :2], s[j, 2:] - s[j, :2]
    d = cross(r, v)
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = cross(q - p, v) / d, cross(q - p, r) / d
    met = (d != 0) & (a >= -1e-12) & (a <= 1 + 1e-12) & (b >= -1e-12) & (b <= 1 + 1e-12)
    point = np.round((p + np.where(met, a, 0)[:, None] * r) / grid) * grid
    cuts, where = [point[met], point[met]], [i[met], j[met]]
    for one, other in ((i, j), (j, i)):  # an end of one on the other, for parallel and nearly touching ones
        for end in (s[other, :2], s[other, 2:]):
            base, way = s[one, :2], s[one, 2:] - s[one, :2]
            size = (way * way).sum(axis=1)
            at = ((end - base) * way).sum(axis=1) / size
            on = (at > 0) & (at < 1) & (np.abs(cross(way, end - base)) <= 2 * grid * np.sqrt(size))
            cuts.append(end[on])
            where.append(one[on])
    point, at = np.concatenate(cuts), np.concatenate(where)
    inner = (point != s[at, :2]).any(axis=1) & (point != s[at, 2:]).any(axis=1)
    point, at = point[inner], at[inner]
    if not len(at):
        return s, owner, False
    way = s[at, 2:] - s[at, :2]
    place = ((point - s[at, :2]) * way).sum(axis=1) / (way * way).sum(axis=1)
    ids = np.arange(len(s))
    nodes = np.concatenate([s[:, :2], point, s[:, 2:]])
    seg = np.concatenate([ids, at, ids])
    order = np.lexsort((np.concatenate([np.full(len(s), -1.0), place, np.full(len(s), 2.0)]), seg))
    nodes, seg = nodes[order], seg[order]
    same = seg[1:] == seg[:-1]
    out, own = np.hstack([nodes[:-1][same], nodes[1:][same]]), owner[seg[1:][same]]
    real = (out[:, :2] != out[:, 2:]).any(axis=1)
    return out[real], own[real], True


#: Corners of the convex polygons that are worked on corner by corner, which for so few takes a hundredth of the time that arrays do.
CORNERS = 8
#: Grains of the grid within which ends and edges are left to ``overlay``, since there they may meet.
CLOSE = 16.0


def convex(rings: Rings, grid: float) -> list[tuple[float, float]] | None:
    """The corners, snapped, of one counter-clockwise ring of at most CORNERS clear turns to the left; None for any others."""
    if len(rings) != 1 or not 4 <= len(rings[0]) <= CORNERS + 1:
        return None
    p = [(round(x / grid) * grid, round(y / grid) * grid) for x, y in rings[0].tolist()] if np.isfinite(rings[0]).all() else [(0.0, 0.0)]
    if p[0] != p[-1]:
        return None
    p.pop()
    sides = [(x2 - x1, y2 - y1) for (x1, y1), (x2, y2) in zip(p, p[1:] + p[:1], strict=True)]
    turns = 0
    for (ux, uy), (vx, vy) in zip(sides[-1:] + sides[:-1], sides, strict=True):
        if ux * vy - uy * vx <= CLOSE * grid * (abs(ux) + abs(uy) + abs(vx) + abs(vy)):
            return None
        turns += ((ux, uy) > (0.0, 0.0)) != ((vx, vy) > (0.0, 0.0))
    return p if turns == 2 else None  # more, if it goes round twice


def convex_intersection(a: Rings, b: Rings, grid: float) -> Rings | None:
    """What two small convex polygons share, one cut by the sides of the other; None where ``overlay`` has to tell."""
    p, q = convex(a, grid), convex(b, grid)
    if p is None or q is None:
        return None
    for (x1, y1), (x2, y2) in zip(q, q[1:] + q[:1], strict=True):
        wx, wy = x2 - x1, y2 - y1
        off = [wx * (y - y1) - wy * (x - x1) for x, y in p]
        near = CLOSE * grid * (abs(wx) + abs(wy))
        if any(0 < abs(d) <= near for d in off):
            return None
        if max(off) <= 0:
            return []
        if min(off) >= 0:
            continue
        out = []
        for k, (x, y) in enumerate(p):
            if off[k] >= 0:
                out.append((x, y))
            n = (k + 1) % len(p)
            if off[k] * off[n] < 0:
                share = off[k] / (off[k] - off[n])
                out.append((round((x + share * (p[n][0] - x)) / grid) * grid, round((y + share * (p[n][1] - y)) / grid) * grid))
        p = out
    return [np.array([*p, p[0]])]


def overlay(operands: list[Rings], inside, grid: float | None = None) -> Rings:
    """The region where ``inside`` holds of the winding numbers (edges x operands); ``grid`` is what coordinates are snapped to."""
    grid = grid or grid_of([r for rings in operands for r in rings])
    parts = [segments(rings, grid) for rings in operands]
    s, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    for _ in range(8):
        s, owner, more = split(s, owner, grid)
        if not more:
            break
    if not len(s):
        return []
    back = (s[:, 0] > s[:, 2]) | ((s[:, 0] == s[:, 2]) & (s[:, 1] > s[:, 3]))
    edges, index = np.unique(np.where(back[:, None], s[:, [2, 3, 0, 1]], s), axis=0, return_inverse=True)
    delta = np.zeros((len(edges), len(parts)), np.int64)
    np.add.at(delta, (index.ravel(), owner), np.where(back, -1, 1))
    live = (delta != 0).any(axis=1)
    edges, delta = edges[live], delta[live]
    if not len(edges):
        return []
    turned = np.hstack([np.stack([e @ TURN, e[:, 1] * TURN[0] - e[:, 0] * TURN[1]], axis=1) for e in (edges[:, :2], edges[:, 2:])])
    up = np.where(turned[:, 3] > turned[:, 1], 1, -1)
    mid = (turned[:, :2] + turned[:, 2:]) / 2
    low, high = np.minimum(turned[:, 1], turned[:, 3]), np.maximum(turned[:, 1], turned[:, 3])
    slope = (turned[:, 2] - turned[:, 0]) / (turned[:, 3] - turned[:, 1])
    right = np.zeros_like(delta)
    order = np.argsort(mid[:, 1])
    for a in range(0, len(edges), BLOCK):
        rows = order[a : a + BLOCK]
        y, x = mid[rows, 1, None], mid[rows, 0, None]
        near = np.flatnonzero((low <= y[-1, 0]) & (high > y[0, 0]))
        beyond = (low[near] <= y) & (y < high[near]) & (turned[near, 0] + (y - turned[near, 1]) * slope[near] > x) & (near != rows[:, None])
        right[rows] = beyond.astype(np.int64) @ (delta[near] * up[near, None])
    left = right + delta * up[:, None]
    in_left, in_right = inside(left), inside(right)
    # The sides are those of an edge that goes up; the interior is to stay on the left.
    keep = in_left != in_right
    forward = np.where(up > 0, in_left, in_right)[keep]
    e = edges[keep]
    return stitched(np.where(forward[:, None], e, e[:, [2, 3, 0, 1]]))


def stitched(edges: np.ndarray) -> Rings:
    """Simple rings out of directed edges with the interior on their left."""
    leaving: dict[tuple, list[int]] = defaultdict(list)
    starts, ends = [tuple(p) for p in edges[:, :2].tolist()], [tuple(p) for p in edges[:, 2:].tolist()]
    for k, p in enumerate(starts):
        leaving[p].append(k)
    angle = np.arctan2(edges[:, 3] - edges[:, 1], edges[:, 2] - edges[:, 0])
    used, rings = [False] * len(edges), []
    for first in range(len(edges)):
        if used[first]:
            continue
        path, at, k = [starts[first]], {starts[first]: 0}, first
        while k is not None:
            used[k] = True
            p = ends[k]
            if p in at:  # a loop is closed: it leaves as a ring of its own
                ring = [*path[at[p] :], p]
                for q in path[at[p] + 1 :]:
                    del at[q]
                del path[at[p] + 1 :]
                if len(ring) > 3:
                    rings.append(np.array(ring))
            else:
                at[p] = len(path)
                path.append(p)
            came = angle[k] + np.pi
            free = [n for n in leaving[p] if not used[n]]
            k = min(free, key=lambda n: (came - angle[n]) % (2 * np.pi) or 2 * np.pi) if free else None
    return [r for r in rings if signed_area(r) != 0]


def intersection(a: Rings, b: Rings, grid: float | None = None) -> Rings:
    if not a or not b:
        return []
    small = convex_intersection(a, b, grid or grid_of(a + b))
    if small is not None:
        return small
    return overlay([a, b], lambda w: (w > 0).all(axis=1), grid)


def union(all_rings: list[Rings], grid: float | None = None) -> Rings:
    """Oriented rings of many polygons wind around every covered point a positive number of times."""
    return overlay([[r for rings in all_rings for r in rings]], lambda w: w[:, 0] > 0, grid)


def even_odd(rings: Rings) -> Rings:
    """The valid polygon of all points that an odd number of rings surround."""
    return overlay([rings], lambda w: w[:, 0] % 2 != 0)


def canonical(ring: np.ndarray) -> bytes:
    """The same for all ways to write a ring: from its smallest vertex, in the direction of its smaller neighbour."""
    p = ring[:-1]
    k = int(np.lexsort((p[:, 1], p[:, 0]))[0])
    p = np.roll(p, -k, axis=0)
    return min(p.tobytes(), np.vstack([p[:1], p[:0:-1]]).tobytes())


def collapsed(ring: np.ndarray) -> bool:
    """Whether all points lie on one line; a bow tie may have no area either, but doesn't."""
    off = ring - ring[0]
    far = off[int((off**2).sum(axis=1).argmax())] if len(ring) else off
    return len(ring) < 4 or not cross(np.broadcast_to(far, off.shape), off).any()


def depths(rings: Rings) -> np.ndarray:
    """How many other rings surround each, of rings whose edges do not cross; by ascending left ends, only those still open are asked."""
    low, high = np.array([r.min(axis=0) for r in rings]), np.array([r.max(axis=0) for r in rings])
    out, active = np.zeros(len(rings), int), []
    for k in np.lexsort((-high[:, 0], low[:, 0])).tolist():
        active = [j for j in active if high[j, 0] >= low[k, 0]]
        mid = (rings[k][:1] + rings[k][1:2]) / 2
        out[k] = sum((low[j] <= low[k]).all() and (high[j] >= high[k]).all() and bool(contains([rings[j]], mid[:, 0], mid[:, 1])[0]) for j in active)
        active.append(k)
    return out


def defect(rings: Rings) -> str | None:
    """Why rings are not a valid polygon, outer rings being counter-clockwise; None if they are one."""
    if len(rings) == 1 and len(rings[0]) <= CORNERS + 1 and np.isfinite(rings[0]).all() and convex(rings, grid_of(rings)):
        return None
    if not all(np.isfinite(r).all() for r in rings):
        return "coordinates are not finite"
    if not all(len(r) > 3 and (r[0] == r[-1]).all() for r in rings):
        return "a ring is open or has fewer than four points"
    areas = np.array([signed_area(r) for r in rings])
    if any(map(collapsed, rings)):
        return "a ring is collapsed"
    if crossings(rings):
        return "edges cross or overlap"
    if any(len(np.unique(r[:-1], axis=0)) < len(r) - 1 for r in rings):
        return "a ring touches itself"
    if len(rings) > 1 and len({canonical(r) for r in rings}) < len(rings):
        return "a ring is there twice"
    wrong = (depths(rings) % 2 == 0) != (areas > 0) if len(rings) else np.zeros(0, bool)
    if wrong.any():
        return "an outer ring lies in another" if (areas[wrong] > 0).any() else "a hole is in no outer ring"
    return None


def mended(rings: Rings) -> Rings:
    """A valid polygon out of any rings; see ``mended_by``. Nothing, if nothing is left."""
    return mended_by(rings)[0]


def mended_by(rings: Rings) -> tuple[Rings, str, str | None]:
    """(rings, rung, defect): the first rung of a ladder that gives a polygon with area.

    ``valid``: as they are; ``normalised``: without rings of no area, or turned the right
    way round; ``even-odd``: the region that an odd number of rings surround, where edges
    cross or rings touch themselves; ``winding``: the union, where outer rings lie in or on
    each other; ``none``.
    """
    reason = defect(rings)
    if reason is None:
        return rings, "valid" if rings else "none", None
    rings = [r for r in rings if not collapsed(r)]
    if not rings:
        return [], "none", reason
    if crossings(rings) or reason == "a ring touches itself":
        return told(even_odd(rings), "even-odd", reason)
    if defect(rings) is None:
        return rings, "normalised", reason
    turned = [r if (signed_area(r) > 0) == (d % 2 == 0) else r[::-1] for r, d in zip(rings, depths(rings), strict=True)]
    if all(signed_area(r) < 0 for r in rings) and defect(turned) is None:
        return turned, "normalised", reason
    return told(overlay([rings], lambda w: w[:, 0] > 0) if area(rings) > 0 else even_odd(rings), "winding", reason)


def told(rings: Rings, rung: str, reason: str) -> tuple[Rings, str, str | None]:
    return rings, rung if rings else "none", reason


def straightened(rings: Rings) -> Rings:
    """Without the vertices that lie between their neighbours on a straight line."""
    out = []
    for r in rings:
        p = r[:-1]
        before, after = p - np.roll(p, 1, axis=0), np.roll(p, -1, axis=0) - p
        bend = (cross(before, after) != 0) | ((before * after).sum(axis=1) < 0)
        if bend.sum() >= 3:
            out.append(np.vstack([p[bend], p[bend][:1]]))
    return out


def difference_area(a: Rings, b: Rings) -> float:
    return area(overlay([a, b], lambda w: (w[:, 0] > 0) != (w[:, 1] > 0)))


def crossings(rings: Rings) -> bool:
    """Whether edges cross or touch other than in common ends."""
    if convex(rings, grid_of(rings)):
        return False
    s = segments(rings, grid_of(rings))
    return split(s, np.zeros(len(s), int), grid_of(rings))[2]


def contains(rings: Rings, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(x), bool)
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:], strict=True):
            if y1 != y2:
                inside ^= ((y1 <= y) != (y2 <= y)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
    return inside


def intersects(a: Rings, b: Rings) -> bool:
    """Whether the closed regions share a point."""
    if not a or not b:
        return False
    grid = grid_of(a + b)
    s, t = segments(a, grid), segments(b, grid)
    i, j = meetings(s, t)
    p, r, q, v = s[i, :2], s[i, 2:] - s[i, :2], t[j, :2], t[j, 2:] - t[j, :2]
    c1, c2, c3, c4 = cross(r, q - p), cross(r, q + v - p), cross(v, p - q), cross(v, p + r - q)
    if ((np.sign(c1) * np.sign(c2) <= 0) & (np.sign(c3) * np.sign(c4) <= 0)).any():
        return True
    return bool(contains(b, a[0][:1, 0], a[0][:1, 1])[0] or contains(a, b[0][:1, 0], b[0][:1, 1])[0])


def thinned(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on a closed ring, split at the vertex farthest from its start."""
    n = len(ring)
    keep = np.zeros(n, bool)
    far = int(((ring - ring[0]) ** 2).sum(axis=1).argmax())
    keep[[0, far, n - 1]] = True
    spans = [(0, far), (far, n - 1)]
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        way, rest = ring[b] - ring[a], ring[a + 1 : b] - ring[a]
        size = float(np.hypot(*way))
        off = np.abs(cross(way, rest)) / size if size else np.hypot(rest[:, 0], rest[:, 1])
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            spans += [(a, a + 1 + k), (a + 1 + k, b)]
    return ring[keep]


def simplify(rings: Rings, tolerance: float, preserve: bool = True) -> Rings:
    """Thin every ring; with ``preserve`` no ring is lost and no crossing made, else rings that collapse go."""
    if not preserve:
        return [r for r in (thinned(x, tolerance) for x in rings) if len(r) > 3]
    for shrink in range(5):
        out = [t if len(t := thinned(r, tolerance / 4**shrink)) > 3 and signed_area(t) * signed_area(r) > 0 else r for r in rings]
        if not crossings(out):
            return out
    return rings


def length_within(line: np.ndarray, rings: Rings) -> float:
    """The length of a line inside a polygon: cut at its edges, then by midpoints."""
    if not rings or len(line) < 2:
        return 0.0
    total, edges = 0.0, np.vstack([np.hstack([r[:-1], r[1:]]) for r in rings])
    q, v = edges[:, :2], edges[:, 2:] - edges[:, :2]
    for p, e in zip(line[:-1], line[1:], strict=True):
        r = e - p
        d = cross(r[None], v)
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = cross(q - p, v) / d, cross(q - p, r[None]) / d
        cuts = np.unique(np.concatenate([[0.0, 1.0], t[(d != 0) & (u >= 0) & (u <= 1) & (t > 0) & (t < 1)]]))
        mid = p + (cuts[:-1] + cuts[1:])[:, None] / 2 * r
        total += float((np.diff(cuts) * contains(rings, mid[:, 0], mid[:, 1])).sum() * np.hypot(*r))
    return total
