"""Polygons and lines cut at the borders of square cells."""

from __future__ import annotations

import math

import numpy as np

from quadrille.kernel.overlay import Rings, signed_area


def snap_of(cell: float) -> float:
    """The grain that coordinates are rounded to: the same on both sides of every border, and small beside a cell."""
    return 2.0 ** (math.ceil(math.log2(cell)) - 36)


def snapped(v, grain: float):
    return np.round(np.asarray(v, float) / grain) * grain


def halves(ring: np.ndarray, axis: int, at: float, grain: float) -> tuple[np.ndarray | None, np.ndarray | None]:
    """The parts of a closed ring below and above a line; where edges cross it, both get the same point.

    A part that leaves the line several times runs along it in between, there and back,
    which adds nothing to areas and winding numbers.
    """
    off = ring[:, axis] - at
    if (off <= 0).all():
        return ring, None
    if (off >= 0).all():
        return None, ring
    p, q, a, b = ring[:-1], ring[1:], off[:-1], off[1:]
    met = np.flatnonzero(a * b < 0)
    point = np.empty((len(met), 2))
    point[:, axis] = at
    other = 1 - axis
    share = a[met] / (a[met] - b[met])
    point[:, other] = snapped(p[met, other] + share * (q[met, other] - p[met, other]), grain)
    place = np.concatenate([np.arange(len(p)), met + 0.5])
    nodes, side = np.concatenate([p, point]), np.concatenate([a, np.zeros(len(met))])
    order = np.argsort(place, kind="stable")
    nodes, side = nodes[order], side[order]
    out = []
    for keep in (side <= 0, side >= 0):
        part = nodes[keep]
        closed = np.vstack([part, part[:1]]) if len(part) >= 3 else part
        out.append(closed if len(closed) > 3 and signed_area(closed) != 0 else None)
    return out[0], out[1]


def split(rings: Rings, axis: int, at: float, grain: float) -> tuple[Rings, Rings]:
    pairs = [halves(r, axis, at, grain) for r in rings]
    return [a for a, _ in pairs if a is not None], [b for _, b in pairs if b is not None]


def fills(rings: Rings, x1: float, y1: float, x2: float, y2: float) -> bool:
    """Whether the rings, which lie within a rectangle, are all of it."""
    size = (x2 - x1) * (y2 - y1)
    if abs(sum(map(signed_area, rings)) - size) > 1e-12 * size:
        return False
    p = np.vstack(rings)
    return bool(((p[:, 0] == x1) | (p[:, 0] == x2) | (p[:, 1] == y1) | (p[:, 1] == y2)).all())


def cut(rings: Rings, cell: float) -> list[tuple[int, int, int, Rings | None]]:
    """(first column, last column, row, piece) of all cells that the polygon covers some of; cells that it covers whole come as runs of a row, with None.

    Halved again and again, so a vertex is looked at once for each halving, and what
    fills a block of cells is not cut any more.
    """
    grain = snap_of(cell)
    rings = [s for r in rings if len(s := snapped(r, grain)) > 3 and signed_area(s) != 0]
    if not rings:
        return []
    line = lambda k: float(snapped(k * cell, grain))
    p = np.vstack(rings)
    low, high = np.floor(p.min(axis=0) / cell).astype(int), np.maximum(np.ceil(p.max(axis=0) / cell).astype(int) - 1, np.floor(p.min(axis=0) / cell).astype(int))
    out, todo = [], [(int(low[0]), int(high[0]), int(low[1]), int(high[1]), rings)]
    while todo:
        i0, i1, j0, j1, part = todo.pop()
        if not part:
            continue
        if fills(part, line(i0), line(j0), line(i1 + 1), line(j1 + 1)):
            out += [(i0, i1, j, None) for j in range(j0, j1 + 1)]
        elif i0 == i1 and j0 == j1:
            out.append((i0, i0, j0, part))
        elif i1 - i0 >= j1 - j0:
            m = (i0 + i1 + 1) // 2
            a, b = split(part, 0, line(m), grain)
            todo += [(i0, m - 1, j0, j1, a), (m, i1, j0, j1, b)]
        else:
            m = (j0 + j1 + 1) // 2
            a, b = split(part, 1, line(m), grain)
            todo += [(i0, i1, j0, m - 1, a), (i0, i1, m, j1, b)]
    return out


def cut_line(line: np.ndarray, cell: float) -> list[tuple[int, int, np.ndarray]]:
    """(column, row, piece) of a line's stretches between borders; a stretch along a border belongs to the cell above or right of it."""
    out = []
    for p, q in zip(line[:-1], line[1:], strict=True):
        way, at = q - p, [0.0, 1.0]
        for axis in (0, 1):
            if way[axis]:
                a, b = sorted((p[axis], q[axis]))
                at += ((np.arange(math.floor(a / cell) + 1, math.ceil(b / cell)) * cell - p[axis]) / way[axis]).tolist()
        at = np.unique(np.clip(at, 0, 1))
        ends = p + at[:, None] * way
        for a, b, m in zip(ends[:-1], ends[1:], (at[:-1] + at[1:]) / 2, strict=True):
            i, j = np.floor((p + m * way) / cell).astype(int).tolist()
            if out and out[-1][:2] == (i, j) and (out[-1][2][-1] == a).all():
                out[-1] = (i, j, np.vstack([out[-1][2], b]))
            else:
                out.append((i, j, np.stack([a, b])))
    return out
