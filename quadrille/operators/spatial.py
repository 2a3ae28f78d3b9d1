"""Joins of polygon layers on grid cells, and overlays of what cells hold of them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.kernel import cells as C
from quadrille.kernel import overlay as K
from quadrille.sources.staging import staged, tasks_of


#: A geometry that covers more cells than this is dealt to coarser ones.
MOST_CELLS, COARSER = 256, 8.0
#: Up to this many rows Spark would put a join into one task by its bytes, though its work is in the CPU.
FEW = 1_000_000


def spatial_join(left: DataFrame, right: DataFrame, cell: float, exact: bool = False) -> DataFrame:
    """Pairs (l, r, lb, rb, boxes) of whole rows and their bounds (``boxes``: both are their bounds), which touch (whose polygons do, if ``exact``), each pair once.

    Boxes are dealt to square cells, which makes an equi-join that Spark can shuffle and
    split; a pair stays only in the cell of the corner that the two boxes have in common.
    A geometry that would cover more than MOST_CELLS cells takes cells COARSER times as
    wide, as often as it takes; a pair meets at the coarser of its two levels, so the
    other side is dealt out once more for each level that is there, and no others, and
    at its own level only if the other side has one that is not coarser.
    Layers of few rows are dealt to all cores; for larger ones Spark sizes the
    partitions by their bytes and splits those of hot cells.
    Both sides carry ``geom``; null and empty geometries meet nothing.
    """

    def boxed(df: DataFrame, side: str) -> DataFrame:
        made = F.inline(F.array(F.struct(G.bounds(F.col("geom")).alias(f"{side}b"), G.is_box(F.col("geom")).alias(f"{side}q"))))
        rows = df.filter(~G.is_empty(F.col("geom"))).select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(side), made)
        b = F.col(f"{side}b")
        cells = ((b["maxx"] - b["minx"]) / cell + 1) * ((b["maxy"] - b["miny"]) / cell + 1)
        return rows.withColumn(f"{side}v", F.greatest(F.lit(0), F.ceil(F.log(cells / MOST_CELLS) / math.log(COARSER**2))).cast("int"))

    def dealt(rows: DataFrame, side: str, levels: list[int]) -> DataFrame:
        own = F.col(f"{side}v")
        at_own = F.when(own >= min(levels), F.array(own)).otherwise(F.array().cast("array<int>"))
        rows = rows.withColumn("level", F.explode(F.concat(at_own, F.filter(F.array(*[F.lit(v) for v in levels]), lambda v: v > own))))
        size = F.pow(F.lit(COARSER), F.col("level")) * cell
        at = lambda c: F.floor(F.col(f"{side}b.{c}") / size)
        return rows.withColumn("cx", F.explode(F.sequence(at("minx"), at("maxx")))).withColumn("cy", F.explode(F.sequence(at("miny"), at("maxy"))))

    a, b = boxed(left, "l"), boxed(right, "r")
    # There are as many levels as the extent has powers of COARSER, so what comes here is a handful of numbers.
    counts = [{r[0]: r[1] for r in rows.groupBy(side).count().collect()} or {0: 0} for rows, side in ((a, "lv"), (b, "rv"))]
    cells = ["level", "cx", "cy"]
    a, b = (dealt(rows, side, sorted(other)) for rows, side, other in ((a, "l", counts[1]), (b, "r", counts[0])))
    if sum(sum(c.values()) for c in counts) <= FEW:
        a, b = (rows.repartition(tasks_of(left.sparkSession), *cells) for rows in (a, b))
    meets = (F.col("lb.minx") <= F.col("rb.maxx")) & (F.col("lb.maxx") >= F.col("rb.minx")) & (F.col("lb.miny") <= F.col("rb.maxy")) & (F.col("lb.maxy") >= F.col("rb.miny"))
    size = F.pow(F.lit(COARSER), F.col("level")) * cell
    first = lambda c: F.floor(F.greatest(F.col(f"lb.{c}"), F.col(f"rb.{c}")) / size)
    once = (F.col("level") == F.greatest("lv", "rv")) & (F.col("cx") == first("minx")) & (F.col("cy") == first("miny"))
    pairs = a.join(b, cells).filter(meets & once).select("l", "r", "lb", "rb", (F.col("lq") & F.col("rq")).alias("boxes"))
    if not exact:
        return pairs
    return pairs.filter("boxes").unionByName(pairs.filter("NOT boxes").filter(G.intersects("l.geom", "r.geom")))


CELLS = "array<struct<first:int,last:int,cy:int,b:struct<minx:double,miny:double,maxx:double,maxy:double>,geom:array<array<double>>>>"
LINES = "array<struct<cx:int,cy:int,line:array<double>>>"
ENDS = ("minx", "miny", "maxx", "maxy")


def cut_polygons(cell: float):
    def told(first: int, last: int, cy: int, part: K.Rings | None) -> dict:
        if part is None:
            return {"first": first, "last": last, "cy": cy, "b": None, "geom": None}
        p = np.vstack(part)
        return {"first": first, "last": last, "cy": cy, "b": dict(zip(ENDS, [*p.min(axis=0).tolist(), *p.max(axis=0).tolist()], strict=True)), "geom": G.flat(part)}

    @F.pandas_udf(CELLS)
    def run(geom: pd.Series) -> pd.Series:
        return pd.Series([None if g is None else [told(*c) for c in C.cut(G.rings_of(g), cell)] for g in geom], dtype=object)

    return run


def cut_lines(cell: float):
    @F.pandas_udf(LINES)
    def run(line: pd.Series) -> pd.Series:
        made = lambda v: [{"cx": i, "cy": j, "line": p.ravel()} for i, j, p in C.cut_line(np.asarray(v, float).reshape(-1, 2), cell)]
        return pd.Series([None if v is None else made(v) for v in line], dtype=object)

    return run


def cell_box(cell: float, cx: Column, cy: Column) -> tuple[Column, Column, Column, Column]:
    return cx * cell, cy * cell, (cx + 1) * cell, (cy + 1) * cell


def cut(df: DataFrame, cell: float) -> DataFrame:
    """A row for each cell that ``geom`` covers some of: the other columns, cx, cy, ``cells`` (how many the row has), ``whole``, the bounds ``b`` of its piece, and ``geom``, the piece, or null where it is the box ``b``.

    Boxes are cut by built-in expressions, other polygons by one pass of Python, each
    once. So no later step carries or overlays more of a polygon than one cell holds,
    and whole cells need no overlay at all. Cells are runs at first, so what is in
    memory at once goes with the outline of a polygon, not with its area; each becomes
    a narrow row, so cells are best about as large as the smaller geometries. Null and
    empty geometries have no cells.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != "geom"]
    ring = F.get("geom", F.lit(0))
    end = lambda f, k: f(F.get(ring, F.lit(k)), F.get(ring, F.lit(k + 4)))
    corners = F.struct(*[end(f, k).alias(c) for c, (f, k) in zip(ENDS, ((F.least, 0), (F.least, 1), (F.greatest, 0), (F.greatest, 1)), strict=True)])
    box = G.is_box(F.col("geom")) & (G.box_area(ring) > 0)
    rows = df.filter(~G.is_empty(F.col("geom"))).select(*rest, "geom", F.inline(F.array(F.struct(box.alias("__q"), F.when(box, corners).alias("__b")))))
    b, q = F.col("__b"), F.col("__q")
    low = lambda k: F.floor(b[f"min{k}"] / cell).cast("int")
    high = lambda k: F.greatest(low(k), (F.ceil(b[f"max{k}"] / cell) - 1).cast("int"))
    none = F.lit(None).cast(f"struct<{','.join(f'{c}:double' for c in ENDS)}>")
    runs = F.transform(F.sequence(low("y"), high("y")), lambda j: F.struct(low("x").alias("first"), high("x").alias("last"), j.alias("cy"), none.alias("b"), F.lit(None).cast(G.RINGS).alias("geom")))
    others = cut_polygons(cell)(F.when(~q, F.col("geom")))
    rows = rows.select(*rest, q, b, F.when(q, runs).otherwise(others).alias("__cells"))
    count = F.aggregate("__cells", F.lit(0), lambda n, c: n + c["last"] - c["first"] + 1)
    # An outer generator, as for a plain one Spark asks Python once more whether there are cells at all.
    rows = rows.select(*rest, q, b, count.alias("cells"), F.inline_outer("__cells")).filter("cy IS NOT NULL")
    rows = rows.select(*rest, q, b, "cells", F.explode(F.sequence("first", "last")).alias("cx"), "cy", "b", "geom")
    x1, y1, x2, y2 = cell_box(cell, F.col("cx"), F.col("cy"))
    inside = F.struct(*[f(b[c], v).alias(c) for c, f, v in zip(ENDS, (F.greatest, F.greatest, F.least, F.least), (x1, y1, x2, y2), strict=True)])
    square = F.struct(*[v.alias(c) for c, v in zip(ENDS, (x1, y1, x2, y2), strict=True)])
    piece = F.when(q, inside).otherwise(F.coalesce("b", square))
    whole = F.when(q, (b["minx"] <= x1) & (b["miny"] <= y1) & (b["maxx"] >= x2) & (b["maxy"] >= y2)).otherwise(F.col("geom").isNull())
    return rows.select(*rest, "cells", "cx", "cy", whole.alias("whole"), piece.alias("b"), "geom")


def piece_of(geom: Column, b: Column) -> Column:
    return F.coalesce(geom, G.box(*[b[c] for c in ENDS]))


def cut_by(cell: float):
    """What two pieces of one cell share, snapped as the pieces are; null where either is."""
    grain = C.snap_of(cell)

    @F.pandas_udf(G.RINGS_TYPE)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else G.flat(K.intersection(G.rings_of(x), G.rings_of(y), grain)) for x, y in zip(a, b, strict=True)], dtype=object)

    return run


def shared(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """(l, r, cx, cy, part, area) of cut rows that have some of a cell in common, with the columns of both sides as structs.

    One equi-join on the cell, which Spark shuffles and splits where cells are hot. Two
    boxes are cut by built-in expressions, a piece in a whole cell stays as it is, and
    only two other pieces go to Python.
    """
    fixed = ("cells", "cx", "cy", "whole", "b", "geom")
    side = lambda df, s: df.select("cx", "cy", F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in fixed]).alias(s), F.col("whole").alias(f"{s}w"), F.col("b").alias(f"{s}b"), F.col("geom").alias(f"{s}g"))
    lb, rb, lg, rg = (F.col(c) for c in ("lb", "rb", "lg", "rg"))
    x1, y1 = (F.greatest(lb[c], rb[c]) for c in ENDS[:2])
    x2, y2 = (F.least(lb[c], rb[c]) for c in ENDS[2:])
    pairs = side(left, "l").join(side(right, "r"), ["cx", "cy"]).filter((x1 < x2) & (y1 < y2))
    boxes = lg.isNull() & rg.isNull()
    both = ~boxes & ~F.col("lw") & ~F.col("rw")
    cuts = cut_by(cell)(F.when(both, piece_of(lg, lb)), F.when(both, piece_of(rg, rb)))
    other = F.when(~boxes, F.when(both, cuts).otherwise(F.coalesce(lg, rg)))
    # As the output of a generator, what Python gives is read by all that follows and not asked for again.
    pairs = pairs.select("l", "r", "cx", "cy", *[v.alias(c) for c, v in zip(ENDS, (x1, y1, x2, y2), strict=True)], boxes.alias("boxes"), F.inline(F.array(F.struct(other.alias("other")))))
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    size = F.when(F.col("boxes"), (x2 - x1) * (y2 - y1)).otherwise(G.area(F.col("other")))
    return pairs.select("l", "r", "cx", "cy", F.coalesce("other", G.box(x1, y1, x2, y2)).alias("part"), size.alias("area")).filter("area > 0")


def overlapped(zones: DataFrame, features: DataFrame, cell: float) -> DataFrame:
    """(l, r, area) of rows that have some area in common, an area for each pair of boxes and for each cell of other pairs.

    Boxes meet boxes as they are, dealt to cells of their own size: cutting them would
    make a row of each of their cells. Other polygons are cut; which layers hold any is
    asked beforehand.
    """
    size = G.box_area(F.get("geom", F.lit(0)))
    box = G.is_box(F.col("geom")) & (size > 0)
    zones, features = (df.filter(~G.is_empty(F.col("geom")) & ~(G.is_box(F.col("geom")) & (size == 0))) for df in (zones, features))
    (zb, zo), (fb, fo) = ((df.filter(box), df.filter(~box)) for df in (zones, features))
    side = lambda df, s: F.struct(*[F.col(f"{s}.`{c}`").alias(c) for c in df.columns if c != "geom"]).alias(s)
    long = lambda k: F.least(F.col(f"lb.max{k}"), F.col(f"rb.max{k}")) - F.greatest(F.col(f"lb.min{k}"), F.col(f"rb.min{k}"))
    out = spatial_join(zb, fb, cell).filter((long("x") > 0) & (long("y") > 0)).select(side(zones, "l"), side(features, "r"), (long("x") * long("y")).alias("area"))
    for left, right, other in ((zones, fo, fo), (zo, fb, zo)):
        if other.agg(F.count("*")).first()[0]:  # a number; isEmpty would go through the tasks a few at a time
            out = out.unionByName(shared(cut(left, cell), cut(right, cell), cell).select("l", "r", "area"))
    return out


def allocate(zones: DataFrame, features: DataFrame, key: str, value: Column, cell: float) -> DataFrame:
    """(key, allocated): each value goes to zones by the share of its polygon's area inside.

    Values that are null, zero or not finite and polygons without area take no part.
    Zones that get nothing stay, with 0.
    """
    usable = features.withColumn("__value", value).withColumn("__full", G.area(F.col("geom"))).filter(F.col("__value").isNotNull() & (F.col("__full") > 0))
    shares = overlapped(zones.select(key, "geom"), usable.select("__value", "__full", "geom"), cell)
    sums = shares.groupBy(F.col(f"l.{key}").alias(key)).agg(F.sum(F.col("r.__value") * F.col("area") / F.col("r.__full")).alias("allocated"))
    return zones.select(key).join(sums, key, "left").select(key, F.coalesce("allocated", F.lit(0.0)).alias("allocated"))


def overlay_area(zones: DataFrame, features: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, intersect_area_ha); overlapping features count each."""
    parts = overlapped(zones.select(key, "geom"), features.select(F.lit(1).alias("n"), "geom"), cell)
    sums = parts.groupBy(F.col(f"l.{key}").alias(key)).agg((F.sum("area") / 1e4).alias("ha"))
    return zones.select(key).join(sums, key, "left").select(key, F.coalesce("ha", F.lit(0.0)).alias("intersect_area_ha"))


def line_length(line: Column) -> Column:
    at = F.sequence(F.lit(0), (F.size(line) / 2).cast("int") - 2)
    step = lambda i, k: F.get(line, 2 * i + 2 + k) - F.get(line, 2 * i + k)
    return F.aggregate(at, F.lit(0.0), lambda s, i: s + F.sqrt(step(i, 0) * step(i, 0) + step(i, 1) * step(i, 1)))


def overlay_length(zones: DataFrame, lines: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, intersect_length_km) of ``lines`` (geom: one array of alternating coordinates); what lies in whole cells is only measured."""
    pieces = lines.filter(F.size("geom") >= 4).select(F.inline(cut_lines(cell)(F.col("geom"))))
    pairs = cut(zones.select(key, "geom"), cell).join(pieces, ["cx", "cy"])
    within = G.length_within(F.when(~F.col("whole"), F.col("line")), F.when(~F.col("whole"), piece_of(F.col("geom"), F.col("b"))))
    sums = pairs.groupBy(key).agg((F.sum(F.when(F.col("whole"), line_length(F.col("line"))).otherwise(within)) / 1000).alias("km"))
    return zones.select(key).join(sums, key, "left").select(key, F.coalesce("km", F.lit(0.0)).alias("intersect_length_km"))


#: Geometries united at a time, and the tasks that a cell's pieces are dealt to first.
UNITED, SALTS = 256, 16
#: Cells to a side of the blocks whose outlines are united next.
WIDER = 8


def united_by(rows: DataFrame, keys: list[str], grain: float, least: str | None = None) -> DataFrame:
    """(keys, geom): one union per key, over rows sorted by key, UNITED of them at a time."""
    columns = keys + ([least] if least else [])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, some, low = None, [], None
        for part in parts:
            done, geoms = [], []
            for key, value, geom in zip(part[keys].itertuples(index=False, name=None), part[least] if least else part["geom"], part["geom"], strict=True):
                if key != at and some:
                    done.append((*at, low) if least else at)
                    geoms.append(outline(some))
                    some, low = [], None
                at = key
                low = (value if low is None else min(low, value)) if least else None
                some.append(G.rings_of(geom))
                if len(some) >= UNITED:
                    some = [K.union(some, grain)]
            yield made(done, geoms)
        if some:
            yield made([(*at, low) if least else at], [outline(some)])

    def outline(some: list) -> list:
        return G.flat(K.straightened(K.union(some, grain)))

    def made(done: list[tuple], geoms: list) -> pd.DataFrame:
        out = pd.DataFrame(done, columns=columns)
        out["geom"] = pd.Series(geoms, dtype=object)
        return out

    rows = rows.select(*columns, "geom")
    return rows.repartition(tasks_of(rows.sparkSession), *keys).sortWithinPartitions(*keys).mapInPandas(run, rows.schema)


def united_cells(rows: DataFrame, keys: list[str], grain: float, least: str | None = None) -> DataFrame:
    """One union per key of any number of pieces, those of a hot key in SALTS tasks first."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("geom"), F.lit(SALTS)))
    return united_by(united_by(salted, [*keys, "__salt"], grain, least), keys, grain, least)


def widened(rows: DataFrame, keys: list[str], grain: float, least: str | None = None) -> DataFrame:
    """(keys, geom) out of rows by (keys, cx, cy): blocks of cells are united, then all; seams vanish."""
    wide = rows.withColumn("cx", F.floor(F.col("cx") / WIDER).cast("int")).withColumn("cy", F.floor(F.col("cy") / WIDER).cast("int"))
    return united_by(united_by(wide, [*keys, "cx", "cy"], grain, least), keys, grain, least)


def dissolve(zones: DataFrame, features: DataFrame, key: str, cell: float, order: str = "fid", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, geom, first_fid): per zone the union of what features have inside it; zones without any go.

    ``carry`` names columns of ``zones`` that come along. Features that are equal count
    once, as do equal pieces in a cell, which add nothing to a union. One join gives the
    pieces, cell by cell. They are united in steps, each dealt out anew: those of a zone and cell in
    SALTS parts, then those of a zone and cell, of a block of cells, and of a zone. What
    a zone's last step reads is its blocks' outlines, not its pieces.
    """
    grain = C.snap_of(cell)
    unlike = features.groupBy("geom").agg(F.min(order).alias("first_fid"))
    pieces = shared(cut(zones.select(key, "geom"), cell), cut(unlike, cell), cell)
    pieces = pieces.groupBy(F.col(f"l.{key}").alias(key), "cx", "cy", F.col("part").alias("geom")).agg(F.min("r.first_fid").alias("first_fid"))
    out = widened(united_cells(pieces, [key, "cx", "cy"], grain, "first_fid"), [key], grain, "first_fid")
    return (out.join(zones.select(key, *carry), key) if carry else out).select(key, "geom", "first_fid", *carry)


CLEAN = "geom array<array<double>>, reason string"


def cleaned(tolerance: float):
    """Each polygon repaired and thinned, or the reason why that can't be done; null stays null."""

    @F.pandas_udf(CLEAN)
    def run(geom: pd.Series) -> pd.DataFrame:
        out = []
        for g in geom:
            try:
                rings = [] if g is None else K.mended(G.rings_of(g))
                out.append((G.flat(K.simplify(rings, tolerance)), None) if rings else (None, None if g is None else "no polygon is left after repair"))
            except Exception as error:  # one bad feature is a row of its own, not the end of the job
                out.append((None, f"{type(error).__name__}: {error}"))
        return pd.DataFrame({"geom": pd.Series([g for g, _ in out], dtype=object), "reason": pd.Series([r for _, r in out], dtype=object)})

    return run


def filled_box(parts) -> list | None:
    """The box that boxes without common area, as those of different cells are, fill together; None if they don't."""
    if not all(len(p) == 1 and len(p[0]) == 10 for p in parts):
        return None
    q = np.array([p[0] for p in parts], float)
    turn = (q[:, [0, 1, 2, 5]] == q[:, [6, 3, 4, 7]]).all() or (q[:, [1, 0, 3, 4]] == q[:, [7, 2, 5, 6]]).all()
    low, high = np.minimum(q[:, :2], q[:, 4:6]), np.maximum(q[:, :2], q[:, 4:6])
    (x1, y1), (x2, y2) = low.min(axis=0).tolist(), high.max(axis=0).tolist()
    size = (x2 - x1) * (y2 - y1)
    if not turn or (q[:, :2] != q[:, 8:]).any() or size <= 0 or abs((high - low).prod(axis=1).sum() - size) > 1e-12 * size:
        return None
    return [[x1, y1, x2, y1, x2, y2, x1, y2, x1, y1]]


def joined_parts(cell: float):
    """The union of the parts of one feature in its cells, or the reason why there is none."""
    grain = C.snap_of(cell)

    @F.pandas_udf(CLEAN)
    def run(parts: pd.Series) -> pd.DataFrame:
        out = []
        for p in parts:
            try:
                if p is None or (len(p) == 1 and len(p[0]) == 1 and not p[0][0].any()):  # nothing, or a point that stands in for it
                    out.append((None if p is None else [], None))
                else:
                    box = filled_box(p)
                    out.append((box if box else G.flat(K.straightened(K.union([G.rings_of(x) for x in p], grain))), None))
            except Exception as error:
                out.append((None, f"{type(error).__name__}: {error}"))
        return pd.DataFrame({"geom": pd.Series([g for g, _ in out], dtype=object), "reason": pd.Series([r for _, r in out], dtype=object)})

    return run


def readable(geom: Column) -> Column:
    """Whether every ring is pairs of finite coordinates, four or more of them."""
    return F.forall(geom, lambda r: F.coalesce(r.isNotNull() & (F.size(r) % 2 == 0) & (F.size(r) >= 8) & F.forall(r, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))), F.lit(False)))


def boundary_cells(boundary: DataFrame, cell: float) -> DataFrame:
    """(cx, cy, geom): what the rows of a boundary, repaired, have of each cell together; null for a whole cell.

    Only cells of several pieces, none of them whole, are united.
    """
    place = ["cx", "cy"]
    pieces = staged(cut(boundary.select(G.repaired(F.col("geom")).alias("geom")), cell).select(*place, "whole", piece_of(F.col("geom"), F.col("b")).alias("geom")), "boundary-cells")
    told = pieces.groupBy(*place).agg(F.count_if("whole").alias("whole"), F.count("*").alias("n"), F.max("geom").alias("geom"))
    done = told.filter("whole > 0 OR n = 1").select(*place, F.when(F.col("whole") == 0, F.col("geom")).alias("geom"))
    several = pieces.join(told.filter("whole = 0 AND n > 1").select(*place), place, "left_semi").drop("whole")
    united = united_cells(several, place, C.snap_of(cell))
    return done.unionByName(united.select(*place, F.when(G.area(F.col("geom")) < cell * cell * (1 - 1e-12), F.col("geom")).alias("geom")))


def clip(features: DataFrame, boundary: DataFrame, tolerance: float = 15.0, cell: float = 50_000.0) -> DataFrame:
    """All columns of ``features``, ``geom`` cut to the union of all rows of the boundary, ``status`` and ``reason``.

    Features are repaired and thinned and written once, with an id. Their cells meet those
    of the boundary, whose rows are united cell by cell; a feature all of whose cells are
    whole ones of the boundary stays as it is, and the parts of others are united by
    feature. So a boundary of any size is never in one task or row.

    Status: empty, outside (of the box around the whole boundary), no_area, ok, or error
    with the reason, for a geometry that can't be read, mended or cut; no feature ends the
    job. Rows that repeat each other are features of their own.
    """
    g = F.col("row.geom")
    rows = features.select(F.struct(*[F.col(f"`{c}`") for c in features.columns]).alias("row"), F.monotonically_increasing_id().alias("id"))
    rows = rows.withColumn("bad", ~G.is_empty(g) & ~F.coalesce(readable(g), F.lit(False)))
    box = G.is_box(g) & (G.box_area(F.get(g, F.lit(0))) > 0)
    made = cleaned(tolerance)(F.when(~F.col("bad") & ~G.is_empty(g) & ~box, g))
    unread = F.lit("a ring is not four or more pairs of finite coordinates")
    rows = rows.select("row", "id", "bad", F.when(~F.col("bad") & box, F.struct(g.alias("geom"), F.lit(None).cast("string").alias("reason"))).otherwise(made).alias("clean"))
    rows = staged(rows.select("row", "id", F.col("clean.geom").alias("geom"), F.when(F.col("bad"), unread).otherwise(F.col("clean.reason")).alias("reason")), "clip")
    edge = boundary_cells(boundary, cell).select("cx", "cy", F.col("geom").alias("edge"), F.lit(True).alias("met"))
    ends = boundary.filter(~G.is_empty(F.col("geom"))).select(G.bounds(F.col("geom")).alias("b"))
    ends = ends.agg(F.min("b.minx").alias("minx"), F.min("b.miny").alias("miny"), F.max("b.maxx").alias("maxx"), F.max("b.maxy").alias("maxy"))  # one row
    pairs = cut(rows.select("id", "geom"), cell).join(edge, ["cx", "cy"])
    piece = piece_of(F.col("geom"), F.col("b"))
    both = ~F.col("whole") & F.col("edge").isNotNull()
    part = F.when(both, cut_by(cell)(F.when(both, piece), F.when(both, F.col("edge")))).when(F.col("edge").isNull(), piece).otherwise(F.col("edge"))
    pairs = pairs.select("id", "cells", F.col("edge").isNull().alias("whole"), part.alias("part"))
    # A feature's parts are no more than the feature and the boundary have in its own cells.
    parts = pairs.groupBy("id").agg((F.count_if("whole") == F.first("cells")).alias("inside"), F.collect_list("part").alias("parts"))
    # A point stands in for what need not be united: a batch of nothing but nulls at this depth is not read back from Arrow.
    point = F.array(F.array(F.array_repeat(F.lit(0.0), 8)))
    parts = parts.select("id", "inside", joined_parts(cell)(F.when(~F.col("inside"), F.col("parts")).otherwise(point)).alias("cut"))
    parts = parts.select("id", "inside", F.col("cut.geom").alias("part"), F.col("cut.reason").alias("failed"))
    out = rows.join(parts, "id", "left").crossJoin(F.broadcast(ends))
    kept = F.when(F.col("inside"), F.col("geom")).otherwise(F.col("part"))
    reason = F.coalesce("reason", "failed")
    b = G.bounds(g)
    beyond = F.coalesce((b["maxx"] < F.col("minx")) | (b["minx"] > F.col("maxx")) | (b["maxy"] < F.col("miny")) | (b["miny"] > F.col("maxy")), F.lit(True))
    status = F.when(reason.isNotNull(), "error").when(G.is_empty(g), "empty").when(beyond, "outside").when(G.area(kept) > 0, "ok").otherwise("no_area")
    out = out.select("row", kept.alias("kept"), status.alias("status"), reason.alias("reason"))
    plain = [F.col("row").getField(c).alias(c) for c in features.columns if c not in ("geom", "status", "reason")]
    return out.select(*plain, F.when(F.col("status") == "ok", F.col("kept")).alias("geom"), "status", "reason")


def counted(clipped: DataFrame) -> DataFrame:
    """(status, n): the counters of a clip."""
    return clipped.groupBy("status").agg(F.count("*").alias("n"))


def boundary_union(boundary: DataFrame, cell: float) -> DataFrame:
    """(geom): the union of all rows, repaired, cell by cell, then by blocks of cells. It is an error if nothing is left."""
    x1, y1, x2, y2 = cell_box(cell, F.col("cx"), F.col("cy"))
    cells = boundary_cells(boundary, cell).select(F.lit(0).alias("zone"), "cx", "cy", F.coalesce("geom", G.box(x1, y1, x2, y2)).alias("geom"))
    out = staged(widened(cells, ["zone"], C.snap_of(cell)).select("geom"), "boundary")
    if out.isEmpty():
        raise ValueError("the boundary has no polygon")
    return out
