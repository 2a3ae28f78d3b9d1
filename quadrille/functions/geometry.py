"""Geometry columns and functions.

A polygon column is ``array<array<double>>``: closed rings of alternating x and y,
outer rings counter-clockwise, holes clockwise. Measures, boxes and projections are
built-in expressions; only overlay, repair and thinning run as Arrow UDFs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, StringType, StructField, StructType

from quadrille.functions.systems import GRS80, WGS84, System, let
from quadrille.functions.systems import system as numbered_system
from quadrille.kernel import geodesic as D
from quadrille.kernel import overlay as K
from quadrille.kernel import wkb

RINGS = "array<array<double>>"
RINGS_TYPE = ArrayType(ArrayType(DoubleType()))


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.array(F.array(*[c.cast("double") for c in (x1, y1, x2, y1, x2, y2, x1, y2, x1, y1)]))


def ring_area(r: Column) -> Column:
    """Signed; relative to the first vertex, so that large coordinates don't cancel."""
    x0, y0 = r[0], r[1]
    at = F.sequence(F.lit(1), (F.size(r) / 2).cast("int") - 2)
    term = lambda i: (F.get(r, 2 * i) - x0) * (F.get(r, 2 * i + 3) - y0) - (F.get(r, 2 * i + 2) - x0) * (F.get(r, 2 * i + 1) - y0)
    return F.when(F.size(r) >= 8, F.aggregate(at, F.lit(0.0), lambda a, i: a + term(i)) / 2).otherwise(0.0)


def area(geom: Column) -> Column:
    """Planar area; 0 for null or empty."""
    return F.when(is_box(geom), box_area(F.get(geom, F.lit(0)))).otherwise(rings_area(geom))


def box_area(r: Column) -> Column:
    """``ring_area`` of a box: the product of its first two sides, without a loop over its corners."""
    at = lambda k: F.get(r, F.lit(k))
    return (at(2) - at(0)) * (at(5) - at(3)) - (at(4) - at(2)) * (at(3) - at(1))


def rings_area(geom: Column) -> Column:
    return F.coalesce(F.aggregate(geom, F.lit(0.0), lambda a, r: a + ring_area(r)), F.lit(0.0))


def is_empty(geom: Column) -> Column:
    return geom.isNull() | (F.size(geom) == 0)


def n_points(geom: Column) -> Column:
    return F.coalesce(F.aggregate(geom, F.lit(0).cast("long"), lambda a, r: a + (F.size(r) / 2).cast("long")), F.lit(0).cast("long"))


def bounds(geom: Column) -> Column:
    """struct<minx, miny, maxx, maxy>; of a box out of two of its corners."""
    ring = F.get(geom, F.lit(0))
    two = lambda f, k: f(F.get(ring, F.lit(k)), F.get(ring, F.lit(k + 4)))
    box = F.struct(two(F.least, 0).alias("minx"), two(F.least, 1).alias("miny"), two(F.greatest, 0).alias("maxx"), two(F.greatest, 1).alias("maxy"))
    flat = F.flatten(geom)
    xs, ys = F.filter(flat, lambda v, i: i % 2 == 0), F.filter(flat, lambda v, i: i % 2 == 1)
    return F.when(is_box(geom), box).otherwise(F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")))


def is_box(geom: Column) -> Column:
    """One ring of four axis-parallel sides."""
    r = F.get(geom, F.lit(0))
    same = lambda i, j: F.get(r, F.lit(i)) == F.get(r, F.lit(j))
    turns = (same(0, 6) & same(1, 3) & same(2, 4) & same(5, 7)) | (same(1, 7) & same(0, 2) & same(3, 5) & same(4, 6))
    return F.coalesce((F.size(geom) == 1) & (F.size(r) == 10) & turns, F.lit(False))


def map_points(geom: Column, to) -> Column:
    """``to(x, y)`` gives an array of the two new coordinates."""
    at = lambda r: F.sequence(F.lit(0), (F.size(r) / 2).cast("int") - 1)
    return F.transform(geom, lambda r: F.flatten(F.transform(at(r), lambda i: to(F.get(r, 2 * i), F.get(r, 2 * i + 1)))))


# The ellipsoid GRS 1980 and the parameters of EPSG:5070; fixed values.
A, F_INV = 6378137.0, 298.257222101
LAT0, LON0, SP1, SP2 = 23.0, -96.0, 29.5, 45.5
E2 = 2 / F_INV - 1 / F_INV**2
E = math.sqrt(E2)


def _q(sin: float) -> float:
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - math.log((1 - E * sin) / (1 + E * sin)) / (2 * E))


def _m2(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return (1 - s * s) / (1 - E2 * s * s)


_Q = {lat: _q(math.sin(math.radians(lat))) for lat in (LAT0, SP1, SP2)}
CONE = (_m2(SP1) - _m2(SP2)) / (_Q[SP2] - _Q[SP1])
CONST = _m2(SP1) + CONE * _Q[SP1]
RHO0 = A * math.sqrt(CONST - CONE * _Q[LAT0]) / CONE
Q_POLE = _q(1.0)


def authalic_q(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E * s) / (1 + E * s)) / (2 * E))


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to EPSG:5070."""
    rho = A * F.sqrt(CONST - CONE * authalic_q(lat)) / CONE
    theta = CONE * F.radians(lon - LON0)
    return rho * F.sin(theta), RHO0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    rho = F.sqrt(x * x + (RHO0 - y) * (RHO0 - y))
    lon = LON0 + F.degrees(F.atan2(x, RHO0 - y)) / CONE
    beta = F.asin((CONST - (rho * CONE / A) * (rho * CONE / A)) / CONE / Q_POLE)
    # The series from authalic to geodetic latitude.
    series = (E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040) * F.sin(2 * beta) + (23 * E2**2 / 360 + 251 * E2**3 / 3780) * F.sin(4 * beta) + (761 * E2**3 / 45360) * F.sin(6 * beta)
    return lon, F.degrees(beta + series)


def geodesic_area(geom: Column, ellipsoid: tuple[float, float] = WGS84) -> Column:
    """Area in m² of a polygon in degrees whose edges are shortest lines on an ellipsoid (axis, inverse flattening); 0 for null."""
    axis, inverse = ellipsoid

    @F.pandas_udf(DoubleType())
    def run(g: pd.Series) -> pd.Series:
        return pd.Series([0.0 if x is None else abs(D.area(rings_of(x), axis, 1 / inverse)) for x in g], dtype="float64")

    return run(geom)


def area_ha(geom: Column, srid: Column) -> Column:
    """Hectares: planar in EPSG:5070, on the ellipsoid for longitude and latitude; any other or no system is an error."""
    degrees = F.when(srid == 4326, geodesic_area(F.when(srid == 4326, geom))).when(srid == 4269, geodesic_area(F.when(srid == 4269, geom), GRS80))
    known = F.when(srid == 5070, F.abs(area(geom)) / 1e4).when(srid.isin(4326, 4269), degrees / 1e4)
    return known.otherwise(F.raise_error(F.concat(F.lit("no area in the reference system "), F.coalesce(srid.cast("string"), F.lit("(none)")))).cast("double"))


def area_ha_in(geom: Column, system: System) -> Column:
    """Hectares in any system with parameters: planar with its unit squared if it is projected, else on its ellipsoid."""
    if system.projected:
        return F.abs(area(geom)) * (system.unit * system.unit / 1e4)
    return geodesic_area(geom, (system.axis, system.inverse_flattening)) / 1e4


def reprojected(geom: Column, srid: int | System, to: int | System) -> Column:
    """Polygons from one system to another, by number or parameters, through longitude and latitude.

    The same system is left alone, null stays null. Systems on ellipsoids of other
    shapes are not the same ground, so without a shift between them that is an error.
    """
    a, b = (x if isinstance(x, System) else system_of(x, srid, to) for x in (srid, to))
    if a == b or not (a.projected or b.projected):
        return geom
    if abs(a.axis - b.axis) > 1 or abs(a.inverse_flattening - b.inverse_flattening) > 1e-3:
        raise ValueError(f"no way between the ellipsoids of {srid} and {to}")
    return map_points(geom, lambda x, y: let(a.inverse(x, y), then=lambda p: b.forward(p[0], p[1])))


def system_of(number: int, srid, to) -> System:
    try:
        return numbered_system(number)
    except ValueError as error:
        raise ValueError(f"no way from the reference system {srid} to {to}: {error}") from None


def processing_system(srid: int | None, metres_per_unit: float | None = None) -> int:
    """The system to work in: the source's own if it is projected in metres, else EPSG:5070."""
    if srid is None:
        raise ValueError("the layer has no reference system")
    return srid if metres_per_unit is not None and abs(metres_per_unit - 1) < 1e-9 else 5070


def exploded(df) -> object:
    """Multi-part polygons as one row per outer ring, each with the holes inside it; column ``part`` counts them."""
    return df.select("*", F.posexplode(parts(F.col("geom"))).alias("part", "__geom")).withColumn("geom", F.col("__geom")).drop("__geom")


@F.pandas_udf(ArrayType(RINGS_TYPE))
def parts(geom: pd.Series) -> pd.Series:
    return pd.Series([[] if g is None else [flat(p) for p in wkb.polygons_of(rings_of(g))] for g in geom], dtype=object)


def rings_of(value) -> K.Rings:
    return [np.asarray(r, float).reshape(-1, 2) for r in value]


def flat(rings: K.Rings) -> list[np.ndarray]:
    return [r.ravel() for r in rings]


def nested(rows: list[list[np.ndarray] | None]) -> pa.Array:
    """Rows of rings as an Arrow column."""
    rings = [r for row in rows if row for r in row]
    ends = lambda sizes: np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    inner = pa.ListArray.from_arrays(pa.array(ends([len(r) for r in rings])), pa.array(np.concatenate(rings) if rings else np.empty(0)))
    return pa.ListArray.from_arrays(pa.array(ends([len(row) if row else 0 for row in rows])), inner, mask=pa.array([row is None for row in rows], pa.bool_()))


def unnested(geom: pa.Array) -> list[list[np.ndarray] | None]:
    """Rows of rings out of an Arrow column."""
    inner = geom.values
    if inner.null_count or inner.values.null_count:
        return [None if row is None else [np.asarray(r, float) for r in row] for row in geom.to_pylist()]
    values, at = inner.values.to_numpy(), inner.offsets.to_pylist()
    first, last = geom.offsets.to_pylist()[:-1], geom.offsets.to_pylist()[1:]
    return [[values[at[i] : at[i + 1]] for i in range(a, b)] if there else None for a, b, there in zip(first, last, geom.is_valid().to_pylist(), strict=True)]


@F.pandas_udf(RINGS_TYPE)
def intersection(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else flat(K.intersection(rings_of(x), rings_of(y))) for x, y in zip(a, b, strict=True)], dtype=object)


@F.pandas_udf(BooleanType())
def intersects(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([x is not None and y is not None and K.intersects(rings_of(x), rings_of(y)) for x, y in zip(a, b, strict=True)], dtype=bool)


@F.pandas_udf(RINGS_TYPE)
def repaired(geom: pd.Series) -> pd.Series:
    """Valid polygons stay; see ``overlay.mended`` for others. Null where nothing is left."""
    return pd.Series([None if g is None or not (r := K.mended(rings_of(g))) else flat(r) for g in geom], dtype=object)


@F.pandas_udf(StructType([StructField("geom", RINGS_TYPE), StructField("rung", StringType()), StructField("defect", StringType())]))
def repair_of(geom: pd.Series) -> pd.DataFrame:
    """The repaired polygon, the rung of the ladder that it comes from, and what was wrong; all null for null."""
    made = [(None, None, None) if g is None else K.mended_by(rings_of(g)) for g in geom]
    return pd.DataFrame({"geom": pd.Series([flat(r) if r else None for r, _, _ in made], dtype=object), "rung": pd.Series([x for _, x, _ in made], dtype=object), "defect": pd.Series([x for _, _, x in made], dtype=object)})


def simplified(geom: Column, tolerance: float, preserve: bool = True) -> Column:
    @F.pandas_udf(RINGS_TYPE)
    def run(g: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else flat(K.simplify(rings_of(x), tolerance, preserve)) for x in g], dtype=object)

    return run(geom)


@F.pandas_udf(DoubleType())
def difference_area(a: pd.Series, b: pd.Series) -> pd.Series:
    """Area of the symmetric difference; null where either is null."""
    return pd.Series([None if x is None or y is None else K.difference_area(rings_of(x), rings_of(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def length_within(line: pd.Series, geom: pd.Series) -> pd.Series:
    return pd.Series([0.0 if x is None or g is None else K.length_within(np.asarray(x, float).reshape(-1, 2), rings_of(g)) for x, g in zip(line, geom, strict=True)], dtype="float64")


@F.arrow_udf(RINGS_TYPE)
def from_wkb(data: pa.Array) -> pa.Array:
    """The polygonal content, oriented; null for null."""
    return nested(wkb.decoded(data.to_pylist()))


@F.pandas_udf(RINGS_TYPE)
def lines_from_wkb(data: pd.Series) -> pd.Series:
    """The lines of any geometry, each an array of alternating coordinates; null for null."""
    return pd.Series([None if x is None else flat(wkb.lines(bytes(x))) for x in data], dtype=object)


@F.arrow_udf(BinaryType())
def to_wkb(geom: pa.Array) -> pa.Array:
    return pa.array(wkb.encoded(unnested(geom))[0], pa.binary())
