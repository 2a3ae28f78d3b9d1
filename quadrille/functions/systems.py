"""Reference systems by their parameters: map projections as column expressions, and definitions as layers store them."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ellipsoids (axis in metres, inverse flattening) and coefficients of the Krueger series in the third flattening; fixed values.
WGS84, GRS80 = (6378137.0, 298.257223563), (6378137.0, 298.257222101)
TO_PLANE = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
FROM_PLANE = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
#: Rounds from isometric to geodetic latitude, each worth more than two digits.
ROUNDS = 7


def series(rows: tuple, n: float) -> list[float]:
    return [sum(c * n ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1)]


def let(*values: Column, then) -> Column:
    """``then`` of values that are evaluated once each, however often it uses them."""
    named = F.struct(*[v.alias(f"v{k}") for k, v in enumerate(values)])
    return F.element_at(F.transform(F.array(named), lambda s: then(*[s[f"v{k}"] for k in range(len(values))])), 1)


@dataclass(frozen=True)
class System:
    """``kind``: longlat, tmerc, lcc or albers. Angles in degrees; ``unit`` is metres to a unit of x and y."""

    kind: str
    axis: float
    inverse_flattening: float
    lat0: float = 0.0
    lon0: float = 0.0
    sp1: float = 0.0
    sp2: float = 0.0
    scale: float = 1.0
    east: float = 0.0
    north: float = 0.0
    unit: float = 1.0

    @property
    def flattening(self) -> float:
        return 1 / self.inverse_flattening if self.inverse_flattening else 0.0

    @property
    def e2(self) -> float:
        return self.flattening * (2 - self.flattening)

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    @property
    def projected(self) -> bool:
        return self.kind != "longlat"

    def metric(self) -> bool:
        return self.projected and abs(self.unit - 1) < 1e-9

    def isometric(self, s: float) -> float:
        """Isometric latitude out of a latitude's sine."""
        return math.atanh(s) - self.e * math.atanh(self.e * s)

    def isometric_of(self, lat: Column) -> Column:
        return let(F.sin(F.radians(lat)), then=lambda s: F.atanh(s) - self.e * F.atanh(self.e * s))

    def latitude_of(self, iso: Column) -> Column:
        """Degrees of an isometric latitude."""

        def rounds(iso: Column) -> Column:
            s = F.tanh(iso)
            for _ in range(ROUNDS):
                s = F.tanh(iso + self.e * F.atanh(self.e * s))
            return F.degrees(F.asin(s))

        return let(iso, then=rounds)

    def turned(self, lon: Column) -> Column:
        """Radians from the central meridian, the short way."""
        off = lon - self.lon0
        return F.radians(off - 360 * F.floor((off + 180) / 360))

    def forward(self, lon: Column, lat: Column) -> Column:
        """Degrees to an array of x and y."""
        if not self.projected:
            return F.array(lon, lat)
        return let(lon, lat, then=lambda a, b: let(getattr(self, f"_{self.kind}")(a, b), then=lambda p: F.array(p[0] / self.unit + self.east, p[1] / self.unit + self.north)))

    def inverse(self, x: Column, y: Column) -> Column:
        """x and y to an array of degrees."""
        if not self.projected:
            return F.array(x, y)
        return let((x - self.east) * self.unit, (y - self.north) * self.unit, then=getattr(self, f"_{self.kind}_inverse"))

    # Transverse Mercator: the sphere's formulas on conformal latitudes, corrected by a series.
    @property
    def _rectifying(self) -> tuple[float, float]:
        n = self.flattening / (2 - self.flattening)
        return n, self.axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)

    def _origin(self) -> float:
        """The arc of the central meridian up to the latitude of origin."""
        n, radius = self._rectifying
        x = math.atan(math.sinh(self.isometric(math.sin(math.radians(self.lat0)))))
        return radius * (x + sum(c * math.sin(2 * j * x) for j, c in enumerate(series(TO_PLANE, n), 1)))

    def _tmerc(self, lon: Column, lat: Column) -> Column:
        n, radius = self._rectifying

        def corrected(up: Column, side: Column) -> Column:
            y, x = up, side
            for j, c in enumerate(series(TO_PLANE, n), 1):
                y, x = y + c * F.sin(2 * j * up) * F.cosh(2 * j * side), x + c * F.cos(2 * j * up) * F.sinh(2 * j * side)
            return F.array(self.scale * radius * x, self.scale * (radius * y - self._origin()))

        sphere = lambda t, d: let(F.atan2(t, F.cos(d)), F.asinh(F.sin(d) / F.sqrt(t * t + F.cos(d) * F.cos(d))), then=corrected)
        return let(F.sinh(self.isometric_of(lat)), self.turned(lon), then=sphere)

    def _tmerc_inverse(self, x: Column, y: Column) -> Column:
        n, radius = self._rectifying

        def corrected(up: Column, side: Column) -> Column:
            a, b = up, side
            for j, c in enumerate(series(FROM_PLANE, n), 1):
                a, b = a - c * F.sin(2 * j * up) * F.cosh(2 * j * side), b - c * F.cos(2 * j * up) * F.sinh(2 * j * side)
            return let(a, b, then=lambda a, b: F.array(self.lon0 + F.degrees(F.atan2(F.sinh(b), F.cos(a))), self.latitude_of(F.atanh(F.sin(a) / F.cosh(b)))))

        return let((y / self.scale + self._origin()) / radius, x / self.scale / radius, then=corrected)

    # Conformal conic.
    @property
    def _cone(self) -> tuple[float, float, float]:
        s1, s2 = (math.sin(math.radians(v)) for v in (self.sp1, self.sp2))
        m1, m2 = (math.sqrt((1 - s * s) / (1 - self.e2 * s * s)) for s in (s1, s2))
        i1, i2 = self.isometric(s1), self.isometric(s2)
        n = s1 if s1 == s2 else (math.log(m1) - math.log(m2)) / (i2 - i1)
        size = self.axis * m1 * math.exp(n * i1) / n * self.scale
        return n, size, size * math.exp(-n * self.isometric(math.sin(math.radians(self.lat0))))

    def _lcc(self, lon: Column, lat: Column) -> Column:
        n, size, rho0 = self._cone
        return let(size * F.exp(-n * self.isometric_of(lat)), n * self.turned(lon), then=lambda rho, theta: F.array(rho * F.sin(theta), rho0 - rho * F.cos(theta)))

    def _lcc_inverse(self, x: Column, y: Column) -> Column:
        n, size, rho0 = self._cone
        way = 1.0 if n > 0 else -1.0
        rho = F.sqrt(x * x + (rho0 - y) * (rho0 - y))
        theta = F.atan2(way * x, way * (rho0 - y))
        return F.array(self.lon0 + F.degrees(theta / n), self.latitude_of(-F.log(rho / abs(size)) / n))

    # Equal-area conic.
    def _q(self, s: float) -> float:
        return (1 - self.e2) * (s / (1 - self.e2 * s * s) + math.atanh(self.e * s) / self.e)

    @property
    def _equal(self) -> tuple[float, float, float]:
        s1, s2 = (math.sin(math.radians(v)) for v in (self.sp1, self.sp2))
        m1, m2 = ((1 - s * s) / (1 - self.e2 * s * s) for s in (s1, s2))
        n = s1 if s1 == s2 else (m1 - m2) / (self._q(s2) - self._q(s1))
        c = m1 + n * self._q(s1)
        return n, c, self.axis * math.sqrt(c - n * self._q(math.sin(math.radians(self.lat0)))) / n

    def _albers(self, lon: Column, lat: Column) -> Column:
        n, c, rho0 = self._equal
        q = let(F.sin(F.radians(lat)), then=lambda s: (1 - self.e2) * (s / (1 - self.e2 * s * s) + F.atanh(self.e * s) / self.e))
        return let(self.axis * F.sqrt(c - n * q) / n, n * self.turned(lon), then=lambda rho, theta: F.array(rho * F.sin(theta), rho0 - rho * F.cos(theta)))

    def _albers_inverse(self, x: Column, y: Column) -> Column:
        n, c, rho0 = self._equal
        way = 1.0 if n > 0 else -1.0
        rho = F.sqrt(x * x + (rho0 - y) * (rho0 - y))
        lon = self.lon0 + F.degrees(F.atan2(way * x, way * (rho0 - y)) / n)
        e2 = self.e2
        more = lambda b: (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * b) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * b) + (761 * e2**3 / 45360) * F.sin(6 * b)
        beta = let(rho, then=lambda r: F.asin((c - (r * n / self.axis) * (r * n / self.axis)) / n / self._q(1.0)))
        return F.array(lon, let(beta, then=lambda b: F.degrees(b + more(b))))


#: Systems by number: degrees on both ellipsoids, and equal area for the conterminous states.
NUMBERED = {4326: System("longlat", *WGS84), 4269: System("longlat", *GRS80), 5070: System("albers", *GRS80, 23.0, -96.0, 29.5, 45.5)}


def system(srid: int) -> System:
    """A system by its number: NUMBERED, and the zones of transverse Mercator by their rule."""
    if srid in NUMBERED:
        return NUMBERED[srid]
    for first, ellipsoid, north in ((32600, WGS84, 0.0), (32700, WGS84, 10_000_000.0), (26900, GRS80, 0.0)):
        if first < srid <= first + (60 if ellipsoid == WGS84 else 23):
            return System("tmerc", *ellipsoid, 0.0, 6.0 * (srid - first) - 183, scale=0.9996, east=500_000.0, north=north)
    raise ValueError(f"no parameters for the reference system {srid}")


#: What definitions call the projections and their parameters, without case, blanks and underscores; fixed values.
KINDS = {"transversemercator": "tmerc", "lambertconformalconic2sp": "lcc", "lambertconicconformal(2sp)": "lcc", "lambertconformalconic": "lcc", "lambertconformalconic1sp": "lcc", "lambertconicconformal(1sp)": "lcc", "albersconicequalarea": "albers", "albersequalarea": "albers", "albers": "albers"}
FIELDS = {
    "lat0": ("latitudeoforigin", "latitudeofcenter", "latitudeofnaturalorigin", "latitudeoffalseorigin"), "lon0": ("centralmeridian", "longitudeofcenter", "longitudeofnaturalorigin", "longitudeoffalseorigin", "longitudeoforigin"),
    "sp1": ("standardparallel1", "latitudeof1ststandardparallel"), "sp2": ("standardparallel2", "latitudeof2ndstandardparallel"), "scale": ("scalefactor", "scalefactoratnaturalorigin"),
    "east": ("falseeasting", "eastingatfalseorigin"), "north": ("falsenorthing", "northingatfalseorigin"),
}


def defined(text: str) -> System:
    """A system out of its definition in well-known text, of either version, with angles in degrees."""
    plain = lambda s: re.sub(r"[\s_]", "", s).lower()
    ball = re.search(r'(?:SPHEROID|ELLIPSOID)\["[^"]*",\s*([-\d.eE+]+)\s*,\s*([-\d.eE+]+)', text)
    if not ball:
        raise ValueError("a reference system without an ellipsoid")
    axis, inverse = map(float, ball.groups())
    name = re.search(r'(?:PROJECTION|METHOD)\["([^"]*)"', text)
    if not name:
        return System("longlat", axis, inverse)
    kind = KINDS.get(plain(name[1]))
    if kind is None:
        raise ValueError(f"no projection {name[1]}")
    told = {plain(k): float(v) for k, v in re.findall(r'PARAMETER\["([^"]*)",\s*([-\d.eE+]+)', text)}
    values = {f: told[n] for f, names in FIELDS.items() for n in names if n in told}
    if kind == "lcc" and "sp1" not in values:
        values["sp1"] = values.get("lat0", 0.0)
    values.setdefault("sp2", values.get("sp1", 0.0))
    # The last length that is not a parameter's own: that of the axes.
    units = [float(u) for u in re.findall(r'(?<!ANGLE)(?:LENGTH)?UNIT\["(?![^"]*[dD]egree)[^"]*",\s*([-\d.eE+]+)', text)]
    unit = units[-1] if units else 1.0
    return System(kind, axis, inverse, **values, unit=unit)
