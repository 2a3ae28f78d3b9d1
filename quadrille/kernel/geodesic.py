"""Area between geodesics and the equator on an ellipsoid, for many edges at once.

An edge is a great circle on the auxiliary sphere of reduced latitudes; its longitude and
the area under it differ from the sphere's by integrals of smooth functions of the arc,
which Gauss-Legendre sums give to the last digits (Karney, Algorithms for geodesics, 2013).
"""

from __future__ import annotations

import math

import numpy as np

#: Nodes for any edge, and for one of at most SHORT degrees either way, over which the rest is below 1e-24.
MANY, FEW, SHORT = np.polynomial.legendre.leggauss(24), np.polynomial.legendre.leggauss(4), 0.5
#: Rounds of the longitude iteration; each gains about three digits, fewer for edges that span nearly half the globe.
ROUNDS = 60


def integral(f, a: np.ndarray, b: np.ndarray, rule: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    half, mid = (b - a) / 2, (a + b) / 2
    return half * (f(mid[:, None] + half[:, None] * rule[0]) @ rule[1])


def authalic_square(a: float, f: float) -> float:
    """The squared radius of the sphere with the ellipsoid's area."""
    b, e2 = a * (1 - f), f * (2 - f)
    if not f:
        return a * a
    e = math.sqrt(abs(e2))
    return (a * a + b * b * (math.atanh(e) if e2 > 0 else math.atan(e)) / e) / 2


def area_under(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray, a: float, f: float) -> np.ndarray:
    """Signed areas (eastward counts as plus) between the shortest lines of pairs of points, in degrees, and the equator."""
    short = (np.abs((lon2 - lon1 + 180) % 360 - 180) <= SHORT) & (np.abs(lat2 - lat1) <= SHORT)
    out = np.empty(len(lon1))
    for some, rule in ((short, FEW), (~short, MANY)):
        if some.any():
            out[some] = areas_by(lon1[some], lat1[some], lon2[some], lat2[some], a, f, rule)
    return out


def areas_by(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray, a: float, f: float, rule: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    e2 = f * (2 - f)
    ep2, c2 = e2 / (1 - e2), authalic_square(a, f)
    span = (lon2 - lon1 + 180) % 360 - 180
    lam = np.radians(np.where(span == -180, 180.0, span))
    beta = [np.arctan2((1 - f) * np.sin(p := np.radians(v)), np.cos(p)) for v in (lat1, lat2)]
    (s1, c1), (s2, c2_) = ((np.sin(v), np.maximum(np.cos(v), 1e-200)) for v in beta)
    omega = lam.copy()
    for _ in range(ROUNDS):
        so, co = np.sin(omega), np.cos(omega)
        y1, x1 = c2_ * so, c1 * s2 - s1 * c2_ * co
        # The azimuth's sine and cosine; 0 and 1 where the points are one.
        long = np.hypot(y1, x1)
        sin_az, cos_az = (y1 / np.where(long == 0, 1.0, long)), np.where(long == 0, 1.0, x1 / np.where(long == 0, 1.0, long))
        sa, ca = sin_az * c1, np.hypot(cos_az, sin_az * s1)
        sig1 = np.arctan2(s1, cos_az * c1)
        sig1 = np.where((s1 == 0) & (cos_az * c1 == 0), 0.0, sig1)
        arc = np.arctan2(long, s1 * s2 + c1 * c2_ * co)
        sig2 = sig1 + arc
        more = e2 * sa * integral(lambda s, ca=ca: 1 / (1 + np.sqrt(1 - e2 * (1 - (ca[:, None] * np.sin(s)) ** 2))), sig1, sig2, rule)
        new = lam + more
        if np.abs(new - omega).max(initial=0) < 1e-15:
            break
        omega = new
    # The excess of the great circle over the equator, written so that short edges lose no digits.
    t1, t2 = np.tan(beta[0] / 2), np.tan(beta[1] / 2)
    half = np.clip(omega / 2, -math.pi / 2, math.pi / 2)
    sphere = 2 * np.arctan2(np.sin(half) * (t1 + t2), np.cos(half) * (1 + t1 * t2))

    def t(x: np.ndarray) -> np.ndarray:
        """x + sqrt(1 / x + 1) * asinh(sqrt(x)), 1 at 0."""
        root = np.sqrt(np.maximum(x, 1e-300))
        return np.where(x < 1e-12, 1 + 4 * x / 3, x + np.sqrt(1 + x) * np.arcsinh(root) / root)

    k2 = ep2 * ca**2
    # Where both are nearly equal, the quotient is the slope there.
    h = 1e-5 * max(ep2, 1e-12)
    below, at, above = t(np.array([ep2 - h, ep2, ep2 + h]))
    slope = (above - below) / (2 * h) if ep2 > h else 4 / 3

    def flat(s: np.ndarray) -> np.ndarray:
        sine = np.sin(s)
        x = k2[:, None] * sine**2
        near = ep2 - x
        q = np.where(np.abs(near) < 1e-7 * ep2, slope, (at - t(x)) / np.where(near == 0, 1.0, near))
        return -q * sine / 2

    return c2 * sphere + e2 * a * a * ca * sa * integral(flat, sig1, sig2, rule)


def ring_area(ring: np.ndarray, a: float, f: float) -> float:
    """The area inside a closed ring of longitudes and latitudes, the smaller of both sides; it may cross any meridian and hold a pole."""
    lon, lat = ring[:, 0], ring[:, 1]
    total = float(area_under(lon[:-1], lat[:-1], lon[1:], lat[1:], a, f).sum())
    span = (np.diff(lon) + 180) % 360 - 180
    whole = 4 * math.pi * authalic_square(a, f)
    if round(abs(float(np.where(span == -180, 180.0, span).sum())) / 360) % 2:  # around a pole
        total = abs(total) - whole / 2
    total = abs(total) % whole
    return min(total, whole - total)


def area(rings: list[np.ndarray], a: float, f: float) -> float:
    """Outer rings (counter-clockwise) less holes."""
    from quadrille.kernel.overlay import signed_area

    return sum((1 if signed_area(r) > 0 else -1) * ring_area(r, a, f) for r in rings if len(r) > 3)
