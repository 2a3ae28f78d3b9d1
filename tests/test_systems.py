"""Projections and geodesic areas against published values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.functions.systems import System, defined, system
from quadrille.kernel import geodesic as D
from quadrille.operators.spatial import clip

FOOT = 12 / 39.37
#: Worked examples of the EPSG guidance note 7-2 and of Snyder's Map Projections; fixed values.
EXAMPLES = [
    (System("tmerc", 6377563.396, 299.32496, 49, -2, scale=0.9996012717, east=400000, north=-100000), 0.5, 50.5, 577274.99, 69740.50, 0.011),
    (System("lcc", 20925832.16 * FOOT, 294.97870, 27 + 5 / 6, -99, 28 + 23 / 60, 30 + 17 / 60, east=2000000, unit=FOOT), -96, 28.5, 2963503.91, 254759.80, 0.011),
    (System("lcc", 6378206.4, 294.97870, 18, -77, 18, 18, east=250000, north=150000), -(76 + 56 / 60 + 37.26 / 3600), 17 + 55 / 60 + 55.80 / 3600, 255966.58, 142493.51, 0.011),
    (System("albers", 6378206.4, 294.97870, 23, -96, 29.5, 45.5), -75, 35, 1885472.7, 1535925.0, 0.06),
]


@pytest.mark.parametrize(("s", "lon", "lat", "x", "y", "off"), EXAMPLES)
def test_published_points(spark, s, lon, lat, x, y, off):
    there = s.forward(F.lit(float(lon)), F.lit(float(lat)))
    got = spark.range(1).select(there).first()[0]
    assert abs(got[0] - x) < off and abs(got[1] - y) < off
    back = spark.range(1).select(s.inverse(F.lit(got[0]), F.lit(got[1]))).first()[0]
    assert abs(back[0] - lon) < 1e-9 and abs(back[1] - lat) < (1e-7 if s.kind == 'albers' else 1e-9)


def test_zones_and_definitions(spark):
    utm = system(32633)
    assert (utm.lon0, utm.scale, utm.east, system(32733).north, system(26914).lon0) == (15.0, 0.9996, 500000.0, 10_000_000.0, -99.0)
    first = 'PROJCS["NAD_1983_Albers",GEOGCS["NAD83",DATUM["D",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["Albers"],PARAMETER["False_Easting",0.0],PARAMETER["central_meridian",-96.0],PARAMETER["Standard_Parallel_1",29.5],PARAMETER["Standard_Parallel_2",45.5],PARAMETER["Latitude_Of_Origin",23.0],UNIT["Meter",1.0]]'
    assert defined(first) == system(5070)
    second = 'PROJCRS["WGS 84 / UTM zone 33N",BASEGEOGCRS["WGS 84",DATUM["World Geodetic System 1984",ELLIPSOID["WGS 84",6378137,298.257223563,LENGTHUNIT["metre",1]]]],CONVERSION["UTM",METHOD["Transverse Mercator",ID["EPSG",9807]],PARAMETER["Latitude of natural origin",0,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Longitude of natural origin",15,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Scale factor at natural origin",0.9996,SCALEUNIT["unity",1]],PARAMETER["False easting",500000,LENGTHUNIT["metre",1]],PARAMETER["False northing",0,LENGTHUNIT["metre",1]]],CS[Cartesian,2],AXIS["(E)",east],AXIS["(N)",north],LENGTHUNIT["metre",1]]'
    assert defined(second) == utm and utm.metric()
    feet = first.replace('UNIT["Meter",1.0]', f'UNIT["Foot_US",{FOOT}]')
    assert defined(feet).unit == FOOT and not defined(feet).metric()
    for text, message in (('LOCAL_CS["x"]', "without an ellipsoid"), (first.replace('"Albers"]', '"Gnomonic"]'), "no projection Gnomonic")):
        with pytest.raises(ValueError, match=message):
            defined(text)
    with pytest.raises(ValueError, match="no way between the ellipsoids"):
        G.reprojected(F.col("geom"), EXAMPLES[0][0], 4326)
    box = [[500000.0, 5000000.0, 500100.0, 5000000.0, 500100.0, 5000100.0, 500000.0, 5000100.0, 500000.0, 5000000.0]]
    df = spark.createDataFrame([(box,)], "geom array<array<double>>")
    degrees = df.withColumn("geom", G.reprojected(F.col("geom"), 32633, 4326))
    got = degrees.select(G.area_ha(F.col("geom"), F.lit(4326)), G.area_ha_in(F.col("geom"), system(4326))).first()
    assert abs(got[0] - 1 / 0.9996**2) < 1e-6 and got[0] == got[1]
    edge = df.withColumn("geom", F.array(F.transform(F.col("geom")[0], lambda v: v + 50)))
    assert clip(df, edge, 0.01, 64.0).select(G.area_ha_in(F.col("geom"), system(32633))).first()[0] == 0.25


#: Areas in m² of the planimeter tests that come with GeographicLib, as (latitude, longitude); fixed values.
PLANIMETER = [
    ([(89, 0), (89, 90), (89, 180), (89, 270)], 24952305678.0),
    ([(-89, 0), (-89, 90), (-89, 180), (-89, 270)], 24952305678.0),
    ([(0, -1), (-1, 0), (0, 1), (1, 0)], 24619419146.0),
    ([(90, 0), (0, 0), (0, 90)], 63758202715511.0),
    ([(89, 0.1), (89, 90.1), (89, -179.9)], 12476152838.5),
    ([(9, -0.00000000000001), (9, 180), (9, 0)], 0.0),
]


@pytest.mark.parametrize(("points", "area"), PLANIMETER)
def test_published_areas(points, area):
    for turned in (points, points[::-1], points[1:] + points[:1]):
        ring = np.array([(lon, lat) for lat, lon in [*turned, turned[0]]], float)
        assert abs(D.ring_area(ring, 6378137.0, 1 / 298.257223563) - area) < 1.5


def test_small_and_holed_polygons(spark):
    ring = lambda x, y, s: [x, y, x + s, y, x + s, y + s, x, y + s, x, y]
    hole = ring(-100.4, 40.2, 0.1)
    geom = [ring(-100.5, 40.0, 0.5), [v for k in range(4, -1, -1) for v in hole[2 * k : 2 * k + 2]]]
    df = spark.createDataFrame([(geom,), (None,), ([ring(10.0, 50.0, 1e-6)],)], "geom array<array<double>>")
    a = [r[0] for r in df.select(G.geodesic_area(F.col("geom"))).collect()]
    planar = [r[0] for r in df.select(G.area(G.reprojected(F.col("geom"), 4326, 5070))).collect()]
    assert abs(a[0] / planar[0] - 1) < 2e-5 and a[1] == 0 and abs(a[2] - 0.0079766) < 1e-5
