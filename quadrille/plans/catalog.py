"""All queries over the standard tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.operators import attributes as T
from quadrille.operators import rasters as R
from quadrille.operators import spatial as S
from quadrille.operators.batching import batches
from quadrille.plans import fixtures as X
from quadrille.plans import products, zonal
from quadrille.plans import values as V
from quadrille.plans.combine import Group, combine_results
from quadrille.sources import files, geopackage
from quadrille.sources import rasters as RF
from quadrille.sources.staging import new_path

# SQL of the fixtures.
ZONES = "zones AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS geoid, CAST(n_nationkey % 5 AS DOUBLE) * 200 AS x1, CAST(n_nationkey // 5 AS DOUBLE) * 200 AS y1 FROM nation)"
FEATURES = "features AS (SELECT p_partkey AS fid, p_size AS s, p_retailprice AS v, CAST((p_partkey * 37) % 1000 AS DOUBLE) AS x1, CAST((p_partkey * 91) % 1000 AS DOUBLE) AS y1 FROM part)"
OVERLAP = "overlap AS (SELECT geoid, fid, v, s, (least(z.x1 + 200, f.x1 + s) - greatest(z.x1, f.x1)) * (least(z.y1 + 200, f.y1 + s) - greatest(z.y1, f.y1)) AS a, greatest(z.x1, f.x1) AS ox1, least(z.x1 + 200, f.x1 + s) AS ox2, greatest(z.y1, f.y1) AS oy1, least(z.y1 + 200, f.y1 + s) AS oy2 FROM zones z JOIN features f ON f.x1 < z.x1 + 200 AND f.x1 + s > z.x1 AND f.y1 < z.y1 + 200 AND f.y1 + s > z.y1)"
PIXELS = "pixels AS (SELECT CAST(event_id // 100 AS INTEGER) AS r, CAST(event_id % 100 AS INTEGER) AS c, CASE WHEN event_type <> 'error' THEN value END AS v, event_type FROM events)"
CODES = {"m": ["FED", "STAT", "LOC", "DIST", "JNT", "TERR", "UNK", "PVT", "NGO", None], "o": ["PVT", "LOC", "DIST", "FED", "JNT", "STAT", "UNK", None], "mn": [None, "DOD", "DOE", "NPS"], "n": ["DOE", None, "BLM", None, "DOD"], "d": [None, "MIL", "NP"], "a": ["XA", "UK", "OA", None, "RA"]}
OWNERS = f"owners AS (SELECT c_custkey, {', '.join('[' + ', '.join('NULL' if v is None else repr(v) for v in codes) + f'][1 + (c_custkey * {step}) // 7 % {len(codes)}] AS {c}' for step, (c, codes) in zip((3, 5, 11, 13, 17, 19), CODES.items()))} FROM customer)"

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {ZONES}, {FEATURES}, {OVERLAP} SELECT z.geoid, round(coalesce(sum(v * a / (s * s)), 0), 4) AS allocated FROM zones z LEFT JOIN overlap o USING (geoid) GROUP BY z.geoid")
def areal_allocation(spark, d):
    out = S.allocate(X.zones(spark, d), X.features(spark, d), "geoid", T.finite_nonzero(F.col("p_retailprice")), X.CELL)
    return out.select("geoid", F.round("allocated", 4).alias("allocated"))


@query(f"WITH {ZONES}, {FEATURES}, {OVERLAP} SELECT z.geoid, round(coalesce(sum(a), 0) / 1e4, 6) AS intersect_area_ha FROM zones z LEFT JOIN overlap o USING (geoid) GROUP BY z.geoid")
def overlay_area(spark, d):
    out = S.overlay_area(X.zones(spark, d), X.features(spark, d), "geoid", X.CELL)
    return out.select("geoid", F.round("intersect_area_ha", 6).alias("intersect_area_ha"))


@query(f"WITH {ZONES}, {FEATURES} SELECT z.geoid, round(coalesce(sum(least(z.x1 + 200, f.x1 + s) - greatest(z.x1, f.x1)), 0) / 1000, 6) AS intersect_length_km FROM zones z LEFT JOIN features f ON f.x1 < z.x1 + 200 AND f.x1 + s > z.x1 AND f.y1 + 0.5 > z.y1 AND f.y1 + 0.5 < z.y1 + 200 GROUP BY z.geoid")
def overlay_length(spark, d):
    out = S.overlay_length(X.zones(spark, d), X.lines(spark, d), "geoid", X.CELL)
    return out.select("geoid", F.round("intersect_length_km", 6).alias("intersect_length_km"))


@query(f"""WITH {ZONES}, {FEATURES}, {OVERLAP}, xs AS (SELECT geoid, x, lead(x) OVER (PARTITION BY geoid ORDER BY x) AS x2 FROM (SELECT DISTINCT geoid, unnest([ox1, ox2]) AS x FROM overlap)),
cells AS (SELECT DISTINCT o.geoid, xs.x, xs.x2, o.oy1, o.oy2 FROM overlap o JOIN xs ON xs.geoid = o.geoid AND xs.x >= o.ox1 AND xs.x2 <= o.ox2),
runs AS (SELECT *, max(oy2) OVER (PARTITION BY geoid, x ORDER BY oy1, oy2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM cells),
areas AS (SELECT geoid, sum((x2 - x) * greatest(0, oy2 - greatest(oy1, coalesce(top, oy1)))) AS a FROM runs GROUP BY geoid)
SELECT areas.geoid, round(areas.a, 3) AS area, min(fid) AS first_fid FROM areas JOIN overlap ON areas.geoid = overlap.geoid GROUP BY ALL""")
def cut_and_dissolve(spark, d):
    out = S.dissolve(X.zones(spark, d), X.features(spark, d), "geoid", X.CELL)
    return out.select("geoid", F.round(G.area(F.col("geom")), 3).alias("area"), "first_fid")


@query(f"WITH {ZONES}, {FEATURES} SELECT count(*) AS pairs, CAST(sum(fid) AS BIGINT) AS fids FROM zones z JOIN features f ON f.x1 <= z.x1 + 200 AND f.x1 + s >= z.x1 AND f.y1 <= z.y1 + 200 AND f.y1 + s >= z.y1")
def spatial_join(spark, d):
    pairs = S.spatial_join(X.zones(spark, d), X.features(spark, d), X.CELL, exact=True)
    return pairs.agg(F.count("*").alias("pairs"), F.sum("r.fid").alias("fids"))


@query("SELECT fid, round(s * s / 2.0, 6) AS area, CAST(4 AS BIGINT) AS points FROM (SELECT p_partkey AS fid, p_size AS s FROM part)")
def triangle_overlay(spark, d):
    """Triangles cut by the squares that hold them, repaired, and through well-known binary and back."""
    pairs = X.triangles(spark, d).alias("t").join(X.features(spark, d).alias("b"), "fid")
    cut = pairs.select("fid", G.from_wkb(G.to_wkb(G.repaired(G.intersection("t.geom", "b.geom")))).alias("geom"))
    return cut.select("fid", F.round(G.area(F.col("geom")), 6).alias("area"), G.n_points(F.col("geom")).alias("points"))


@query("""WITH f AS (SELECT sign * p_partkey AS fid, (p_partkey * 37) % 1000 AS x1, (p_partkey * 91) % 1000 AS y1, p_size AS s, bad FROM part, (VALUES (1, false), (-1, true)) c(sign, bad) WHERE NOT bad OR p_partkey % 50 = 7),
b AS (SELECT * FROM (VALUES (0, 0, 500, 300), (0, 300, 500, 500), (700, 700, 800, 900)) t(bx1, by1, bx2, by2)),
m AS (SELECT fid, greatest(0, least(bx2, x1 + s) - greatest(bx1, x1))::DOUBLE * greatest(0, least(by2, y1 + s) - greatest(by1, y1)) AS a FROM f JOIN b ON bx1 <= x1 + s AND bx2 >= x1 AND by1 <= y1 + s AND by2 >= y1)
SELECT fid, CASE WHEN any_value(bad) THEN 'error' WHEN any_value(x1) > 800 OR any_value(y1) > 900 THEN 'outside' WHEN sum(a) > 0 THEN 'ok' ELSE 'no_area' END AS status, round(CASE WHEN any_value(bad) THEN 0 ELSE coalesce(sum(a), 0) END, 4) AS area FROM f LEFT JOIN m USING (fid) GROUP BY fid""")
def clip_to_boundary(spark, d):
    """A boundary of three rows, all features, and beside one of fifty a copy with a broken ring, its number negative."""
    edge = spark.createDataFrame([(0, 0, 500, 300), (0, 300, 500, 500), (700, 700, 800, 900)], "x1 int, y1 int, x2 int, y2 int")
    edge = edge.select(G.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("geom"))
    whole = F.struct("fid", "geom")
    broken = F.struct((-F.col("fid")).alias("fid"), F.array(F.slice(F.col("geom")[0], 1, 7)).alias("geom"))
    rows = F.inline(F.when(F.col("fid") % 50 == 7, F.array(whole, broken)).otherwise(F.array(whole)))
    out = S.clip(X.features(spark, d).select("size", "p_retailprice", rows), edge, tolerance=0.1, cell=X.CELL)
    return out.select("fid", "status", F.round(G.area(F.col("geom")), 4).alias("area"))


@query(f"""WITH {OWNERS}, kept AS (SELECT *, NOT (coalesce(a, '') = 'XA' OR coalesce(o, '') = 'PVT' OR coalesce(mn, '') IN ('DOD', 'DOE') OR coalesce(n, '') IN ('DOD', 'DOE') OR coalesce(d, '') = 'MIL')
  AND (coalesce(m, '') IN ('FED', 'STAT', 'LOC', 'DIST', 'JNT', 'TERR') OR (coalesce(m, '') = 'UNK' AND coalesce(o, '') IN ('LOC', 'DIST', 'FED', 'JNT', 'STAT'))) AS public FROM owners)
SELECT 'all' AS land_type, m AS manager, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM kept GROUP BY m
UNION ALL SELECT 'public', m, count(*), CAST(sum(c_custkey) AS BIGINT) FROM kept WHERE public GROUP BY m""")
def public_lands(spark, d):
    """Both products of one scan, by manager; every code of every list occurs."""
    k = F.col("c_custkey")
    code = lambda c, step: F.get(F.array(*[F.lit(v) for v in CODES[c]]), (F.floor(k * step / 7) % len(CODES[c])).cast("int"))
    names = {"m": "Mang_Type", "o": "Own_Type", "mn": "Mang_Name", "n": "Own_Name", "d": "Des_Tp", "a": "Pub_Access"}
    coded = X.table(spark, d, "customer").select(k, *[code(c, step).alias(names[c]) for step, c in zip((3, 5, 11, 13, 17, 19), CODES)])
    return T.land_products(coded).groupBy("land_type", F.col("Mang_Type").alias("manager")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query("""WITH f AS (SELECT p_partkey AS fid, [390, 436, 460, 466, 537, 999][p_size % 6 + 1] AS ftype, p_partkey % 2 AS area FROM part)
SELECT CASE WHEN area = 1 THEN 'NHDArea' ELSE 'NHDWaterbody' END AS source_layer, CASE ftype WHEN 390 THEN 'LakePond' WHEN 436 THEN 'Reservoir' WHEN 466 THEN 'SwampMarsh' WHEN 460 THEN 'StreamRiver' ELSE 'AreaOfComplexChannels' END AS feature_type, count(*) AS n, CAST(sum(fid) AS BIGINT) AS fids
FROM f WHERE (area = 0 AND ftype IN (390, 436, 466)) OR (area = 1 AND ftype IN (460, 537)) GROUP BY ALL""")
def water_features(spark, d):
    codes = F.array(*[F.lit(c) for c in (390, 436, 460, 466, 537, 999)])
    f = X.table(spark, d, "part").select(F.col("p_partkey").alias("fid"), F.get(codes, F.col("p_size") % 6).alias("ftype"))
    out = T.water_features({"NHDWaterbody": f.filter("fid % 2 = 0"), "NHDArea": f.filter("fid % 2 = 1")})
    return out.groupBy("source_layer", "feature_type").agg(F.count("*").alias("n"), F.sum("fid").alias("fids"))


@query("SELECT l_orderkey, CAST(arg_max(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS BIGINT) AS l_partkey FROM lineitem GROUP BY l_orderkey")
def last_by_key(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return T.last_by_key(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]).select("l_orderkey", "l_partkey")


@query("SELECT l_linenumber, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nth FROM lineitem) WHERE nth > 1 GROUP BY ALL")
def repeated_keys(spark, d):
    return T.repeated_keys(X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber").groupBy("l_linenumber").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE r AS (SELECT p_brand, p_partkey, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part),
w AS (SELECT p_brand, n, p_partkey, CASE WHEN p_size >= 100 THEN 0 ELSE p_size END AS acc, 0 AS batch, CAST(p_size >= 100 AS INTEGER) AS up FROM r WHERE n = 1
UNION ALL SELECT r.p_brand, r.n, r.p_partkey, CASE WHEN w.acc + r.p_size >= 100 THEN 0 ELSE w.acc + r.p_size END, w.batch + w.up, CAST(w.acc + r.p_size >= 100 AS INTEGER) FROM w JOIN r ON r.p_brand = w.p_brand AND r.n = w.n + 1)
SELECT p_partkey, CAST(batch AS BIGINT) AS batch FROM w""")
def vertex_batches(spark, d):
    return batches(X.table(spark, d, "part").select("p_brand", "p_partkey", "p_size"), "p_brand", "p_partkey", "p_size", 100).select("p_partkey", "batch")


@query("""WITH f AS (SELECT 'job' || CAST(o_custkey % 20 AS VARCHAR) AS job, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '_%Y%m%d_%H%M%S') ELSE strftime(o_orderdate, '_%Y_%m_%d_%H_%M_%S') END AS tail, o_orderdate AS ts FROM orders)
SELECT job, arg_max(job || tail, (ts, o_orderkey, job || tail)) AS stem FROM f GROUP BY job""")
def newest_files(spark, d):
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    tail = F.when(k % 2 == 0, F.date_format(ts, "_yyyyMMdd_HHmmss")).otherwise(F.date_format(ts, "_yyyy_MM_dd_HH_mm_ss"))
    return T.newest(X.table(spark, d, "orders").select(F.concat(F.lit("job"), (F.col("o_custkey") % 20).cast("string"), tail).alias("stem"), k.alias("mtime")))


@query("SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS geoid, n_name, CAST(n_nationkey AS DOUBLE) AS m1, CAST(n_nationkey + 1 AS DOUBLE) AS m2, CAST(100 * (n_nationkey + 1) AS DOUBLE) * 0.25 AS area_ha_nlcd_forests FROM nation")
def combine_tables(spark, d):
    z = X.table(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("geoid"), "n_name", F.col("n_nationkey").cast("double").alias("k"))
    masks = z.select("geoid", "n_name", (100 * (F.col("k") + 1)).alias("area_ha_valid_reclassified_NLCD2023_forests_x"), F.lit(0.25).alias("proportion_valid_nonzero_reclassified_NLCD2023_forests_x"))
    out = T.combine([("a", z.select("geoid", "n_name", F.col("k").alias("m1"))), ("b", z.select("geoid", "n_name", (F.col("k") + 1).alias("m2"))), ("masks", masks)], "geoid")
    return T.class_areas(out, ["forests", "wetlands"])


@query(f"""WITH {PIXELS}, g AS (SELECT greatest(100, coalesce(max(event_id), -1) // 100 + 1) AS h FROM events),
zones AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS geoid, n_nationkey % 5 * 200.0 AS x1, n_nationkey // 5 * h * 2.0 AS y1, h * 2.0 AS high FROM nation, g),
cells AS (SELECT i // 100 AS r, i % 100 AS c FROM (SELECT unnest(range(h * 100)) AS i FROM g)),
p AS (SELECT geoid, r, v FROM zones JOIN (SELECT r, c, v FROM cells LEFT JOIN pixels USING (r, c)) ON (c + 0.5) * 10 >= x1 AND (c + 0.5) * 10 < x1 + 200 AND (r + 0.5) * 10 >= y1 AND (r + 0.5) * 10 < y1 + high)
SELECT geoid, count(r) AS total_count, count(v) AS valid_count, round(coalesce(sum(v), 0), 4) AS sum, round(avg(v), 6) AS mean, round(stddev_pop(v), 5) AS stdev, round(count(v) * CAST(0.01 AS DOUBLE), 6) AS area_ha_valid, round(count(r) * CAST(0.01 AS DOUBLE), 6) AS area_ha_total, round((count(*) FILTER (WHERE v <> 0)) / CASE WHEN count(v) > 0 THEN count(v) END, 6) AS proportion_valid_nonzero
FROM zones LEFT JOIN p USING (geoid) GROUP BY geoid""")
def zonal_stats(spark, d):
    """A zone's total counts all pixel centres inside it, with data or not."""
    grid = X.event_grid(spark, d)
    out = R.zonal_stats(X.raster(spark, d, grid), X.event_zones(spark, d, grid), grid, "geoid")
    digits = {"sum": 4, "mean": 6, "stdev": 5, "area_ha_valid": 6, "area_ha_total": 6, "proportion_valid_nonzero": 6}
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in out.columns])


@query(f"WITH {PIXELS} SELECT m.mask, count(*) FILTER (WHERE v = m.one) AS ones, count(*) FILTER (WHERE v IN (m.one, m.zero)) - count(*) FILTER (WHERE v = m.one) AS zeros FROM (SELECT CAST(event_id_class AS INTEGER) AS v FROM (SELECT (r * 7 + c) % 5 AS event_id_class FROM pixels)) CROSS JOIN (VALUES ('forests', 1, 0), ('wetlands', 3, 2)) m(mask, one, zero) GROUP BY m.mask")
def reclass_masks(spark, d):
    classes = X.pixels(spark, d).withColumn("value", ((F.col("row") * 7 + F.col("col")) % 5).cast("double"))
    out = R.reclassify(R.tiles_of(classes, X.event_grid(spark, d)), {"forests": {1: 1, 0: 0}, "wetlands": {3: 1, 2: 0}})
    count = lambda v: F.sum(F.size(F.filter("data", lambda x: x == v))).cast("long")
    return out.groupBy("mask").agg(count(1).alias("ones"), count(0).alias("zeros"))


@query(f"""WITH {FEATURES}, hit AS (SELECT r, c, arg_max(v, fid) AS v FROM features f JOIN (SELECT i // 100 AS r, i % 100 AS c FROM range(10000) t(i)) g
ON (c + 0.5) * 10 >= x1 AND (c + 0.5) * 10 < x1 + s AND (r + 0.5) * 10 >= y1 AND (r + 0.5) * 10 < y1 + s GROUP BY r, c)
SELECT count(*) AS burnt, round(sum(v) * 0.01, 4) AS total, round(coalesce(sum(v) FILTER (WHERE (r + c) % 2 = 0), 0) * 0.01, 4) AS masked_total FROM hit""")
def value_raster(spark, d):
    """Polygons burnt into a raster, masked, and their totals side by side."""
    grid = X.grid()
    tiles = R.burn(X.features(spark, d), grid, "p_retailprice", "fid")
    mask = R.tiles_of(spark.range(grid.width * grid.height).select(F.floor(F.col("id") / grid.width).cast("int").alias("row"), (F.col("id") % grid.width).cast("int").alias("col")).withColumn("value", ((F.col("row") + F.col("col")) % 2 == 0).cast("int")), grid)
    out = R.burnt_totals(tiles, mask, grid)
    return out.select("burnt", F.round("total", 4).alias("total"), F.round("masked_total", 4).alias("masked_total"))


@query(f"""WITH {PIXELS}, g AS (SELECT greatest(100, coalesce(max(event_id), -1) // 100 + 1) AS h FROM events),
cells AS (SELECT i // 100 AS r, i % 100 AS c, h FROM (SELECT unnest(range(h * 100)) AS i, h FROM g))
SELECT CAST(c // 32 * 32 AS INTEGER) AS xoff, CAST(r // 32 * 32 AS INTEGER) AS yoff, CAST(least(32, 100 - c // 32 * 32) AS INTEGER) AS w, CAST(least(32, any_value(h) - r // 32 * 32) AS INTEGER) AS h, count(v) AS valid, round(coalesce(sum(v), 0), 4) AS total
FROM cells LEFT JOIN pixels USING (r, c) GROUP BY c // 32, r // 32""")
def raster_file(spark, d):
    """Events as pixels of a GeoTIFF, written and read back, tile by tile."""
    grid = X.event_grid(spark, d)
    path = RF.write_raster(X.raster(spark, d, grid), grid, f"{new_path(spark, 'raster')}/events.tif", "float64", -9999, 5070, "deflate", predictor=3)
    valid = F.filter("data", lambda v: v.isNotNull())
    total = F.aggregate(valid, F.lit(0.0), lambda s, v: s + v)
    return RF.read_raster(spark, path).select("xoff", "yoff", "w", "h", F.size(valid).cast("long").alias("valid"), F.round(total, 4).alias("total"))


@query(f"""WITH {PIXELS}, g AS (SELECT greatest(100, coalesce(max(event_id), -1) // 100 + 1) * 100 AS n FROM events),
k AS (SELECT CAST((r * 7 + c) % 5 AS INTEGER) AS v FROM pixels), m AS (SELECT * FROM (VALUES ('forests', 1, 0), ('wetlands', 3, 2)) m(mask, one, zero))
SELECT mask, 'uint8' AS dtype, CAST(255 AS DOUBLE) AS nodata, CAST(any_value(n) // 3200 + CAST(any_value(n) % 3200 > 0 AS INTEGER) AS BIGINT) * 4 AS blocks, count(*) FILTER (WHERE v = one) AS ones, count(*) FILTER (WHERE v = zero) AS zeros, CAST(any_value(n) - count(*) FILTER (WHERE v IN (one, zero)) AS BIGINT) AS no_data
FROM k, m, g GROUP BY mask""")
def mask_files(spark, d):
    """A class raster in a file, and a mask file for each reclass table out of one scan of it."""
    grid, folder = X.event_grid(spark, d), new_path(spark, "masks")
    classes = X.pixels(spark, d).withColumn("value", (F.col("row") * 7 + F.col("col")) % 5)
    path = RF.write_raster(R.tiles_of(classes, grid), grid, f"{folder}/classes.tif", "uint8", 200, 5070, "lzw")
    made = RF.write_masks(spark, path, {"forests": {1: 1, 0: 0}, "wetlands": {3: 1, 2: 0}}, folder)
    out = []
    for name, mask in made.items():
        count = lambda f, a: F.sum(F.size(F.filter("data", f))).cast("long").alias(a)
        counts = RF.read_raster(spark, mask).agg(count(lambda v: v == 1, "ones"), count(lambda v: v == 0, "zeros"), count(lambda v: v.isNull(), "no_data"))
        out.append(RF.raster_info(spark, mask).select(F.lit(name).alias("mask"), "dtype", "nodata", "blocks").crossJoin(counts))
    return out[0].unionByName(out[1])


@query(f"""WITH {FEATURES}, hit AS (SELECT r, c, arg_max(v, fid) AS v FROM features f JOIN (SELECT i // 100 AS r, i % 100 AS c FROM range(10000) t(i)) g
ON (c + 0.5) * 10 >= x1 AND (c + 0.5) * 10 < x1 + s AND (r + 0.5) * 10 >= y1 AND (r + 0.5) * 10 < y1 + s GROUP BY r, c)
SELECT CAST(16 AS BIGINT) AS tiles, round(coalesce(sum(v) FILTER (WHERE (r + c) % 2 = 0), 0) * 0.01, 4) AS total FROM hit""")
def value_raster_file(spark, d):
    """Polygons burnt into a file like that of a mask, then masked in place, and its total."""
    grid, folder = X.grid(), new_path(spark, "values")
    cells = spark.range(grid.width * grid.height).select(F.floor(F.col("id") / grid.width).cast("int").alias("row"), (F.col("id") % grid.width).cast("int").alias("col"))
    mask = RF.write_raster(R.tiles_of(cells.withColumn("value", ((F.col("row") + F.col("col")) % 2 == 0).cast("int")), grid), grid, f"{folder}/mask.tif", "uint8", 255, 5070)
    like = RF.raster_grid(mask)
    path = RF.write_raster(R.burn(X.features(spark, d), like, "p_retailprice", "fid"), like, f"{folder}/values.tif", "float64", -9999, 5070, "lzw")
    RF.write_raster(R.masked(RF.read_raster(spark, path), RF.read_raster(spark, mask)), like, path, "float64", -9999, 5070, "lzw", overwrite=True)
    tiles = RF.read_raster(spark, path)
    return tiles.agg(F.count("*").alias("tiles")).crossJoin(F.broadcast(R.weighted_total(tiles, like).select(F.round("total", 4).alias("total"))))


@query(f"""WITH {PIXELS}, {FEATURES}, {OVERLAP}, zp AS (SELECT geoid, r, v FROM zones JOIN (SELECT i // 100 AS r, i % 100 AS c, v FROM range(10000) t(i) LEFT JOIN pixels ON r = i // 100 AND c = i % 100) p ON (c + 0.5) * 10 >= x1 AND (c + 0.5) * 10 < x1 + 200 AND (r + 0.5) * 10 >= y1 AND (r + 0.5) * 10 < y1 + 200),
{ZONES}, st AS (SELECT geoid, coalesce(sum(v), 0) AS s, avg(v) AS m, count(v) * CAST(0.01 AS DOUBLE) AS a FROM zones LEFT JOIN zp USING (geoid) GROUP BY geoid)
SELECT z.geoid AS GEOID, round(s, 4) AS sum_events, round(m, 6) AS mean_events, round(st.a, 6) AS area_ha_valid_events, round((SELECT coalesce(sum(o.a), 0) / 1e4 FROM overlap o WHERE o.geoid = z.geoid), 6) AS intersect_area_ha FROM zones z JOIN st USING (geoid)""".replace(f"WITH {PIXELS}, {FEATURES}, {OVERLAP}, zp", f"WITH {ZONES}, {PIXELS}, {FEATURES}, {OVERLAP}, zp").replace(f"\n{ZONES}, st AS", "\nst AS"))
def zonal_run(spark, d):
    """A job file over a zone layer, a raster file of events and a layer of features; its two tables side by side."""
    geopackage.register(spark)
    folder = new_path(spark, "zonal-run").removeprefix("file://").removeprefix("file:")
    grid = X.grid()
    zones = X.zones(spark, d).select(F.col("geoid").alias("GEOID"), "geom")
    zones.coalesce(1).write.format("geopackage").mode("append").option("layer", "zones").option("srid", 5070).save(f"{folder}/zones.gpkg")
    X.features(spark, d).select("fid", "geom").write.format("geopackage").mode("append").option("layer", "parts").option("srid", 5070).save(f"{folder}/parts.gpkg")
    RF.write_raster(R.tiles_of(X.pixels(spark, d).filter(F.col("row") < grid.height), grid), grid, f"{folder}/in/events.tif", "float64", -9999, 5070)
    common = "agg_vector = ./zones.gpkg\nagg_layer = zones\nagg_field = GEOID\n"
    with open(f"{folder}/jobs.ini", "w", encoding="utf-8") as f:
        f.write(f"[project]\nname = x\n\n[job:a]\n{common}operations = sum, mean, area_ha_valid\nbase_raster_pattern = ./in/*.tif\noutput_csv = ./out/a.csv\n\n[job:b]\n{common}operations = intersect_area_ha\nbase_measure_vector = ./parts.gpkg\noutput_csv = ./out/b.csv\noutput_gpkg = ./out/b.gpkg\n")
    made = zonal.run_jobs(spark, f"{folder}/jobs.ini", X.CELL)
    out = T.combine([(n, files.read_keyed(spark, made[n]["csv"], "GEOID")) for n in ("a", "b")], "GEOID")
    digits = {"sum_events": 4}
    return out.select("GEOID", *[F.round(c, digits.get(c, 6)).alias(c) for c in out.columns if c != "GEOID"])


@query(f"""WITH {OWNERS.replace("c_custkey", "p_partkey").replace("FROM customer", "FROM part")}, f AS (SELECT p_partkey, p_size AS s, CAST((p_partkey * 37) % 1000 AS DOUBLE) AS x1, CAST((p_partkey * 91) % 1000 AS DOUBLE) AS y1, p_partkey % 50 = 7 AS bad FROM part),
k AS (SELECT *, NOT bad AND greatest(0, least(700, x1 + s) - x1) * greatest(0, least(600, y1 + s) - y1) > 0 AS ok, greatest(0, least(700, x1 + s) - x1) * greatest(0, least(600, y1 + s) - y1) AS area,
  NOT (coalesce(a, '') = 'XA' OR coalesce(o, '') = 'PVT' OR coalesce(mn, '') IN ('DOD', 'DOE') OR coalesce(n, '') IN ('DOD', 'DOE') OR coalesce(d, '') = 'MIL')
  AND (coalesce(m, '') IN ('FED', 'STAT', 'LOC', 'DIST', 'JNT', 'TERR') OR (coalesce(m, '') = 'UNK' AND coalesce(o, '') IN ('LOC', 'DIST', 'FED', 'JNT', 'STAT'))) AS public FROM f JOIN owners USING (p_partkey))
SELECT 'all' AS product, count(*) AS n, round(coalesce(sum(area), 0), 3) AS area FROM k WHERE ok UNION ALL SELECT 'public', count(*), round(coalesce(sum(area), 0), 3) FROM k WHERE ok AND public UNION ALL SELECT 'failed', count(*), 0 FROM k WHERE bad""")
def land_layers(spark, d):
    """Features clipped once, and both layers and the failures of it written and read back."""
    out = new_path(spark, "land").removeprefix("file://").removeprefix("file:")
    edge = spark.createDataFrame([(0, 0, 700, 600)], "x1 int, y1 int, x2 int, y2 int").select(G.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("geom"))
    k = F.col("fid")
    code = lambda c, step: F.get(F.array(*[F.lit(v) for v in CODES[c]]), (F.floor(k * step / 7) % len(CODES[c])).cast("int"))
    names = {"m": "Mang_Type", "o": "Own_Type", "mn": "Mang_Name", "n": "Own_Name", "d": "Des_Tp", "a": "Pub_Access"}
    broken = F.when(k % 50 == 7, F.array(F.slice(F.col("geom")[0], 1, 7))).otherwise(F.col("geom"))
    coded = X.features(spark, d).select(k, broken.alias("geom"), *[code(c, step).alias(names[c]) for step, c in zip((3, 5, 11, 13, 17, 19), CODES)])
    products.land_layers(coded, edge, out, tolerance=0.1, cell=X.CELL)
    layers = [spark.read.format("geopackage").option("geometry", "rings").load(f"{out}/layers/{name}").select(F.lit(name).alias("product"), G.area(F.col("geom")).alias("area")) for name in ("all", "public")]
    failed = spark.read.csv(f"{out}/failures", header=True).select(F.lit("failed").alias("product"), F.lit(0.0).alias("area"))
    return layers[0].union(layers[1]).union(failed).groupBy("product").agg(F.count("*").alias("n"), F.round(F.sum("area"), 3).alias("area"))


ALBERS = f"{G.A} * sqrt({G.CONST} - {G.CONE} * q) / {G.CONE}"


@query(f"""WITH p AS (SELECT c_custkey, CAST(-120 + c_custkey % 50 AS DOUBLE) AS lon, CAST(25 + c_custkey % 24 AS DOUBLE) AS lat FROM customer),
s AS (SELECT *, sin(radians(lat)) AS s FROM p), q AS (SELECT *, {1 - G.E2} * (s / (1 - {G.E2} * s * s) - ln((1 - {G.E} * s) / (1 + {G.E} * s)) / (2 * {G.E})) AS q FROM s)
SELECT c_custkey, round({ALBERS} * sin({G.CONE} * radians(lon + 96)), 4) AS x, round({G.RHO0} - {ALBERS} * cos({G.CONE} * radians(lon + 96)), 4) AS y, round(lon, 7) AS lon, round(lat, 7) AS lat FROM q""")
def albers_points(spark, d):
    k = F.col("c_custkey")
    p = X.table(spark, d, "customer").select(k, (k % 50 - 120).cast("double").alias("lon"), (k % 24 + 25).cast("double").alias("lat"))
    x, y = G.albers(F.col("lon"), F.col("lat"))
    p = p.select(k, x.alias("x"), y.alias("y"))
    lon, lat = G.albers_inverse(F.col("x"), F.col("y"))
    return p.select(k, F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query("SELECT p_partkey AS fid, round(p_size * p_size / 10000.0, 8) AS area_ha FROM part")
def vector_area(spark, d):
    return X.features(spark, d).select("fid", F.round(G.area_ha(F.col("geom"), F.lit(5070)), 8).alias("area_ha"))


@query("SELECT p_partkey AS fid, p_size AS size, CAST(p_partkey % 3 = 0 AS BOOLEAN) AS third, round(p_size * p_size / 2.0, 6) AS area, CAST(5070 AS BIGINT) AS srid FROM part WHERE p_size IN (1, 7, 20, 33, 50) AND p_partkey > 10")
def layer_round_trip(spark, d):
    """A layer written as GeoPackages, a file per task, and read back with filters that SQLite checks."""
    geopackage.register(spark)
    path = f"{X.scratch(spark)}/layer-{uuid.uuid4().hex}"
    layer = X.triangles(spark, d).select("fid", "size", (F.col("fid") % 3 == 0).alias("third"), "geom")
    layer.write.format("geopackage").mode("append").option("layer", "parts").option("srid", 5070).save(path)
    read = spark.read.format("geopackage").option("geometry", "rings").load(path).filter(F.col("size").isin(1, 7, 20, 33, 50)).filter("fid > 10")
    srid = F.lit(geopackage.system_of(path)).cast("long")
    return read.select("fid", F.col("size").cast("int").alias("size"), "third", F.round(G.area(F.col("geom")), 6).alias("area"), srid.alias("srid"))


@query("""SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS GEOID, n_name, CAST(n_nationkey AS DOUBLE) AS metric_a, CAST(n_nationkey + 1 AS DOUBLE) AS metric_b,
CAST(100 * (n_nationkey + 1) * 0.25 AS DOUBLE) AS area_ha_nlcd_forests FROM nation""")
def combined_results(spark, d):
    """Results of three jobs as CSV files with time stamps, older ones beside them, combined and read back."""
    base = f"{X.scratch(spark)}/results-{uuid.uuid4().hex}"
    k = F.col("n_nationkey").cast("double")
    z = X.table(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("GEOID"), "n_name", "n_nationkey")
    masks = [(100 * (k + 1)).alias("area_ha_valid_reclassified_NLCD2023_forests_2026"), F.lit(0.25).alias("proportion_valid_nonzero_reclassified_NLCD2023_forests_2026")]
    for name, columns in {"a_20260101_000000": [(k - 9).alias("metric_a")], "a_2026_01_02_00_00_00": [k.alias("metric_a")], "b_20260101_000000": [(k + 1).alias("metric_b")], "masks": masks}.items():
        files.write_csv(z.select("GEOID", "n_name", *columns).coalesce(1), f"{base}/draft/{name}")
        files.placed(spark, f"{base}/draft/{name}", f"{base}/in/counties/{name}.csv")
    (path,) = combine_results(spark, f"{base}/in", f"{base}/out", [Group("counties", "counties_all", ("a", "b", "masks"))])
    return files.read_keyed(spark, path, "GEOID")


@query("""WITH t AS (SELECT p_partkey AS k, p_retailprice AS v FROM part WHERE p_partkey % 7 <> 3), f AS (SELECT p_partkey AS k, p_size * p_size / 10000.0 AS ha FROM part WHERE p_partkey % 5 <> 1),
s AS (SELECT (SELECT sum(v * ha) FROM t JOIN f USING (k)) AS a, (SELECT sum(v * p_size * p_size / 10000.0) FROM t JOIN part ON p_partkey = k) AS b)
SELECT round(a, 4) AS raster_total, round(b, 4) AS table_total, round(a - b, 4) AS difference, round((a - b) / nullif(b, 0) * 100, 6) AS percent FROM s""")
def value_totals(spark, d):
    """A value table with text keys joined to features, some of which have no value and some values no feature, and both totals."""
    ha = (F.col("p_size") * F.col("p_size") / 10000.0).alias("ha")
    part = X.table(spark, d, "part")
    table = part.filter("p_partkey % 7 <> 3").select(F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("huc12"), F.col("p_retailprice").cast("string").alias("value"), ha)
    table = table.unionByName(spark.createDataFrame([("x1", "5", 1.0), ("000", "n/a", 1.0)], "huc12 string, value string, ha double"))
    values = V.value_table(table, "huc12", ["value", "ha"])
    features = part.filter("p_partkey % 5 <> 1").select(F.col("p_partkey").cast("string").alias("huc12"), ha)
    joined = V.valued(features, values.drop("ha"), "huc12")
    out = R.reconciled(V.total(joined, "value", "ha"), V.total(values, "value", "ha"))
    return out.select(*[F.round(c, 6 if c == "percent" else 4).alias(c) for c in out.columns])


@query("SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey) AS BIGINT) AS row_no FROM lineitem")
def row_numbers(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return files.numbered(rows, ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "row_no")


@query(f"WITH {ZONES}, {FEATURES}, {OVERLAP}, met AS (SELECT z.geoid, count(*) AS pairs FROM zones z JOIN features f ON f.x1 <= z.x1 + 200 AND f.x1 + s >= z.x1 AND f.y1 <= z.y1 + 200 AND f.y1 + s >= z.y1 GROUP BY z.geoid) SELECT geoid, pairs, (SELECT round(coalesce(sum(a), 0) / 1e4, 6) FROM overlap o WHERE o.geoid = met.geoid) AS intersect_area_ha FROM met")
def large_zones(spark, d):
    """Zones of 1600 cells against features of one to a hundred: pairs of both levels, and areas out of cells, most of them whole."""
    zones, features = X.zones(spark, d), X.features(spark, d)
    pairs = S.spatial_join(zones, features, 5.0).groupBy(F.col("l.geoid").alias("geoid")).agg(F.count("*").alias("pairs"))
    return pairs.join(S.overlay_area(zones, features, "geoid", 5.0), "geoid").select("geoid", "pairs", F.round("intersect_area_ha", 6).alias("intersect_area_ha"))


@query("SELECT p_partkey AS fid, round(p_size * p_size / 2.0, 3) AS area FROM part")
def reprojected_area(spark, d):
    """Triangles from EPSG:5070 to a zone of transverse Mercator, to longitude and latitude, and back."""
    geom = F.col("geom")
    out = X.triangles(spark, d).withColumn("geom", G.reprojected(geom, 5070, 26914)).withColumn("geom", G.reprojected(geom, 26914, 4326)).withColumn("geom", G.reprojected(geom, 4326, 5070))
    return out.select("fid", F.round(G.area(geom), 3).alias("area"))


# Band between two parallels, a degree wide: its area on the ellipsoid is the difference of the authalic function, times the squared axis and half the width.
BAND = "(1 - {e2}) * (sin(radians({lat})) / (1 - {e2} * sin(radians({lat})) ** 2) - ln((1 - {e} * sin(radians({lat}))) / (1 + {e} * sin(radians({lat})))) / (2 * {e}))"
_E2 = 2 / 298.257223563 - 1 / 298.257223563**2


@query(f"SELECT s_suppkey, round({6378137.0**2} * (pi() / 180 * 64) / 2 * ({BAND.format(e2=_E2, e=_E2**0.5, lat='lat + 0.5')} - {BAND.format(e2=_E2, e=_E2**0.5, lat='lat')}) / 1e6 / 1e4, 3) AS km2 FROM (SELECT s_suppkey, CAST(s_suppkey % 80 AS DOUBLE) AS lat FROM supplier)")
def band_areas(spark, d):
    """Bands of half a degree of latitude and 64 of longitude, their parallels cut to sides of 1/64 degree, which shortest lines follow to the digits shown."""
    lat = (F.col("s_suppkey") % 80).cast("double")
    along = F.sequence(F.lit(0), F.lit(4096))
    south, north = F.transform(along, lambda i: F.array(i / 64.0, lat)), F.transform(F.reverse(along), lambda i: F.array(i / 64.0, lat + 0.5))
    ring = F.flatten(F.concat(south, north, F.slice(south, 1, 1)))
    bands = X.spread(X.table(spark, d, "supplier").select("s_suppkey"), "s_suppkey").select("s_suppkey", F.array(ring).alias("geom"))
    return bands.select("s_suppkey", F.round(G.area_ha(F.col("geom"), F.lit(4326)) / 1e6, 3).alias("km2"))
