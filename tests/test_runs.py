"""Runs from files to files: zonal jobs, land products, combined results with conflicts, command lines."""

import json

import pytest
from pyspark.sql import functions as F

from quadrille.__main__ import run
from quadrille.functions import geometry as G
from quadrille.operators import rasters as R
from quadrille.plans.combine import CLASSES, Group, combine_results, geometry_conflicts
from quadrille.plans.products import job_suffix, zone_product
from quadrille.plans.zonal import jobs_of
from quadrille.sources import geopackage, rasters

RING = "geom array<array<double>>"


def box(x1, y1, x2, y2):
    return [[float(v) for v in (x1, y1, x2, y1, x2, y2, x1, y2, x1, y1)]]


def layer(spark, rows, columns, path, name="layer"):
    geopackage.register(spark)
    df = spark.createDataFrame(rows, f"{columns}, {RING}").withColumn("geom", G.to_wkb("geom"))
    df.coalesce(1).write.format("geopackage").mode("append").option("layer", name).option("srid", 5070).save(path)


def test_self_test_rows(spark, tmp_path):
    """Three groups of five jobs; class areas of masks; then a newer file that disagrees."""
    jobs = ("ecosystem_services", "masks", "area", "freshwater_area", "coastline")
    groups = [Group(g, f"{g}_all", tuple(f"{g}_{j}" for j in jobs)) for g in ("counties", "districts", "basins")]
    for g in groups:
        (tmp_path / "in" / g.name).mkdir(parents=True)
        for i, j in enumerate(g.jobs):
            masks = [f"{p}_reclassified_NLCD2023_{c}_2026_01_01_00_00_00" for c in CLASSES for p in ("area_ha_valid", "proportion_valid_nonzero")] if j.endswith("masks") else []
            values = lambda k, m=masks: ["", *[str(v) for c in range(len(CLASSES)) for v in (100.0 * k, 0.1 * k * (c + 1))]] if m else [""]
            rows = [",".join(["GEOID", "county_name", f"metric_{i}", *masks])] + [f"00{k},{'AB'[k - 1]},{i + k - 1}{','.join(values(k))}" for k in (1, 2)]
            (tmp_path / "in" / g.name / f"{j}_20260101_000000.csv").write_text("\n".join(rows) + "\n")
    (tmp_path / "g.json").write_text(json.dumps([{"name": g.name, "output": g.output, "jobs": g.jobs} for g in groups]))
    written = run(spark, ["combine", str(tmp_path / "in"), str(tmp_path / "out"), "--groups", str(tmp_path / "g.json")])
    assert len(written) == 3
    for path in written:
        got = spark.read.csv(path, header=True, inferSchema=True).orderBy("metric_0").collect()
        assert not any(c.startswith("area_ha_valid") for c in got[0].asDict()) and [r["metric_4"] for r in got] == [4, 5]
        for c, name in enumerate(CLASSES):
            assert [round(r[f"area_ha_nlcd_{name}"], 9) for r in got] == [10.0 * (c + 1), 40.0 * (c + 1)]
    (tmp_path / "in" / "counties" / "counties_masks_20260102_000000.csv").write_text("GEOID,county_name,metric_conflict\n001,changed,1\n002,B,2\n")
    with pytest.raises(ValueError, match=r"columns that differ: county_name \['001'\]"):
        combine_results(spark, str(tmp_path / "in"), str(tmp_path / "out2"), groups)
    with pytest.raises(FileNotFoundError, match="not there"):
        run(spark, ["zonal", str(tmp_path / "none.ini")])


def test_layers_are_combined_and_their_geometry_checked(spark, tmp_path):
    for name, last in (("a_20260101_000000", 3), ("b_20260101_000000", 3), ("c_20260101_000000", 4)):
        layer(spark, [("001", 1.0, box(0, 0, 1, 1)), ("002", 2.0, box(2, 0, last, 1))], f"GEOID string, m_{name[0]} double", f"{tmp_path}/draft/{name}")
        (part,) = (tmp_path / "draft" / name).glob("*.gpkg")
        (tmp_path / "in").mkdir(exist_ok=True)
        part.rename(tmp_path / "in" / f"{name}.gpkg")
    (path,) = combine_results(spark, str(tmp_path / "in"), str(tmp_path / "out"), [Group("x", "both", ("a", "b"))], stamp="s", check_geometry=True)
    got = spark.read.format("geopackage").load(path).orderBy("GEOID").select("GEOID", "m_a", "m_b", G.area(G.from_wkb("geom")).alias("area")).collect()
    assert path.endswith("both_s.gpkg") and [tuple(r) for r in got] == [("001", 1.0, 1.0, 1.0), ("002", 2.0, 2.0, 1.0)]
    with pytest.raises(ValueError, match="geometries that differ: 002"):
        combine_results(spark, str(tmp_path / "in"), str(tmp_path / "out"), [Group("x", "all", ("a", "b", "c"))], check_geometry=True)
    some = lambda rows: spark.createDataFrame(rows, f"k string, {RING}").withColumn("geom", G.to_wkb("geom"))
    a, b = [("1", box(0, 0, 1, 1)), ("2", None), ("3", box(0, 0, 2, 2))], [("1", [box(0, 0, 1, 1)[0][2:8] + [0.0, 0.0, 1.0, 0.0]]), ("2", None), ("3", box(0, 0, 2, 3))]
    assert geometry_conflicts(some(a), some(b), "k") == ["2", "3"]  # another first vertex is no difference; null is


def test_zonal_jobs(spark, tmp_path):
    """Two zone sets over two rasters, read once each; a layer measured; what is refused before anything runs."""
    grid = R.Grid(0.0, 0.0, 1.0, 1.0, 8, 8, 16)
    tiles = R.tiles_of(spark.range(64).select(F.floor(F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"), F.col("id").cast("double").alias("value")), grid)
    for name in ("one", "two"):
        rasters.write_raster(tiles, grid, f"{tmp_path}/in/{name}.tif", "float32", -1, 5070)
    layer(spark, [("01", "west", box(0, 0, 4, 8)), ("02", "far", box(90, 90, 91, 91))], "GEOID string, name string", f"{tmp_path}/z.gpkg", "z")
    layer(spark, [(7, box(0, 0, 8, 4))], "HUC int", f"{tmp_path}/h.gpkg", "h")
    job = "[project]\nname = x\n[job:a]\nagg_vector = ./z.gpkg\nagg_layer = z\nagg_field = GEOID\noperations = sum, valid_count\nbase_raster_pattern = ./in/*.tif\noutput_csv = ./out/a.csv\n"
    more = "[job:b]\nagg_vector = ./h.gpkg\nagg_field = HUC\noperations = mean, intersect_area_ha\nbase_raster_pattern = ./in/one.tif\nbase_measure_vector = ./z.gpkg\nbase_measure_layer = z\noutput_csv = ./out/b.csv\noutput_gpkg = ./out/b.gpkg\n"
    (tmp_path / "jobs.ini").write_text(job + more)
    lines = run(spark, ["zonal", str(tmp_path / "jobs.ini"), "--cell", "4"])
    assert [x.split()[:2] for x in lines] == [["a", "csv"], ["b", "csv"], ["b", "gpkg"]]
    west = float(sum(i for i in range(64) if i % 8 < 4))
    a = spark.read.csv(f"{tmp_path}/out/a.csv", header=True, schema="GEOID string, name string, s1 double, v1 double, s2 double, v2 double").orderBy("GEOID").collect()
    assert open(tmp_path / "out" / "a.csv").readline().strip() == "GEOID,name,sum_one,valid_count_one,sum_two,valid_count_two"
    assert [tuple(r) for r in a] == [("01", "west", west, 32.0, west, 32.0), ("02", "far", 0.0, 0.0, 0.0, 0.0)]
    b = spark.read.format("geopackage").load(f"{tmp_path}/out/b.gpkg").first()
    assert (b["HUC"], b["mean_one"], round(b["intersect_area_ha"], 9)) == ("7", 15.5, 0.0016)
    for change, error, message in ((("agg_field = GEOID", "x = 1"), ValueError, "missing fields: agg_field"), (("sum,", "median,"), ValueError, "unknown operations: median"), (("./in/*.tif", "./none/*.tif"), FileNotFoundError, "no raster matches"), (("sum,", "intersect_area_ha,"), ValueError, "base_measure_vector")):
        (tmp_path / "bad.ini").write_text(job.replace(*change))
        with pytest.raises(error, match=message):
            jobs_of(str(tmp_path / "bad.ini"))


def test_land_products_stand_together(spark, tmp_path):
    codes = "fid long, Mang_Type string, Own_Type string, Mang_Name string, Own_Name string, Des_Tp string, Pub_Access string"
    rows = [(k, "FED" if k % 2 else "PVT", None, None, None, None, "OA", box(k, 0, k + 1, 1)) for k in range(1, 9)] + [(20, "FED", None, None, None, None, "XA", box(90, 90, 91, 91))]
    layer(spark, rows, codes, f"{tmp_path}/f")
    layer(spark, [(1, box(0, 0, 6, 5))], "fid long", f"{tmp_path}/b")
    (line,) = run(spark, ["lands", f"{tmp_path}/f", f"{tmp_path}/b", f"{tmp_path}/out", "--cell", "4", "--tolerance", "0.01"])
    assert line == "all=5 no_area=1 ok=5 outside=3 public=3" and not (tmp_path / "out" / "failures").exists()
    fids = lambda name: sorted(r[0] for r in spark.read.format("geopackage").load(f"{tmp_path}/out/layers/{name}").select("source_fid").collect())
    assert fids("all") == [1, 2, 3, 4, 5] and fids("public") == [1, 3, 5]
    bad = spark.createDataFrame([("ok", 1), ("a/b", 2)], "kind string, v int")
    with pytest.raises(Exception, match="no layer can be called"):
        bad.write.format("geopackage").mode("append").option("layerColumn", "kind").save(f"{tmp_path}/bad")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b", "f", "out"]


def test_masks_from_the_command_line(spark, tmp_path):
    grid = R.Grid(0.0, 0.0, 30.0, -30.0, 20, 20, 16)
    cells = spark.range(400).select(F.floor(F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"), (F.col("id") % 3 + 41).alias("value"))
    rasters.write_raster(R.tiles_of(cells, grid), grid, f"{tmp_path}/c.tif", "uint8", 0, 5070, "lzw")
    (tmp_path / "forests.csv").write_text("id,reclass\n41,1\n42,0\n")
    (path,) = run(spark, ["masks", f"{tmp_path}/c.tif", f"{tmp_path}/m", f"{tmp_path}/forests.csv"])
    values = [v for r in rasters.read_raster(spark, path).collect() for v in r["data"]]
    assert (values.count(1), values.count(0), values.count(None)) == (134, 133, 133) and path.endswith("m/forests.tif")


def test_names():
    assert zone_product("padus_public_lands_clipped_to_usa_2026_01_02_03_04_05", "s") == ("padus_public_lands_clipped_by_county", "padus_public_lands/padus_public_lands_clipped_by_county_s.gpkg")
    assert zone_product("nhd_water_20260102_030405", "s")[1] == "other/nhd_water_clipped_by_county_s.gpkg"
    assert job_suffix("masks_20260101_000000", "masks") == "20260101_000000"
