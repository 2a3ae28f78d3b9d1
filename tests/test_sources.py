"""Round trips of layers, keyed tables, job files and listings, and what is refused."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as G
from quadrille.sources import files, geopackage

HOLED = [[0.0, 0.0, 9.0, 0.0, 9.0, 9.0, 0.0, 9.0, 0.0, 0.0], [1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0, 1.0, 1.0, 1.0]]


@pytest.fixture
def layer(spark, tmp_path):
    geopackage.register(spark)
    rows = [(i, f"n{i}", i * 0.5, i % 2 == 0, [[[i + v for v in HOLED[0]]], HOLED, None][i % 3] if i % 3 else HOLED) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "fid long, name string, v double, even boolean, geom array<array<double>>").withColumn("geom", G.to_wkb("geom"))
    path = f"{tmp_path}/a/b/layer"
    df.repartition(3).write.format("geopackage").mode("append").option("layer", "zones").option("srid", 5070).save(path)
    return df, path


def test_layer_round_trip(spark, layer):
    df, path = layer
    got = spark.read.format("geopackage").option("rowsPerTask", 4).load(path)
    assert sorted(map(tuple, got.select("fid", "name", "v", "even", G.from_wkb("geom")).collect())) == sorted(map(tuple, df.select("fid", "name", "v", "even", G.from_wkb("geom")).collect()))
    assert geopackage.system_of(path) == 5070 and len(geopackage.files_of(path)) == 3
    con = sqlite3.connect(geopackage.files_of(path)[0])
    assert con.execute("SELECT count(*) FROM rtree_zones_geom").fetchone() == con.execute("SELECT count(geom) FROM zones").fetchone()


def test_filters_reach_the_file(spark, layer):
    _, path = layer
    read = spark.read.format("geopackage").option("includeGeometry", "false").load(path)
    assert read.columns == ["fid", "name", "v", "even"]
    some = read.filter(F.col("name").isin("n3", "n7") | (F.col("fid") == 5)).filter("v > 2")
    assert sorted(r["fid"] for r in some.collect()) == [5, 7]
    assert [r["name"] for r in read.filter("fid = 9").collect()] == ["n9"]
    assert sorted(r["fid"] for r in read.filter(F.col("fid").isin(3, 4)).collect()) == [3, 4]


def test_what_is_there_is_refused_or_replaced(spark, layer):
    df, path = layer
    with pytest.raises(Exception, match="is there already"):
        df.write.format("geopackage").mode("append").save(path)
    df.filter("fid < 4").write.format("geopackage").mode("overwrite").save(path)
    assert spark.read.format("geopackage").load(path).count() == 3
    with pytest.raises(Exception, match="no layer"):
        spark.read.format("geopackage").option("layer", "other").load(path)


def test_keyed_tables(spark, tmp_path):
    path = files.write_csv(spark.createDataFrame([("007", 1, "a,\nb"), ("010", 2, None)], "geoid string, n int, t string").select("geoid", "n"), f"{tmp_path}/x/t")
    got = files.read_keyed(spark, path, "geoid")
    assert dict(got.dtypes) == {"geoid": "string", "n": "int"} and sorted(map(tuple, got.collect())) == [("007", 1), ("010", 2)]
    assert files.read_keyed(spark, path, "geoid", ["n"]).columns == ["n"] and dict(files.read_keyed(spark, path).dtypes)["geoid"] == "int"
    with pytest.raises(Exception, match="already exists"):
        files.write_csv(got, path)
    with pytest.raises(ValueError, match="missing fields: nope"):
        files.read_keyed(spark, path, "nope")


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1, "ok", None), (2, "error", "broken")], "fid long, status string, reason string")
    assert files.write_failures(rows, f"{tmp_path}/f", ["fid"]) and not files.write_failures(rows.filter("fid = 1"), f"{tmp_path}/g", ["fid"])
    assert spark.read.csv(f"{tmp_path}/f", header=True).collect() == [("2", "broken")] and not (tmp_path / "g").exists()
    assert files.summary(spark.createDataFrame([("ok", 12345), ("error", 1)], "s string, n long"), "s", "n") == "error=1 ok=12,345"
    bad = spark.sql("SELECT X'61FF62' AS b, array(X'FF', X'63') AS l, 3 AS n")
    assert files.plain_text(bad).first() == ("a�b", "�,c", 3)
    assert files.measured(bad.withColumn("geom", F.lit(1)), "n", "b").columns == ["n", "b", "l"]


def test_numbers_and_chunks(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("k")).repartition(7)
    assert all(r["row_no"] == r["k"] + 1 for r in files.numbered(df, "k").collect())
    assert {r["chunk"]: r["count"] for r in files.chunked(df, "k").groupBy("chunk").count().collect()} == {i: 100 for i in range(10)}
    assert files.numbered(df.limit(0), "k").count() == 0


def test_jobs(tmp_path):
    (tmp_path / "jobs.ini").write_text("[project]\nname = p\nout = ./results\n[job:one]\nraster = ../r.tif ; comment\n[job:two]\nops = mean,sum\n")
    project, jobs = files.read_jobs(str(tmp_path / "jobs.ini"))
    assert project == {"name": "p", "out": f"{tmp_path}/results"} and [j["name"] for j in jobs] == ["one", "two"]
    assert jobs[0]["raster"] == f"{tmp_path.parent}/r.tif" and jobs[1]["ops"] == "mean,sum"


def test_listing(spark, tmp_path):
    for name in ("b_20260101_000000.csv", "a.csv", "c.txt"):
        (tmp_path / name).write_text("x")
    got = files.listing(spark, str(tmp_path), "*.csv").collect()
    assert sorted((r["position"], r["stem"], r["suffix"]) for r in got) == [(1, "a", ".csv"), (2, "b_20260101_000000", ".csv")]


def test_numbers_of_many_rows_have_no_gap(spark):
    """Wide rows in several sorted partitions: a second run of the sort would deal them out anew."""
    n = 600_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("wide"), F.rand(1).alias("other")).repartition(16)
    out = files.numbered(rows, "k")
    got = out.agg(F.count("*"), F.countDistinct("row_no"), F.min("row_no"), F.max("row_no"), F.count_if(F.col("row_no") != F.col("k") + 1)).first()
    assert tuple(got) == (n, n, 1, n, 0)
    chunks = files.chunked(rows.select("k"), "k", 1000).groupBy("chunk").count()
    assert tuple(chunks.agg(F.count("*"), F.min("count"), F.max("count")).first()) == (600, 1000, 1000)
    left = spark.createDataFrame([("b", 2), ("a", 3), ("c", 1)], "key string, at int")
    right = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("x", 9.0)], "key string, v double")
    assert sorted(map(tuple, files.reindexed(left, right, "key", "at").collect()), key=lambda r: r[1]) == [("c", 1, None), ("b", 2, 2.0), ("a", 3, 1.0)]
