"""Rasters of events take every event, however many there are."""

import quadrille.plans.catalog as catalog

SMALL = "/root/testdata/sf0.001"
N = 25_050


def data(spark, path):
    spark.read.parquet(f"{SMALL}/nation.parquet").write.parquet(f"{path}/nation.parquet")
    spark.range(N).selectExpr("id AS event_id", "CASE WHEN id % 10 = 3 THEN 'error' ELSE 'view' END AS event_type", "CAST(id AS DOUBLE) AS value").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_zonal_stats_of_all_events(spark, tmp_path):
    got = catalog.QUERIES["zonal_stats"](spark, data(spark, tmp_path)).collect()
    fine = [i for i in range(N) if i % 10 != 3]
    assert len(got) == 25 and all(r["total_count"] > 0 for r in got)
    assert sum(r["total_count"] for r in got) == 251 * 100
    assert sum(r["valid_count"] for r in got) == len(fine) and abs(sum(r["sum"] for r in got) - sum(fine)) < 1


def test_masks_of_all_events(spark, tmp_path):
    got = {r["mask"]: (r["ones"], r["zeros"]) for r in catalog.QUERIES["reclass_masks"](spark, data(spark, tmp_path)).collect()}
    n = [sum((i // 100 * 7 + i % 100) % 5 == k for i in range(N)) for k in range(5)]
    assert got == {"forests": (n[1], n[0]), "wetlands": (n[3], n[2])}
