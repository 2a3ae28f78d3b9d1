"""Archives are read the same when files are packed anew between the jobs of one read."""

from quadrille.llm import warc


def test_files_packed_anew_between_jobs(spark, tmp_path, monkeypatch):
    rows = [(i, "u", f"page {i} " * 50) for i in range(240)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), records_per_file=20)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    chain = warc.reachable

    def packed_anew(links):
        out = chain(links)
        spark.conf.set("spark.sql.files.minPartitionNum", "12")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return out

    monkeypatch.setattr(warc, "reachable", packed_anew)
    try:
        got = warc.page_records(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    finally:
        for k in ("maxPartitionBytes", "minPartitionNum", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{k}")
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got} == {i: t for i, _, t in rows}
