"""Ties, repeated rows, empty tables and clashing names of search, line dedup and archives."""

from collections import Counter

from pyspark.sql import functions as F

from quadrille.llm.line_dedup import line_dedup
from quadrille.llm.topk_search import exact_topk
from quadrille.llm.warc import page_records, read_warc, write_warc


def test_topk_ties_and_empty_table(spark):
    rows = [(i, [1.0, 0.5], "clash") for i in range(40)] + [(50, [-1.0, 0.25], "clash")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = exact_topk(df, F.col("id") % 50 == 0, block_bytes=64, least_blocks=4).collect()
    by = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got}
    # 256 * 256 + 128 * 128 for all alike: the smallest ids but the query's own.
    assert [by[0, k] for k in range(1, 6)] == [(i, 81920) for i in range(1, 6)]
    assert [by[50, k] for k in range(1, 6)] == [(i, -65536 + 64 * 128) for i in range(5)] and len(got) == 10
    assert exact_topk(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert exact_topk(df.limit(3), F.col("id") % 50 == 0).count() == 2


def test_lines_of_repeated_rows_and_of_several_documents(spark):
    rows = [(1, "a line of three\nb", 9), (2, "A LINE of three\t\nc", 9), (3, " a line of three", 9), (4, "only in this one\nonly in this one", 9), (4, "only in this one\nonly in this one", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    kept = lambda **o: Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup(df, **o).collect())
    alone = {(4, rows[3][1], 2, 0): 2}
    assert kept() == Counter({(1, rows[0][1], 2, 0): 1, (2, "c", 2, 1): 1, (3, "", 1, 1): 1, **alone})
    assert kept(max_docs=2) == kept()
    assert kept(max_docs=3) == Counter({**{(i, t, t.count("\n") + 1, 0): 1 for i, t, _ in rows[:3]}, **alone})


def test_archives_of_an_empty_table_and_of_repeated_rows(spark, tmp_path):
    rows = [(7, "u\r\nWARC-Type: x", "same"), (7, "u", "same"), (9, "v", "same"), (3, "w", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("first", F.lit(1))
    write_warc(pages, str(tmp_path / "a"))
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in page_records(read_warc(spark, str(tmp_path / "a"))).collect())
    assert got == Counter({(7, "response", None, 4): 2, (9, "revisit", 7, 4): 1, (3, "response", None, 5): 1})
    write_warc(pages, str(tmp_path / "b"), min_bytes=5)
    assert all(r["record_type"] == "response" for r in page_records(read_warc(spark, str(tmp_path / "b"))).collect())
    write_warc(pages.limit(0), str(tmp_path / "c"))
    assert page_records(read_warc(spark, str(tmp_path / "c"))).count() == 0
