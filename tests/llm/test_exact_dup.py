"""Exact duplicates against plain grouping, filters against counting, and texts that share a fingerprint."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import exact_dup
from quadrille.llm.exact_dup import exact_duplicates, filter_rows, merged, repeated_fingerprints, unpacked_block

ROWS = [(7, "a  b"), (3, "a b"), (9, "a\tb"), (9, "a\tb"), (4, "A b"), (5, None), (6, ""), (1, "  "), (2, " "), (None, "a b"), (None, "alone"), (None, "pair"), (None, "pair "), (8, "x" * 200_000), (10, "x" * 200_000), (11, "x" * 199_999 + "y"), (12, "a b")]


def brute(rows):
    text = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[text(t)].append(i)
    for i, t in rows:
        ids = groups[text(t)]
        keep = min((x for x in ids if x is not None), default=None)
        yield i, keep, len(ids), i == keep, hashlib.sha256(text(t).encode()).hexdigest()


def told(df, **options):
    return Counter(tuple(r) for r in exact_duplicates(df, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_matches_grouping(spark, parts):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("keep_id", F.lit(1)).repartition(parts)
    assert told(df) == Counter(brute(ROWS))
    assert exact_duplicates(df.limit(0)).count() == 0


def test_texts_that_share_a_fingerprint_stay_apart(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    assert told(df, fingerprint=lambda c: F.length(c).cast("long")) == Counter(brute(ROWS))
    assert told(df, fingerprint=lambda c: F.lit(5).cast("long")) == Counter(brute(ROWS))


def test_hot_group_is_dealt_out(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = exact_duplicates(df.repartition(7)).agg(F.sum(F.col("kept").cast("int")), F.max("group_size")).first()
    assert tuple(got) == (2001, 1000)


def test_filters_lose_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    prints = np.concatenate([rng.integers(0, 2**64, 5000, np.uint64), np.repeat(rng.integers(0, 2**64, 40, np.uint64), 50), np.array([0, 0, 2**64 - 1, 2**64 - 1, 1], np.uint64)])
    for block_bits in (1, 6, 14):
        values, counts = np.unique(prints, return_counts=True)
        rows = filter_rows(prints, block_bits).to_pylist()
        back = [unpacked_block(r.pop("block"), block_bits, **r) for r in rows]
        assert np.array_equal(np.concatenate([v for v, _ in back]), values) and np.array_equal(np.concatenate([c for _, c in back]), counts)
        for held in (exact_dup.HELD, 5):
            monkeypatch.setattr(exact_dup, "HELD", held)
            import pyarrow as pa

            parts = [filter_rows(p, block_bits) for p in np.array_split(prints, 7)]
            rows = sorted((r for p in parts for r in p.to_pylist()), key=lambda r: r["block"])
            out = [r for b in merged(block_bits)(iter([pa.RecordBatch.from_pylist(rows[:100], schema=parts[0].schema), pa.RecordBatch.from_pylist(rows[100:], schema=parts[0].schema)])) for r in b.to_pylist()]
            want = {int(v): int(c) for v, c in zip(values.view(np.int64), counts, strict=True) if c > 1}
            assert {r["__fp"]: r["n"] for r in out} == want and len(out) == len(want)


def test_repeated_fingerprints_of_a_table(spark):
    df = spark.range(20_000).select(F.xxhash64(F.col("id") % 15_000).alias("fp")).repartition(6)
    got = {r["__fp"]: r["n"] for r in repeated_fingerprints(df).collect()}
    assert got == {r["fp"]: r["count"] for r in df.groupBy("fp").count().filter("count > 1").collect()} and len(got) == 5000
