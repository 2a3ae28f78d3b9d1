"""Batches against a plain fold, with blocks so small that chains pass through many; and combining many tables at once."""

import random

import pytest
from pyspark.sql import functions as F

from quadrille.operators import attributes as T
from quadrille.operators.batching import batches


def folded(rows, limit):
    out, total, batch, at = {}, 0, 0, object()
    for g, o, w in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        if g != at:
            at, total, batch = g, 0, 0
        out[g, o] = batch
        total += max(w if w is not None else 1, 1)
        if total >= limit:
            total, batch = 0, batch + 1
    return out


@pytest.mark.parametrize(("limit", "block"), [(30, 64), (1, 50), (500, 100), (7, 100_000), (100_000, 64)])
def test_matches_a_fold(spark, limit, block):
    rng = random.Random(limit)
    rows = [(g, o, rng.choice([None, 0, 1, 2, 5, 60])) for g, n in (("a", 1500), ("b", 1), (None, 40), ("c", 128), ("d", 700)) for o in range(n)]
    shuffled = rng.sample(rows, len(rows))
    out = batches(spark.createDataFrame(shuffled, "g string, o int, w int").repartition(5), "g", "o", "w", limit, block)
    got = {(r["g"], r["o"]): r["batch"] for r in out.collect()}
    assert got == folded(rows, limit) and len(got) == len(rows)


def test_one_large_group(spark):
    n, limit = 1_000_000, 10_000
    rows = spark.range(n).select(F.lit("g").alias("g"), "id", (F.col("id") % 199 + 1).cast("int").alias("w"))
    out = batches(rows, "g", "id", "w", limit, 1 << 15)
    total, batch, firsts = 0, 0, [0]
    for i in range(n):
        total += i % 199 + 1
        if total >= limit:
            total, batch = 0, batch + 1
            firsts.append(i + 1)
    got = out.groupBy("batch").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.count("*").alias("n")).orderBy("batch").collect()
    firsts = [f for f in firsts if f < n]
    assert [r["a"] for r in got] == firsts and [r["batch"] for r in got] == list(range(len(firsts))) and all(r["n"] == r["z"] - r["a"] + 1 for r in got)
    assert batches(rows.limit(0), "g", "id", "w", 5).count() == 0


def test_many_tables_are_combined_in_one_shuffle(spark):
    base = spark.range(200).select(F.format_string("%03d", "id").alias("k"), F.col("id").cast("double").alias("shared"))
    frames = [(f"t{i}", base.select(F.col("k"), *(["shared"] if i % 3 == 0 else []), (F.col("shared") + i).alias(f"m{i}")).repartition(3)) for i in range(15)]
    seen = []
    plain = T.staged
    try:
        T.staged = lambda df, tag: seen.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, tag)
        out = T.combine(frames, "k")
    finally:
        T.staged = plain
    assert seen[0].count("Exchange hashpartitioning") == 1 and out.columns == ["k", "shared", *[f"m{i}" for i in range(15)]]
    assert out.count() == 200 and out.filter(" AND ".join(f"m{i} = shared + {i}" for i in range(15))).count() == 200
    with pytest.raises(ValueError, match=r"t14: columns that differ: m2 \['003', '007'\]"):
        T.combine([*frames[:14], ("t14", base.select("k", F.when(F.col("k").isin("003", "007"), -1.0).otherwise(F.col("shared") + 2).alias("m2")))], "k")
    with pytest.raises(ValueError, match=r"t1: repeated keys \['000', .*'009'\]"):
        T.combine([frames[0], ("t1", base.select("k").union(base.select("k")))], "k")
    with pytest.raises(ValueError, match=r"t1: keys without a partner in t0 \[None\]"):
        T.combine([frames[0], ("t1", base.select("k").union(spark.createDataFrame([(None,)], "k string")))], "k")
