"""Documents without words are shown as often as their source is passed over whole; targets are met."""

import math
from collections import Counter

from pyspark.sql import functions as F

from quadrille.llm.mixing import mixed, schedule


def test_wordless_documents_of_a_single_source(spark):
    rows = [(0, "some words here", "s"), *[(i, ["", " \n", None][i % 3], "s") for i in range(1, 60)]]
    got = schedule(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r["id"], r["pass"]) for r in got) == [(i, 0) for i in range(60)]


def sized(spark):
    """Three sources of 60, 300 and 1200 documents of ten words."""
    rows = [(i, f"w{i} " + "a b c d e f g h i", "x" if i < 60 else "y" if i < 360 else "z") for i in range(1560)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def shares(rows):
    seen = Counter()
    for r in rows:
        seen[r["source"]] += r["tokens"]
    return {s: n / sum(seen.values()) for s, n in seen.items()}


def test_entropy_target_and_budget(spark):
    target = 0.9
    got = shares(schedule(sized(spark), max_repeats=None, target_entropy=target, budget=12000).collect())
    assert abs(-sum(p * math.log(p) for p in got.values()) - target) < 0.01
    # The weights are powers of the natural shares: logs of ratios keep their proportion.
    assert abs(math.log(got["z"] / got["y"]) / math.log(4) - math.log(got["y"] / got["x"]) / math.log(5)) < 0.03


def test_blocks_and_the_documents_shown(spark):
    docs = sized(spark).withColumn("mix_pass", F.lit("clash"))
    rows = schedule(docs, block_docs=50).collect()
    assert Counter((r["id"], r["pass"]) for r in rows).most_common(1)[0][1] == 1
    out = mixed(docs, block_docs=50).collect()
    assert Counter((r["doc_id"], r["mix_pass"]) for r in out) == Counter((r["id"], r["pass"]) for r in rows)
    for s in "xyz":
        places = sorted(r["position"] for r in rows if r["source"] == s)
        assert len(set(places)) == len(places) and places[0] == 0.0 and places[-1] < 1
