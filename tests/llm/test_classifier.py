"""The classifier's features against plain Python, and its verdicts on labelled documents it was not trained on."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quadrille.llm import classifier, text
from quadrille.llm.classifier import BITS, features, quality_classifier
from quadrille.llm.common import table

DIR = "/root/testdata/sf0.01"


def test_features_of_whole_texts(monkeypatch):
    """Stretches of a long text count as one text."""
    monkeypatch.setattr(classifier, "SLICE", 16)
    texts = ["", "abcabcabc", "é😀 x " * 60, "the end", "y" * 500]
    got = {}
    for a, b, doc, bucket, value in features(texts):
        for d in range(b - a):
            got[a + d] = dict(zip(bucket[doc == d].tolist(), value[doc == d].tolist(), strict=True))
    for i, t in enumerate(texts):
        raw = b" " + t.encode() + b" "
        grams = np.array([raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2] for k in range(len(raw) - 2)], np.uint64)
        n = Counter((text.mix(grams) >> np.uint64(64 - BITS)).tolist())
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in n.values()))
        assert got.get(i, {}).keys() == n.keys()
        assert all(math.isclose(got[i][k], math.log1p(c) / norm) for k, c in n.items())


def test_labelled_documents_left_out_of_training(spark):
    """Labels are never seen in training; of 1000 documents 300 are, by the posteriors of the rules alone."""
    docs = table(spark, DIR, "documents")
    seen = docs.select("doc_id", F.xxhash64(F.lit(5), "doc_id", F.coalesce("text", F.lit(""))).alias("turn")).orderBy("turn").limit(300).select("doc_id")
    labels = table(spark, DIR, "labels").select("doc_id", F.col("quality").alias("truth"))
    got = quality_classifier(docs, sample_rows=300).join(labels, "doc_id").join(seen, "doc_id", "left_anti").select("kept", "truth").collect()
    good, bad = ([r["kept"] for r in got if r["truth"] == y] for y in (1, 0))
    print(f"held out: {sum(good)} of {len(good)} good documents kept, {len(bad) - sum(bad)} of {len(bad)} bad ones rejected")
    assert len(good) > 100 and sum(good) >= 0.97 * len(good)
    assert len(bad) > 10 and len(bad) - sum(bad) >= 0.9 * len(bad)


def plain_scores(texts, targets, steps=300, rate=20.0, decay=1e-5):
    """The scorer as dense matrices: features one by one, gradient descent with momentum; the chance of each text."""
    x = np.zeros((len(texts), (1 << BITS) + 1))
    for i, t in enumerate(texts):
        raw = b" " + t.encode("utf-8", "surrogatepass") + b" "
        n = Counter((text.mix(np.array([raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2] for k in range(len(raw) - 2)], np.uint64)) >> np.uint64(64 - BITS)).tolist())
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in n.values()))
        for b, c in n.items():
            x[i, b] = np.float32(math.log1p(c) / norm)
    used = np.flatnonzero(x.any(axis=0))
    x = x[:, used]
    y = np.array(targets)
    weigh = y * len(y) / 2 / max(y.sum(), 1) + (1 - y) * len(y) / 2 / max((1 - y).sum(), 1)
    w, bias, pull, bias_pull = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    for _ in range(steps):
        error = (1 / (1 + np.exp(-np.clip(x @ w + bias, -40, 40))) - y) * weigh / len(y)
        pull, bias_pull = 0.9 * pull - rate * (x.T @ error + decay * w), 0.9 * bias_pull - rate * (0.02 * error.sum() + decay * bias)
        w, bias = w + pull, bias + bias_pull
    return 1 / (1 + np.exp(-(x @ w + bias)))


def test_scores_against_dense_matrices(spark):
    """All of the smallest table is the sample; a part of it where the bytes say so."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in quality_classifier(docs).collect()}
    assert sorted(got) == sorted(texts)
    ids = sorted(texts)
    want = plain_scores([texts[i] for i in ids], [got[i]["label_posterior"] for i in ids])
    for i, s in zip(ids, want, strict=True):
        assert math.isclose(got[i]["score"], s, abs_tol=1e-4) and got[i]["kept"] == (got[i]["score"] >= 0.5)
    few = {r["doc_id"]: r["score"] for r in quality_classifier(docs, sample_bytes=100_000).collect()}
    assert sorted(few) == ids and any(abs(few[i] - got[i]["score"]) > 1e-3 for i in ids)


def test_no_rows_nulls_and_repeats(spark):
    """An empty table, null ids and texts, repeated rows, and columns named like those within."""
    schema = "doc_id long, text string, turn string, `label_posterior` int"
    assert quality_classifier(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "the cat and the dog", "x", 1), (1, None, None, None), (2, "", "y", 2), (2, "", "y", 2), (3, "spam " * 40, "z", 3)]
    got = quality_classifier(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1), (False, 2), (False, 2), (False, 3), (True, 0)]
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
