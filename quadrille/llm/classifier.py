"""A quality classifier trained without labels: a label model's posteriors teach a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, staged, unstage
from .label_model import fit, pattern_counts
from .quality_rules import Rule, default_rules, measures
from .text import SLICE, mix

BITS = 15
#: A labeller votes +1 on at least this share of the good documents it votes on: its limits for -1 are far from ordinary text.
PRECISE = 0.995


def features(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, text, bucket, value): hashed byte trigrams, damped counts, each text of length 1.

    Texts are worked off in stretches, so that memory does not follow the longest text;
    a text's counts add up over its stretches.
    """
    first = 0
    while first < len(texts):
        last, size, keys, seen = first, 0, [], []
        while last < len(texts) and (last == first or size < SLICE):
            raw = np.frombuffer(b" " + texts[last].encode("utf-8", "surrogatepass") + b" ", np.uint8)
            for at in range(0, max(1, len(raw) - 2), 4 * SLICE):
                part = raw[at : at + 4 * SLICE + 2].astype(np.uint32)
                gram = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
                bucket = (mix(gram) >> np.uint64(64 - BITS)).astype(np.int64)
                n = np.bincount(bucket, minlength=0) if len(bucket) > 1 << BITS else None
                if n is None:
                    b, c = np.unique(bucket, return_counts=True)
                else:
                    b = np.flatnonzero(n)
                    c = n[b]
                keys.append(b + ((last - first) << BITS))
                seen.append(c)
            size += len(raw)
            last += 1
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        value = np.log1p(np.bincount(where, np.concatenate(seen), len(key)))
        doc = key >> BITS
        norm = np.sqrt(np.bincount(doc, value * value, last - first))
        yield first, last, doc, key & ((1 << BITS) - 1), value / norm[doc]
        first = last


def train(doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, steps: int = 300, rate: float = 20.0, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft targets by gradient descent with momentum; classes weigh alike. The last weight is the bias."""
    w = np.zeros((1 << BITS) + 1)
    pull, n = np.zeros_like(w), len(target)
    good = target.sum()
    weight = target * (n / 2 / max(good, 1.0)) + (1 - target) * (n / 2 / max(n - good, 1.0))
    for _ in range(steps if n else 0):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, w[bucket] * value, n) + w[-1], -40, 40)))
        error = (p - target) * weight / n
        grad = np.append(np.bincount(bucket, error[doc] * value, 1 << BITS), 0.02 * error.sum()) + decay * w
        pull = 0.9 * pull - rate * grad
        w = w + pull
    return w


def quality_classifier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = 4000, sample_bytes: int = 64 << 20, threshold: float = 0.5) -> DataFrame:
    """(id, label_posterior, score, kept) of every document, one row per row of ``docs``.

    Overlapping heuristic labellers (by default all quality rules but that on length,
    which says nothing about wording) vote or abstain on every whole text; a label
    model estimates their accuracies over all documents by expectation-maximisation.
    A linear scorer over hashed byte trigrams is trained on the posteriors of the
    documents with the smallest hashes of id and text, ``sample_rows`` of them or, if
    those are fewer, as many as have ``sample_bytes`` of features (which is all that
    reaches the driver; a document has at most 192 KB), and scores all documents.
    ``kept``: score >= threshold.

    Null text counts as empty; an empty text has one feature, the blank. Repeated
    rows score alike. A null id is allowed. An empty table gives no rows.
    """
    rules = [r for r in default_rules() if r.name != "length"] if rules is None else rules
    spark = docs.sparkSession
    base = packed(docs, id_col, text_col).select("__id", "__text")
    # Texts are measured once; what is kept of them is their votes.
    votes = [f"vote{j}" for j in range(len(rules))]
    judged = measures(base).select("__id", F.xxhash64(F.lit(5), "__id", "__text").alias("turn"), *[r.vote().cast("byte").alias(v) for r, v in zip(rules, votes, strict=True)])
    judged, _ = staged(judged, "classifier-votes")
    model = fit(pattern_counts(judged, [F.col(v) for v in votes]), len(rules), precise=PRECISE)
    posterior = model.posterior([F.col(v) for v in votes])
    sample = judged.select("turn", posterior.alias("target")).dropDuplicates(["turn"]).orderBy("turn").limit(sample_rows)
    taught, _ = staged(sample, "classifier-sample")
    texts = base.withColumn("turn", F.xxhash64(F.lit(5), "__id", "__text")).join(F.broadcast(taught), "turn").select("turn", "target", "__text").dropDuplicates(["turn"])

    def describe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for a, b, doc, bucket, value in features(part["__text"].tolist()):
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                pairs = list(zip(cut[:-1], cut[1:], strict=True))
                yield pd.DataFrame({"turn": part["turn"].to_numpy()[a:b], "target": part["target"].to_numpy()[a:b], "buckets": [bucket[s:e].astype(np.uint16).tobytes() for s, e in pairs], "values": [value[s:e].astype(np.float32).tobytes() for s, e in pairs]})

    told, told_path = staged(texts.mapInPandas(describe, "turn long, target double, buckets binary, values binary"), "classifier-features")
    sizes = told.select("turn", (F.length("buckets") + F.length("values")).alias("size")).orderBy("turn").collect()  # two numbers a row of the sample
    fits = int(np.searchsorted(np.cumsum([r["size"] for r in sizes]), sample_bytes, "right"))
    rows = told.filter(F.col("turn") <= sizes[fits - 1]["turn"]).orderBy("turn").collect() if fits else []
    unstage(spark, told_path)
    buckets = [np.frombuffer(r["buckets"], np.uint16).astype(np.int64) for r in rows]
    values = [np.frombuffer(r["values"], np.float32).astype(float) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(b) for b in buckets])
    joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    weights = spark.sparkContext.broadcast(train(doc, joined(buckets, np.int64), joined(values, float), np.array([r["target"] for r in rows])))

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = weights.value
        for part in parts:
            out = [np.bincount(doc, w[bucket] * value, b - a) + w[-1] for a, b, doc, bucket, value in features(part["__text"].tolist())]
            yield pd.DataFrame({"id": part["id"], "turn": part["turn"], "logit": np.concatenate(out) if out else []})

    scored = base.select(F.col("__id").cast("string").alias("id"), F.xxhash64(F.lit(5), "__id", "__text").alias("turn"), "__text").mapInPandas(score, "id string, turn long, logit double")
    known = judged.select("turn", posterior.alias("label_posterior")).dropDuplicates(["turn"])
    chance = 1 / (1 + F.exp(-F.col("logit")))
    return scored.join(known, "turn").select(F.col("id").cast("long").alias(id_col), "label_posterior", chance.alias("score"), (chance >= threshold).alias("kept"))
