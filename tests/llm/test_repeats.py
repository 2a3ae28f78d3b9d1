"""Removal of repeated strings against brute force over all starts."""

import hashlib
import random
from collections import Counter

from quadrille.llm import entries, repeats
from quadrille.llm.repeats import remove_repeats

SCHEMA = "doc_id long, text string, extra string"


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((bytes(b for b, g in zip(t, gone) if not g), len(t), sum(gone), runs))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(n) for n in (70, 100, 300, 1200)]
    texts = [None, "", "short", "x" * 700, "xy" * 400]
    for k in range(60):
        texts.append(word(rng.randint(0, 200)) + rng.choice(shared) + word(rng.randint(0, 100)) + rng.choice(["", *shared]))
    for k in range(200):  # one context with many surroundings
        texts.append(word(30) + shared[2] + word(30))
    texts += [texts[10], texts[10]]
    rows = [(k if k % 17 else None, t, "e") for k, t in enumerate(texts)]
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), length=100).collect()
    want = brute([(t or "").encode() for t in texts], 100)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got], key=key) == sorted([(i, *w) for (i, _, _), w in zip(rows, want)], key=key)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def corpus(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    shared = [word(n) for n in (150, 400)]
    texts = [word(rng.randint(0, 150)) + rng.choice(shared) + word(rng.randint(0, 90)) for _ in range(120)]
    texts += [texts[3], "ab" * 900 + word(2000) + "ab" * 700, shared[1] * 3]
    return texts, spark.createDataFrame([(k, t, "e") for k, t in enumerate(texts)], SCHEMA).repartition(3)


def same(got, texts):
    return [(bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in sorted(got, key=lambda r: r["id"])] == brute([t.encode() for t in texts], 100)


def test_groups_matched_row_by_row(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 6)
    monkeypatch.setattr(repeats, "SMALL_GROUP", 3)
    texts, docs = corpus(spark)
    assert same(remove_repeats(docs, length=100).collect(), texts)


def test_documents_over_many_batches(spark):
    texts, docs = corpus(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert same(remove_repeats(docs, length=100).collect(), texts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_slices_of_a_long_document(monkeypatch):
    rng = random.Random(1)
    data = "".join(rng.choice("abc") for _ in range(20_000)).encode() + b"z" * 3000
    marks = lambda: sorted(m for c, p, g in repeats.anchored(data, 400) for m in zip(p.tolist(), c.tolist(), g.tolist()))
    whole = marks()
    monkeypatch.setattr(repeats, "SLICE", 1500)
    assert marks() == whole and whole[0][0] == -1 and len({m[0] for m in whole}) == len(whole)


def test_query_takes_passages_of_400_bytes_and_no_shorter_ones(spark, tmp_path):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(n))
    short, long = words(66) + "wxyz", words(66) + "vwxyz"
    assert (len(short), len(long), len(short.split())) == (399, 400, 66)
    texts = [f"{words(70)} <{k}{p}{k}> {words(40)}" for k in range(3) for p in (short, long, "")]
    spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in entries.op8_repeats(spark, str(tmp_path)).collect()}
    for k, t in enumerate(texts):
        left = t.replace(long, "")
        want = (len(t), len(t) - len(left), int(left != t), hashlib.sha256(left.encode()).hexdigest(), left, len(left))
        assert tuple(got[k][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "n_kept")) == want
    assert len(got) == 9 and [got[k]["n_removed"] for k in range(9)] == [0, 400, 0] * 3
