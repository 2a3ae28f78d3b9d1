"""Skips are drawn for every occurrence, and kept runs give what merging each occurrence by itself gives."""

import random

import numpy as np
import pytest

from quadrille.llm.pieces import Encoder, Vocabulary, default_model, key_of, encode_documents


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(default_model())


def test_occurrences_have_draws_of_their_own(spark):
    n = 3000
    ids = encode_documents(spark.createDataFrame([(1, " ".join(["international"] * n))], "doc_id long, text string"), dropout=0.3).first()["ids"]
    vocabulary, ways, at = Vocabulary.load(default_model()), [], []
    for i in ids:
        if vocabulary.surface[i].startswith(b" ") and at:
            ways.append(tuple(at))
            at = []
        at.append(i)
    assert len(ways) + 1 == n and len(set(ways)) > 100


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_matches_merging_one_by_one(vocabulary, dropout):
    rng = random.Random(4)
    words = ["the", "international", "\u2581x", "\u00e9t\u00e9", "\U0001f600", "x" * 60, "aaaaaaa", *("".join(rng.choices("etaoinsr", k=rng.randint(1, 14))) for _ in range(40))]
    texts = ["  ".join(rng.choices(words, k=150)) + "\n" + " ".join(rng.choices(words, k=150)) for _ in range(6)]
    docs = [0, 7, -3, 2**62, 8, 9]
    encoder = Encoder(vocabulary, dropout, 1)
    for _ in range(2):  # nothing kept, and then all
        for text, doc, got in zip(texts, docs, encoder.encode_all(texts, docs), strict=True):
            stretches = vocabulary.stretch.findall(" " + text)
            want = [i for s, k in zip(stretches, encoder.keys(doc, len(stretches)).tolist(), strict=True) for i in vocabulary.segment(s, dropout, key_of(k, s))]
            assert got.tolist() == want
    assert [len(x) for x in encoder.encode_all(["", "a"], [1, 1])] == [0, 1] and np.array_equal(encoder.encode("a b", 5), encoder.encode("a b", 5))
