"""Small cases of the document operators: nulls, empty tables, ties, clashing columns, brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quadrille.llm.classifier import quality_classifier
from quadrille.llm.extraction import extract
from quadrille.llm.line_dedup import line_dedup
from quadrille.llm.mixing import schedule
from quadrille.llm.near_dup import near_duplicates
from quadrille.llm.pieces import decode_documents, encode_documents
from quadrille.llm.quality_rules import quality_rules
from quadrille.llm.topk_search import exact_topk
from quadrille.llm.warc import page_records, read_warc, write_warc

DOCS = "doc_id long, text string, source string, __text string, kept boolean"


@pytest.fixture
def docs(spark):
    rng = random.Random(5)
    words = ["the", "and", "of", *("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))]
    text = lambda n: " ".join(rng.choices(words, k=n))
    base = text(120)
    rows = [(1, None), (2, ""), (3, base), (4, base.upper()), (5, base.replace(" of ", " at ", 1)), (6, text(90)), (7, "a line that repeats\nx\n" + text(60)), (8, " A LINE that repeats \ny"), (None, text(80)), (6, text(90)), (9, "é▁ 😀\t\n  x " * 30), (10, "y" * 200_000)]
    return spark.createDataFrame([(i, t, "s" if i and i > 3 else None, "clash", True) for i, t in rows], DOCS)


def test_near_duplicates(docs, spark):
    got = {(r["id"], r["text_class"], r["group"]) for r in near_duplicates(docs).collect()}
    by = {i: (c, g) for i, c, g in got}
    assert by[3] == (3, 3) and by[4] == (3, 3) and by[5][1] == 3 and by[6][1] == 6 and by[1] == by[2] == (1, 1) and by[None] == (None, None)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_line_dedup(docs):
    rows = {r["doc_id"]: r for r in line_dedup(docs).collect() if r["doc_id"] in (1, 7, 8)}
    assert rows[8]["text"] == "y" and rows[8]["n_dropped"] == 1 and rows[7]["n_dropped"] == 0 and rows[1]["n_lines"] == 1
    assert line_dedup(docs.limit(0)).count() == 0


def test_pieces_round_trip(docs):
    enc = encode_documents(docs, dropout=0.1)
    assert sorted(r["text"] or "" for r in decode_documents(enc).collect()) == sorted(r["text"] or "" for r in docs.collect())
    assert enc.filter("not lossless").count() == 0


def test_pieces_without_dropout_are_the_models(docs):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = docs.filter("doc_id = 3").first()["text"]
    assert list(encode_documents(docs.filter("doc_id = 3"), dropout=0.0).first()["ids"]) == model.encode(text)


def test_quality(docs):
    got = quality_rules(docs).collect()
    assert len(got) == 12 and all(r["kept"] is not None for r in got) and not any(r["kept"] for r in got if r["n_words"] < 50)
    assert quality_rules(docs.limit(0)).count() == 0
    assert quality_classifier(docs).count() == 12 and quality_classifier(docs.limit(0)).count() == 0


def test_mixing(docs):
    got = schedule(docs, max_repeats=2.0).collect()
    assert {r["id"] for r in got} == {r["doc_id"] for r in docs.collect()} and max(r["pass"] for r in got) <= 1
    assert schedule(docs.limit(0)).count() == 0


def test_topk(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(200)] + [(300, None), (301, [1.0, None]), (302, [math.nan] * 8), (None, [1.0] * 8)]
    q = {i: [math.floor(256 * x) for x in v] for i, v in rows[:200]}
    got = exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0, block_bytes=1024, least_blocks=3)
    want = {(a, k + 1, b, s) for a in q if a % 50 == 0 for k, (s, b) in enumerate(sorted(((sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a), key=lambda p: (-p[0], p[1]))[:5])}
    assert {tuple(r) for r in got.collect()} == want


def test_warc_with_magic_in_payload(spark, tmp_path):
    trap = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", trap), (2, "u", trap), (3, None, None), (4, "v", ""), (5, "w", "é" * 5000)]
    write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = {r["page_id"]: r for r in page_records(read_warc(spark, str(tmp_path / "w"))).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and got[2]["refers_to"] == 1 and got[4]["refers_to"] == 3 and got[5]["payload_bytes"] == 10000
    assert bytes(got[1]["payload"]).decode() == trap


def test_extraction(spark):
    page = "<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>A &amp; B</h1><p>Some  long\nsentence of words here.</p></article><footer>© x</footer></body></html>"
    got = {r["page_id"]: r for r in extract(spark.createDataFrame([(1, "u", page), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "A & B Some long sentence of words here." and got[2]["text"] == "" and got[3]["n_chars"] == 0
