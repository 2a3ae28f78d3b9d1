"""Groups, links and counts against loops over plain encodings of both tokenizers."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quadrille.llm import alignment
from quadrille.llm.alignment import Aligner, default_model, default_pairs, token_alignment, token_groups

ODD = ["", None, " ", "a \n b", "\n\n  x\t\n", "<|endoftext|> <s> </s> <unk> <0x0A>", "▁x", "a▁b", "日本語の文字 漢字かな交じり文。", "😀😀 é é naïve", "x" * 3000, "  two   spaces ", "1234567890 12,345.67", "\x00\x01", "ﬁ １２ ​x", "\r\n\r\n"]


@pytest.fixture(scope="module")
def plain():
    """Ids and byte lists of both sides, by the libraries' own whole-text calls."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(default_pairs())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=default_model())
    back = alignment.byte_alphabet()

    def encode(text):
        if not text:
            return [], []
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ta = [bytes(back[c] for c in a.id_to_token(i)) for i in ia]
        tb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        raw = (" " + text).encode()
        return (list(zip(ia, ta, strict=True)), list(zip(ib, tb, strict=True))) if b"".join(ta) == raw == b"".join(tb) else ([], [])

    return encode


def groups_of(a, b):
    out, k, ea, eb = [], 0, 0, 0
    left, right = [], []
    ends_b = []
    for i, t in b:
        eb += len(t)
        ends_b.append((eb, i))
    both = {e for e, _ in ends_b}
    for i, t in a:
        ea += len(t)
        left.append(i)
        if ea in both:
            while k < len(ends_b) and ends_b[k][0] <= ea:
                right.append(ends_b[k][1])
                k += 1
            out.append((left, right))
            left, right = [], []
    return out


def brute(rows, plain):
    held, counts = [], Counter()
    for doc, text in rows:
        a, b = plain(text)
        groups = groups_of(a, b)
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        counts.update(links.keys())
        held.append((doc, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    for doc, n_a, n_b, groups, links in held:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield doc, n_a, n_b, len(groups), sum(links.values()), sum(m for p, m in links.items() if counts[p] == best[p[0]]), sum(m * counts[p] for p, m in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(df, rows, plain):
    got = Counter(tuple(r[c] for c in COLUMNS) for r in token_alignment(df).collect())
    assert got == Counter(brute(rows, plain))


def test_odd_texts_repeated_rows_and_clashing_names(spark, plain):
    rng = random.Random(1)
    words = ["the", "international", "Straße", "漢字", "x1y2", "été", "😀", "don't", "--", "\n", "  ", "\t"]
    rows = [(None if k == 3 else k % 17, t) for k, t in enumerate(ODD + [" ".join(rng.choices(words, k=60)) for _ in range(20)])] + [(5, "same"), (5, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("batch", F.lit("clash")).withColumn("n_a", F.lit(1)).withColumn("id", F.lit(2))
    same(df.repartition(3), rows, plain)
    assert token_alignment(df.limit(0)).count() == 0
    assert token_alignment(df.filter("text = ''")).first()["groups_sha256"] == ""


def test_all_documents_of_the_small_table(spark, plain):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(df, [(r["doc_id"], r["text"]) for r in df.collect()], plain)


def test_small_batches_hot_ids_and_large_groups(spark, plain, monkeypatch):
    rows = [(k, "ab " * (k % 50) + "\U00012345" * (k % 7)) for k in range(120)]
    monkeypatch.setattr(alignment, "HOT_KEYS", 3)
    got = Counter(tuple(r[c] for c in COLUMNS) for r in token_alignment(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    assert got == Counter(brute(rows, plain))
    monkeypatch.setattr(alignment, "LINKS", 7)
    monkeypatch.setattr(alignment, "LARGE", 2)
    texts = [t for _, t in rows[:40]] + [t or "" for t in ODD]
    aligner = Aligner(*(open(p, "rb").read() for p in (default_pairs(), default_model())))
    posted = Counter({(a, b, d): m for a, b, d, m in zip(*(x.tolist() for x in aligner.postings(aligner.batch(texts))), strict=True)})
    want = Counter((x, y, d) for d, t in enumerate(texts) for left, right in groups_of(*plain(t)) for x in left for y in right)
    assert posted == want


def test_groups_are_given_out_with_their_ends(spark, plain):
    rows = [(1, "the naïve 漢字 text"), (2, ""), (3, "don't\n")]
    for r in token_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        a, b = plain(dict(rows)[r["doc_id"]])
        groups, raw = groups_of(a, b), (" " + dict(rows)[r["doc_id"]]).encode()
        assert r["a_ids"] == [i for i, _ in a] and r["b_ids"] == [i for i, _ in b]
        assert r["a_group"] == [g for g, (x, _) in enumerate(groups) for _ in x] and r["b_group"] == [g for g, (_, y) in enumerate(groups) for _ in y]
        surface = dict(a)
        assert [raw[s:e] for s, e in zip([0, *r["ends"]], r["ends"], strict=False)] == [b"".join(surface[i] for i in x) for x, _ in groups]
