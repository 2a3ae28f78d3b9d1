"""Queries without SQL against brute force over the smallest tables."""

import random
import re
from collections import Counter

from quadrille.llm import entries
from quadrille.llm.common import table
from quadrille.llm.near_dup import near_duplicates

DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, DIR, "documents").collect()}


def test_base_columns_of_the_quality_rules(spark):
    got = {r["doc_id"]: r for r in entries.op6_quality_rules(spark, DIR).collect()}
    docs = documents(spark)
    assert sorted(got) == sorted(docs)
    for i, text in docs.items():
        words = WORDS.findall(text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = Counter(windows)
        repeated = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and not (r["base_failed"] and r["kept"])


def groups_by_all_pairs(texts):
    """Plain Jaccard similarity of sets of five words, all pairs."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: WORDS.findall(t.translate(fold)) for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if (not x and not y) or (x and y and 10 * len(x & y) >= 8 * len(x | y)):
                p, q = sorted((root(a), root(b)))
                group[q] = p
    return {i: root(i) for i in ids}


def test_groups_of_near_duplicates(spark):
    got = {r["id"]: r["group"] for r in near_duplicates(table(spark, DIR, "documents"), weighted=False).collect()}
    assert got == groups_by_all_pairs(documents(spark))


def test_groups_out_of_cells_of_few_and_of_long_texts(spark):
    """Buckets whose pivot is near only some, in cells of three texts, or of fewer where they are long."""
    rng = random.Random(3)
    texts, i = {}, 0
    for length in (60, 200, 1500):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(25):
            near = list(base)
            for _ in range(rng.randrange(1 + length // 25)):
                near[rng.randrange(length)] = f"v{rng.randrange(10**6)}"
            texts[i], i = " ".join(near), i + 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = groups_by_all_pairs(texts)
    assert 10 < len(set(want.values())) < len(texts)  # some are linked, directly or not, and some not
    for cell_shingles in (1 << 20, 400):
        out = near_duplicates(docs, weighted=False, bands=40, rows=2, cell_members=4, cell_pivots=3, cell_shingles=cell_shingles)
        assert {r["id"]: r["group"] for r in out.collect()} == want
