"""The chain field against enumeration of all labellings, and on layouts that its training pages don't have."""

import time
import tracemalloc
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm.extraction import DIM, Field, described, extract, leaf_blocks, train
from quadrille.llm.labelled_pages import labelled_pages


@pytest.mark.parametrize("n", [1, 2, 5, 7])
def test_marginals_and_best_path(n):
    rng = np.random.default_rng(n)
    field = Field(np.zeros((DIM, 2)), rng.normal(size=(2, 2)) * 2)
    e = rng.normal(size=(n, 2)) * 3
    paths = list(product((0, 1), repeat=n))
    score = np.array([sum(e[i, y] for i, y in enumerate(p)) + sum(field.transition[a, b] for a, b in zip(p, p[1:])) for p in paths])
    chance = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
    unary, pairs = np.zeros((n, 2)), np.zeros((2, 2))
    for p, c in zip(paths, chance, strict=True):
        for i, y in enumerate(p):
            unary[i, y] += c
        for a, b in zip(p, p[1:]):
            pairs[a, b] += c
    got_unary, got_pairs = field.marginals(e)
    assert np.allclose(got_unary, unary) and np.allclose(got_pairs, pairs)
    assert tuple(field.viterbi(e)) == paths[int(score.argmax())]


#: Written by hand; ``!`` begins a block of the main text.
LAYOUTS = [
    """<html><head><title>T</title></head><body><div id="masthead"><a href=/>The Courier</a></div>
    <div class="menu"><ul><li><a href=/a>World</a></li><li><a href=/b>Sport</a></li><li><a href=/c>Money</a></li></ul></div>
    <main><h1>!Harbour bridge reopens after a year of repairs</h1>
    <p>!The harbour bridge reopened to traffic on Monday, eleven months after engineers found cracks in two of its main bearings.</p>
    <p>!Officials said that the work had cost less than planned, and that the remaining money would go to the northern approach.</p>
    <p>!Drivers waited for more than an hour in the morning, but by noon the queue had gone.</p></main>
    <div class="sidebar"><h3>Related</h3><ul><li><a href=/x>Ferry fares rise</a></li><li><a href=/y>Tunnel plan shelved</a></li></ul></div>
    <div id="footer"><p>© 2020 The Courier. All rights reserved.</p></div></body></html>""",
    """<html><body><header><nav><a href=/>Home</a> <a href=/docs>Docs</a> <a href=/login>Log in</a></nav></header>
    <div class="cookie-notice"><p>We use cookies to improve your visit.</p><button>Accept</button></div>
    <article><h2>!How to keep a sourdough starter alive</h2>
    <p>!Feed the starter once a day with equal weights of flour and water, and keep it at room temperature.</p>
    <ul><li>!Use a clean jar that holds at least twice the volume of the starter.</li><li>!Throw away half of it before every feed, or bake with it.</li></ul>
    <p>!If you travel, put it in the fridge, where it will last for two weeks without any care.</p></article>
    <section class="comments"><h3>3 comments</h3><div class="comment"><p>Thanks, this saved mine!</p></div></section>
    <footer><a href=/p>Privacy</a> <a href=/t>Terms</a></footer></body></html>""",
]


def test_blocks_of_layouts_not_trained_on():
    field = train(labelled_pages())
    right = total = 0
    for html in LAYOUTS:
        gold = [b.text.startswith("!") for b in leaf_blocks(html)]
        blocks = leaf_blocks(html.replace("!", "", html.count("!")))
        path = field.viterbi(field.scores(described(blocks)))
        right += sum(bool(y) == g for y, g in zip(path, gold, strict=True))
        total += len(gold)
    assert right >= 0.9 * total, (right, total)


def test_deep_and_broken_pages_take_little_time_and_lose_no_text(spark):
    """Twenty thousand open tags, and 100 KB of what never closes."""
    n = 20_000
    hostile = {
        "deep": "".join(f'<div class="c{k}">w{k} ' for k in range(n)),
        "open": "before " + '<a href="x ' * (100_000 // 11),
        "comment": "before " + "<!-- a> " * 12_000,
        "inline": "<b>" * n + "<p>t</p>" * n,
    }
    field = train(labelled_pages())
    for name, html in hostile.items():
        tracemalloc.start()
        began = time.process_time()
        blocks = leaf_blocks(html)
        field.viterbi(field.block_scores(blocks))
        took, most = time.process_time() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert took < 15 and most < 100_000_000, (name, took, most)  # the measuring itself slows it down several times
        text = " ".join(b.text for b in blocks)
        assert {"deep": text == " ".join(f"w{k}" for k in range(n)), "open": text == " ".join(html.split()), "comment": text == " ".join(html.split()), "inline": text == " ".join(["t"] * n)}[name]
    shallow = '<body class="page"><div class="a b a"><p>one <a href=x>two</a></p><div id="b"><li>three<li>four</div></div>'
    blocks = leaf_blocks(shallow)
    assert np.allclose(field.block_scores(blocks), field.scores(described(blocks)))


def test_pages_of_any_kind(spark):
    page = LAYOUTS[0].replace("!", "")
    rows = [(1, "u", page, 9), (1, "u", page, 9), (None, None, page, 9), (2, "v", None, 9), (3, "w", "", 9), (4, "x", "no markup", 9), (5, "y", page + "<p>" + "word " * 200_000, 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").withColumn("text", F.lit("clash"))
    got = extract(df).select("page_id", "url", "text", "n_chars").collect()
    by = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in got}
    assert len(got) == len(rows) and by[1, "u"] == by[None, None] and by[2, "v"] == by[3, "w"] == ("", 0) and by[1, "u"][0].startswith("Harbour bridge reopens")
    assert all(r["n_chars"] == len(r["text"]) for r in got) and extract(df.limit(0)).count() == 0
