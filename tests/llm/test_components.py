"""Connected components where one root labels most of the vertices."""

import random

from quadrille.llm.near_dup import components


def test_star_chain_and_small_groups(spark):
    rng = random.Random(5)
    links = [(10_000, 10_000 + k) for k in range(1, 2001)]  # one vertex with all the others
    chain = list(range(30_000, 30_300))
    rng.shuffle(chain)
    links += list(zip(chain[:-1], chain[1:], strict=True))
    links += [(50_000 + 3 * k, 50_001 + 3 * k) for k in range(200)] + [(10_000, 10_001)]  # pairs, and a repeated link
    rng.shuffle(links)
    want = {v: 10_000 for v in range(10_000, 12_001)} | dict.fromkeys(chain, 30_000)
    want |= {50_000 + 3 * k + d: 50_000 + 3 * k for k in range(200) for d in (0, 1)}
    labels, _ = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["id"]: r["label"] for r in labels.collect()} == want
    none, _ = components(spark.createDataFrame([], "a long, b long"))
    assert none.collect() == []
