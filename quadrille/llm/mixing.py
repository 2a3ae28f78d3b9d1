"""Mixing sources to target weights by temperature, as budgeted block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WS_RUN, packed, staged


@dataclass(frozen=True)
class Mixture:
    """weight of a source ~ share ** exponent; repeats = scale * share ** (exponent - 1) passes over it."""

    exponent: float
    scale: float


def bisect(ok, low: float = 0.0, high: float = 1.0, rounds: int = 40) -> float:
    """The least value in [low, high] from which on ``ok`` holds; it holds at ``high``."""
    if ok(low):
        return low
    for _ in range(rounds):
        mid = (low + high) / 2
        low, high = (low, mid) if ok(mid) else (mid, high)
    return high


def choose(sources: DataFrame, max_repeats: float | None, target_entropy: float | None, budget: float | None) -> Mixture:
    """The exponent that meets the limit, from aggregates over (source, tokens); sources never gather on the driver.

    With ``max_repeats``: the flattest weights at which no source is passed over
    more than ``max_repeats`` times as often as the one passed over least. With
    ``target_entropy`` (nats): the weights nearest to the natural shares that
    reach it (uniform weights if none does). ``budget``: tokens to emit; by default
    as many as pass over every source at least once.
    """
    p = F.col("tokens") / F.col("total")
    shares = sources.filter("tokens > 0").crossJoin(F.broadcast(sources.agg(F.sum("tokens").alias("total")))).select(p.alias("p"), "total")
    low, high, total = shares.agg(F.min("p"), F.max("p"), F.max("total")).first()
    if total is None:
        return Mixture(1.0, 1.0)

    def entropy(a: float) -> float:
        z, s = shares.agg(F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * a * F.log("p"))).first()
        return math.log(z) - s / z

    if target_entropy is not None:
        exponent = 1.0 - bisect(lambda x: entropy(1.0 - x) >= target_entropy, rounds=16)
    else:
        exponent = bisect(lambda a: (high / low) ** (1 - a) <= (max_repeats or 1.0) * (1 + 1e-12))
    if budget is None:
        return Mixture(exponent, high ** (1 - exponent))
    z = shares.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0]
    return Mixture(exponent, budget / total / z)


def schedule(docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None, budget: float | None = None, seed: int = 1, block_docs: int = 2000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, text_hash, source, tokens, pass, position): which documents the mixture shows, how often and where.

    A source with r passes shows each document floor(r) times and, in one more pass,
    as many as its budget allows. In each pass a source's blocks come in a keyed
    permutation, and so do the documents of a block; ``position`` in [0, 1) is the
    share of its source's budget that goes before, so sorting by it interleaves the
    sources at their weights. Tokens are words. A document is shown in a partial
    pass if the budget is not yet spent before it.

    No task holds a source: windows run over blocks of about ``block_docs``
    documents, and over the totals of a source's blocks. A null source is a
    source. Rows that repeat id, text and source move as one. Documents without
    words cost nothing and are in every whole pass, at position 1 if all words
    of the budget go before. A null id is allowed. An empty table gives no rows.
    """
    base = packed(docs, id_col, text_col)
    words = F.size(F.filter(F.split("__text", WS_RUN, -1), lambda w: w != ""))
    units = base.select(F.col("__id").alias("id"), F.xxhash64("__text").alias("text_hash"), F.col("__rec").getField(source_col).cast("string").alias("source"), words.cast("long").alias("tokens"))
    units, _ = staged(units.groupBy("id", "text_hash", "source", "tokens").agg((F.count("*") * F.col("tokens")).alias("mass")), "mix-units")
    sources, _ = staged(units.groupBy("source").agg(F.sum("mass").alias("tokens"), F.count("*").alias("docs")), "mix-sources")
    mixture = choose(sources, max_repeats, target_entropy, budget)
    share = F.col("tokens") / F.col("total")
    total = F.broadcast(sources.agg(F.sum("tokens").alias("total")))
    repeats = F.when(F.col("tokens") > 0, F.lit(mixture.scale) * F.pow(share, F.lit(mixture.exponent - 1))).otherwise(1.0)
    plan = sources.crossJoin(total).select(F.col("source").alias("of"), F.col("tokens").alias("source_tokens"), F.round(repeats, 9).alias("repeats"), F.ceil(F.col("docs") / block_docs).alias("blocks"))

    seeded = lambda *c: F.xxhash64(F.lit(seed), *c)
    rows = units.join(plan, units["source"].eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("block", F.pmod(seeded("id", "text_hash"), F.col("blocks")))
    last = F.greatest(F.ceil("repeats"), F.lit(1)) - 1
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    cell = ["source", "pass", "block"]
    # One null-safe key, so that totals of blocks can be joined back by an equi-join.
    rows = rows.withColumn("cell", F.xxhash64(F.coalesce("source", F.lit("\x00null")), "pass", "block"))
    totals = rows.groupBy(*cell, "cell").agg(F.sum("mass").alias("block_mass"))
    earlier = W.partitionBy("source", "pass").orderBy(seeded("pass", "block"), "block").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("cell", F.coalesce(F.sum("block_mass").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy("cell").orderBy(seeded("pass", "id", "text_hash"), "id", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("mass").over(inside), F.lit(0))).join(offsets, "cell")
    before = F.col("pass") * F.col("source_tokens") + F.col("offset") + F.col("inner")
    spent = F.col("repeats") * F.col("source_tokens")
    wordless = (F.col("tokens") == 0) & (F.col("pass") < F.floor("repeats"))
    shown = placed.filter((before < spent) | wordless | ((F.col("source_tokens") == 0) & (F.col("pass") == 0)))
    position = F.coalesce(before / F.nullif(spent, F.lit(0.0)), F.lit(0.0))
    return shown.select("id", "text_hash", "source", "tokens", F.col("pass").cast("int").alias("pass"), position.alias("position"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents as the schedule shows them: all columns of ``docs``, a row for each showing, and ``mix_pass``, ``mix_position``."""
    plan = schedule(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    key = lambda i, h, s: F.xxhash64(F.coalesce(i.cast("string"), F.lit("\x00null")), h, F.coalesce(s.cast("string"), F.lit("\x00null")))
    plan = plan.select(key(F.col("id"), F.col("text_hash"), F.col("source")).alias("__key"), F.col("id").alias("__of"), F.col("pass").alias("__pass"), F.col("position").alias("__position"))
    base = packed(docs, id_col, text_col)
    base = base.withColumn("__key", key(F.col("__id"), F.xxhash64("__text"), F.col("__rec").getField(source_col))).select("__rec", "__id", "__key")
    shown = base.join(plan, "__key").filter(F.col("__id").eqNullSafe(F.col("__of")))
    kept = [c for c in docs.columns if c not in ("mix_pass", "mix_position")]
    return shown.select(*[F.col("__rec").getField(c).alias(c) for c in kept], F.col("__pass").alias("mix_pass"), F.col("__position").alias("mix_position"))
