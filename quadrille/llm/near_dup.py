"""Near-duplicate documents: ProbMinHash signatures of weighted shingles, bands, exact verification."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met, staged, unstage
from .text import ODD, batches, distinct, mix, shingled


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, slots: int, seed: int) -> np.ndarray:
    """Signatures (docs x slots) whose slots agree with the probability Jaccard similarity of two weightings.

    Every element is a Poisson process whose rate is its weight; each arrival falls
    into a slot by hash, and a slot keeps the element that arrives first. An element
    is done once its next arrival is later than all slots of its document hold.
    """
    held = np.full(docs * slots, np.inf)
    signature = np.zeros(docs * slots, np.uint64)
    time = np.zeros(len(doc))
    k = 0
    while len(doc):
        r = mix(element + np.uint64(((k + 1) * int(ODD) + seed) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log1p(-((r >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / weight
        at = doc * slots + (mix(r ^ ODD) % np.uint64(slots)).astype(np.int64)
        won = np.flatnonzero(time < held[at])
        won = won[np.argsort(-time[won])]  # the earliest is written last
        held[at[won]] = time[won]
        signature[at[won]] = element[won]
        latest = held.reshape(docs, slots).max(axis=1)
        active = time < latest[doc]
        doc, element, weight, time = doc[active], element[active], weight[active], time[active]
        k += 1
    return signature.reshape(docs, slots)


def word_sequence(text: str) -> tuple[int, int]:
    """128 bits of a cryptographic hash of a text's words, A-Z folded, in order."""
    words = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    return struct.unpack("<qq", hashlib.blake2b(words, digest_size=16).digest())


def fingerprints(size: int, bands: int, rows: int, weighted: bool, seed: int):
    """Tasks: of each document two hashes of its word sequence and the bands of its signature."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = part["__text"].tolist()
            for a, b, bounds, words in batches(texts):
                n = np.diff(bounds)
                same = np.array([word_sequence(x) for x in texts[a:b]], np.int64)
                doc, element, count = distinct(*shingled(bounds, words, size))
                sig = prob_minhash(doc, element, count.astype(float) if weighted else np.ones(len(doc)), b - a, bands * rows, seed) if len(doc) else np.zeros((b - a, bands * rows), np.uint64)
                key = np.zeros((b - a, bands), np.uint64)
                for r in range(rows):
                    key = mix(key * ODD + sig.reshape(b - a, bands, rows)[:, :, r])
                key = mix(key + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * ODD).view(np.int64)
                yield pd.DataFrame({"id": part["__id"].to_numpy()[a:b], "f1": same[:, 0], "f2": same[:, 1], "keys": [key[i] if n[i] else key[i][:0] for i in range(b - a)]})

    return run


def shingle_sets(size: int):
    """Tasks: the sorted distinct shingles of each document, how many, and their counts, as bytes."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for a, b, bounds, words in batches(part["__text"].tolist()):
                doc, element, count = distinct(*shingled(bounds, words, size))
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                yield pd.DataFrame({"id": part["id"].to_numpy()[a:b], "held": np.diff(cut), "shingles": [element[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)], "counts": [count[s:e].astype(np.int32).tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)]})

    return run


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """sum over d of 1 / sum over e of max(x_e / x_d, y_e / y_d), for aligned weights; 0 where either is 0."""
    combos, n = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    cx, cy = combos.astype(float)
    both = (cx > 0) & (cy > 0)
    below = np.array([(n * np.maximum(cx * b, cy * a)).sum() for a, b in zip(cx[both], cy[both], strict=True)])
    return float((n[both] * cx[both] * cy[both] / below).sum()) if both.any() else 0.0


def similarity(xs: bytes, xc: bytes, ys: bytes, yc: bytes, weighted: bool) -> float:
    a, b = np.frombuffer(xs, np.uint64), np.frombuffer(ys, np.uint64)
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = b[at] == a
    ca, cb = (np.frombuffer(xc, np.int32), np.frombuffer(yc, np.int32)) if weighted else (np.ones(len(a), np.int32), np.ones(len(b), np.int32))
    if (ca[common] == cb[at[common]]).all():
        both = int(ca[common].sum())
        return both / (int(ca.sum()) + int(cb.sum()) - both)
    rest = np.ones(len(b), bool)
    rest[at[common]] = False
    x = np.concatenate([ca, np.zeros(int(rest.sum()), np.int32)])
    y = np.concatenate([np.where(common, cb[at], 0), cb[rest]])
    return probability_jaccard(x, y)


def meet(threshold: float, weighted: bool):
    """Tasks: links between the members and the pivots of a cell, as many as it takes to connect what they connect."""

    def root(of: dict[int, int], x: int) -> int:
        while of.setdefault(x, x) != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    def run(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        joined: dict[int, int] = {}
        if len(members) and len(pivots):
            sets = [np.frombuffer(x, np.uint64) for x in pivots["shingles"]]
            sizes = np.array([len(x) for x in sets])
            counts = np.concatenate([np.frombuffer(x, np.int32) for x in pivots["counts"]]) if weighted else np.ones(int(sizes.sum()), np.int32)
            owner = np.repeat(np.arange(len(sets)), sizes)
            mass = np.bincount(owner, counts, len(sets))
            order = np.argsort(np.concatenate(sets))
            shingles, owner, counts = np.concatenate(sets)[order], owner[order], counts[order]
            ids, labels = pivots["id"].to_numpy(), pivots["label"].to_numpy()
            for mid, label, ms, mc in zip(members["id"], members["label"], members["shingles"], members["counts"], strict=True):
                other = labels != label
                x = np.frombuffer(ms, np.uint64)
                if not other.any() or not len(x):
                    continue
                cx = np.frombuffer(mc, np.int32) if weighted else np.ones(len(x), np.int32)
                left, right = np.searchsorted(shingles, x, "left"), np.searchsorted(shingles, x, "right")
                n = right - left
                at = np.repeat(left - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                by, a, b = owner[at], np.repeat(cx, n), counts[at]
                shared = np.bincount(by, np.minimum(a, b), len(sets))
                uneven = np.bincount(by, a != b, len(sets)) > 0
                total = float(cx.sum())
                sure = other & ~uneven & (shared / (total + mass - shared) >= threshold - 1e-12)
                # Where counts differ, the sum of the smaller shares bounds the similarity.
                bound = np.bincount(by, np.minimum(a / total, b / mass[by]), len(sets)) if uneven.any() else shared
                for j in [*np.flatnonzero(sure), *np.flatnonzero(other & uneven & (bound >= threshold - 1e-9))]:
                    x, y = root(joined, label), root(joined, labels[j])
                    if x != y and (sure[j] or similarity(ms, mc, pivots["shingles"].iloc[j], pivots["counts"].iloc[j], weighted) >= threshold - 1e-12):
                        joined[x] = y
                        out.append((min(mid, ids[j]), max(mid, ids[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def verified(pairs: DataFrame, sets: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """The pairs (a, b) of which the exact similarity is at least ``threshold``."""

    def check(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            sims = [similarity(*row, weighted) for row in zip(p["xs"], p["xc"], p["ys"], p["yc"], strict=True)]
            keep = np.array(sims, float) >= threshold - 1e-12
            yield p.loc[keep, ["a", "b"]]

    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("xs"), F.col("counts").alias("xc"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("ys"), F.col("counts").alias("yc"))
    return pairs.join(x, "a").join(y, "b").mapInPandas(check, "a long, b long")


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(id, label): the smallest id that each linked id reaches; hooking to smaller labels and pointer jumping, staged each round."""
    spark = links.sparkSession
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    labels, path = staged(both.groupBy("id").agg(F.min("other").alias("m")).select("id", F.least("id", "m").alias("label")), "near-labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "other").withColumnRenamed("label", "seen"), "other").groupBy("id").agg(F.min("seen").alias("seen"))
        hooked, hooked_path = staged(labels.join(near, "id").select("id", F.col("label").alias("was"), F.least("label", "seen").alias("label")), "near-hooked")
        # Whoever was labelled with a vertex follows that vertex; one vertex may label a third of all.
        moved, moved_path = staged(hooked.groupBy("was").agg(F.min("label").alias("via"), F.count("*").alias("n")), "near-roots")
        step = met(hooked, moved, ["was"], ["id"]).select("id", "was", F.least("label", "via").alias("label"))
        done, new_path = staged(step, "near-labels")
        changed = done.filter("label <> was").limit(1).count()
        for old in (path, hooked_path, moved_path):
            unstage(spark, old)
        labels, path = done.select("id", "label"), new_path
        if not changed:
            return labels, path


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, bands: int = 24, rows: int = 4, weighted: bool = True, seed: int = 1, cell_members: int = 1024, cell_pivots: int = 256, cell_shingles: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs``: (id, text_class, group).

    text_class is the smallest id with the same words (A-Z folded) in the same order;
    group is the smallest id of the documents linked, directly or through others, by
    a probability Jaccard similarity of at least ``threshold`` over shingles of
    ``size`` words weighted by their counts (by 1 if not ``weighted``: then it is
    the plain Jaccard similarity).

    Only one document of each text class goes on. Bands of ProbMinHash signatures
    make buckets. In each bucket all members meet one pivot. Where that leaves members
    unconnected, those outside the bucket's largest component meet all members, in
    cells of at most about ``cell_pivots`` by ``cell_members`` documents, fewer where their
    texts are long, so that a side holds at most about ``cell_shingles``: no link inside
    a bucket is lost, and only links, not pairs, leave a cell. Two texts of similarity s share no bucket with probability
    (1 - s^rows)^bands: 3 in a million at 0.8.

    Null, empty and blank texts have no shingles; they are copies of each other and
    near nothing else. A text shorter than ``size`` words is one shingle. Rows with
    a null id get null text_class and group. Rows that repeat an id count once.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    prints, _ = staged(base.filter(F.col("__id").isNotNull()).mapInPandas(fingerprints(size, bands, rows, weighted, seed), "id long, f1 long, f2 long, keys array<long>"), "near-prints")
    classes, _ = staged(prints.groupBy("f1", "f2").agg(F.min("id").alias("class"), F.min_by("keys", "id").alias("keys")), "near-classes")
    keyed = classes.select(F.col("class").alias("id"), F.explode("keys").alias("key"))
    buckets, buckets_path = staged(keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).filter("first <> last").drop("last"), "near-buckets")
    members, _ = staged(met(keyed, buckets, ["key"], ["id"]), "near-members")
    unstage(spark, buckets_path)

    wanted = members.select("id").distinct()
    texts = base.join(wanted, base["__id"] == wanted["id"]).select("id", "__text").groupBy("id").agg(F.min("__text").alias("__text"))
    sets, _ = staged(texts.mapInPandas(shingle_sets(size), "id long, held long, shingles binary, counts binary"), "near-sets")

    pairs, _ = staged(members.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), "near-pairs")
    star, _ = staged(verified(pairs, sets, threshold, weighted), "near-links")
    labels, _ = components(star)
    waiting = members.filter("id <> first").select("key", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    waiting, waiting_path = staged(waiting.join(sets.select("id", "held"), "id"), "near-unsettled")
    sizes = waiting.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("held").alias("held"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("n", "label", "held")).alias("top"), F.sum("n").alias("n"), F.sum("held").alias("held"), F.count("*").alias("parts")).filter("parts > 1")
    cells = lambda n, most, held: F.greatest(F.ceil(n / most), F.ceil(held / cell_shingles))
    mixed = mixed.select(
        "key", "n", F.col("top.label").alias("largest"), cells(F.col("n"), cell_members, F.col("held")).alias("member_cells"),
        cells(F.col("n") - F.col("top.n"), cell_pivots, F.col("held") - F.col("top.held")).alias("pivot_cells"),
    )
    mixed, mixed_path = staged(mixed, "near-mixed")
    waiting, _ = staged(met(waiting.drop("held"), mixed, ["key"], ["id"]), "near-waiting")
    for path in (waiting_path, mixed_path):
        unstage(spark, path)
    cell = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    grid = ["key", "row_cell", "pivot_cell"]
    held = waiting.withColumn("row_cell", cell(1, "member_cells")).withColumn("pivot_cell", every("pivot_cells")).select(*grid, "id", "label")
    lone = waiting.filter("label <> largest").withColumn("pivot_cell", cell(2, "pivot_cells")).withColumn("row_cell", every("member_cells")).select(*grid, "id", "label")
    own = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  the sides share their origin
    sets = sets.drop("held")
    found = own(held.join(sets, "id")).groupBy(*grid).cogroup(own(lone.join(sets, "id")).groupBy(*grid)).applyInPandas(meet(threshold, weighted), "a long, b long")
    rest, _ = staged(found.distinct(), "near-links")
    labels, _ = components(star.unionByName(rest))
    out = prints.join(classes.select("f1", "f2", "class"), ["f1", "f2"]).select("id", "class")
    out = out.join(labels.withColumnRenamed("id", "class"), "class", "left").select("id", F.col("class").alias("text_class"), F.coalesce("label", "class").alias("group"))
    nameless = base.filter(F.col("__id").isNull()).select(F.col("__id").alias("id"), F.lit(None).cast("long").alias("text_class"), F.lit(None).cast("long").alias("group"))
    return out.unionByName(nameless)
