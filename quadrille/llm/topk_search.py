"""Exact top-k search by inner product: a three-phase uniform threshold over dimension lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged, unstage

PACKED = "block long, ids binary, rids binary, copies binary, dim int, kind string, matrix binary"
#: Scores held at a time in a task.
SCORES = 1 << 22


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """One row (id, rid, copies, v) per distinct id and vector of floor(scale * x)."""
    x = F.col(f"`{vec_col}`")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.filter(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))
    return rows.groupBy("id", "v").agg(F.count("*").alias("copies")).withColumn("rid", F.xxhash64("id", "v"))


def pack(rows: pd.DataFrame) -> pd.DataFrame:
    """A block of rows as one, its numbers in the narrowest type that holds them."""
    m = matrix(rows["v"])
    top = int(np.abs(m).max(initial=0))
    m = m.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)
    held = {c: [rows[c].to_numpy(np.int64).tobytes()] for c in ("id", "rid", "copies")}
    return pd.DataFrame({"block": rows["block"].iloc[:1].to_numpy(), "ids": held["id"], "rids": held["rid"], "copies": held["copies"], "dim": [m.shape[1]], "kind": [m.dtype.str], "matrix": [m.tobytes()]})


def matrix(vectors: pd.Series) -> np.ndarray:
    m = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)), np.int64)
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    return m


def unpack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    row = rows.iloc[0]
    ids, rids, copies = (np.frombuffer(row[c], np.int64) for c in ("ids", "rids", "copies"))
    return ids, rids, copies, np.frombuffer(row["matrix"], row["kind"]).reshape(len(ids), row["dim"])


class Lists:
    """Partial scores of one kind of vectors against another, list by list: each list has a share of the dimensions."""

    def __init__(self, q: np.ndarray, v: np.ndarray, lists: int):
        dim = min(q.shape[1], v.shape[1])
        cuts = np.linspace(0, dim, lists + 1).astype(int)
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(dim, 1) < 2**52
        kind = np.float64 if exact else np.int64
        self.q, self.v = ([m[:, a:b].astype(kind) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for m in (q, v))

    def of(self, g: int, some: np.ndarray | slice) -> np.ndarray:
        return (self.q[g][some] @ self.v[g].T).astype(np.int64)

    def rest(self, i: int, at: np.ndarray, known: dict[int, np.ndarray]) -> np.ndarray:
        """Whole scores of the rows ``at``, multiplying only in lists that are not ``known``."""
        whole = sum((p[at] for p in known.values()), np.zeros(len(at), np.int64))
        for g in range(len(self.q)):
            if g not in known:
                whole = whole + (self.v[g][at] @ self.q[g][i]).astype(np.int64)
        return whole


def best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best allowed entries, ties to smaller ids."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


TOP = "query_id long, qrid long, v_block long, lows array<long>, highs array<long>, top array<struct<score:bigint,vec_id:bigint,rid:bigint,copies:bigint>>"
FOUND = "query_id long, qrid long, vec_id long, rid long, copies long, score long"


def gather(lists: int, k: int):
    """Phase one, a query block against a row block: the top of each list with the whole scores of what it holds, and each list's lowest and highest score."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(queries):
            (qi, qr, _, q), (vi, vr, n, v) = unpack(queries), unpack(rows)
            scores, step = Lists(q, v, lists), max(1, SCORES // (lists * len(vi)))
            for a in range(0, len(qi), step):
                parts = [scores.of(g, slice(a, a + step)) for g in range(lists)]
                for i, (query, rid) in enumerate(zip(qi[a : a + step], qr[a : a + step], strict=True)):
                    allowed = vi != query
                    if allowed.any():
                        mine = [p[i][allowed] for p in parts]
                        top = np.unique(np.concatenate([best(p[i], allowed, vi, k) for p in parts]))
                        whole = sum(p[i][top] for p in parts)
                        held = [(int(whole[j]), int(vi[top[j]]), int(vr[top[j]]), int(n[top[j]])) for j in np.argsort(-whole, kind="stable")[:k]]
                        out.append((query, rid, rows["v_block"].iloc[0], [int(p.min()) for p in mine], [int(p.max()) for p in mine], held))
        return pd.DataFrame(out, columns=["query_id", "qrid", "v_block", "lows", "highs", "top"])

    return run


def collect_and_resolve(lists: int, k: int):
    """Phases two and three, on a row block and the queries that it may still hold something for.

    Lists whose highest score stays under their share of the cutoff are left out; the
    entries at or over a share get their missing partial scores, and no others.
    """

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(queries):
            vi, vr, n, v = unpack(rows)
            scores, step = Lists(matrix(queries["v"]), v, lists), max(1, SCORES // (lists * len(vi)))
            lows, highs = np.stack(queries["lows"].to_numpy()), np.stack(queries["highs"].to_numpy())
            slack = queries["slack"].to_numpy(np.int64)
            open_ = (highs - lows) * lists >= slack[:, None]
            for a in range(0, len(queries), step):
                parts = {g: scores.of(g, some) for g in range(lists) if len(some := a + np.flatnonzero(open_[a : a + step, g]))}
                place = np.cumsum(open_[a : a + step], axis=0) - 1
                for i, (query, rid) in enumerate(zip(queries["query_id"].iloc[a : a + step], queries["qrid"].iloc[a : a + step], strict=True)):
                    known = {g: parts[g][place[i, g]] for g in range(lists) if open_[a + i, g]}
                    sufficient = np.zeros(len(vi), bool)
                    for g, p in known.items():
                        sufficient |= (p - lows[a + i, g]) * lists >= slack[a + i]
                    at = np.flatnonzero(sufficient & (vi != query))
                    whole = scores.rest(a + i, at, known)
                    for j in best(whole, whole >= slack[a + i] + lows[a + i].sum(), vi[at], k):
                        out.append((query, rid, vi[at[j]], vr[at[j]], n[at[j]], int(whole[j])))
        return pd.DataFrame(out, columns=["query_id", "qrid", "vec_id", "rid", "copies", "score"])

    return run


def exact_topk(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, lists: int = 4, block_bytes: int = 8 << 20, least_blocks: int | None = None) -> DataFrame:
    """The ``k`` best inner products of each query against all other rows, exactly.

    ``queries`` is a condition on the id (named ``id``). Vectors are quantised to
    floor(scale * x). The dimensions are dealt into ``lists``; the score of a row is
    the sum of its partial scores. Phase one gathers the top of every list; the k-th
    best whole score seen is a safe cutoff. Phase two collects every row of which
    some list holds at least its uniform share of the cutoff (above that list's
    lowest score): all others stay under the cutoff. A row block goes on only with
    the queries for which phase one saw such a list in it, and only such lists are
    scored. Phase three adds the missing partial scores of the rows collected.

    Query blocks meet row blocks in a grid, a cogroup by the pair of blocks. A block
    has ``block_bytes`` of numbers in their narrowest type (65,536 vectors of 64
    small numbers), so few copies of the table are made; with less data the rows are
    cut into ``least_blocks`` (by default the cores), so that all cores have work. A
    task holds one pair of blocks, and SCORES scores at a time.

    Rows with a null id, or a null vector, or one with null or non-finite
    components, take no part. Shorter vectors count as padded with zeros. A row
    repeated verbatim counts once a copy; a query never meets rows of its own id;
    a repeated query is answered once. Ties go to smaller ids. A query with no other
    row has no result, nor has an empty table. Other columns are not read. Returns
    query_id, rank, vec_id, score. Scores are 64-bit.
    """
    spark = vectors.sparkSession
    rows, _ = staged(quantised(vectors, id_col, vec_col, scale), "topk-rows")
    asked = rows.filter(queries)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    width = 2 if (size["top"] or 0) < 1 << 15 else 4 if size["top"] < 1 << 31 else 8
    per_block = max(1, block_bytes // (width * max(1, size["dim"] or 1)))
    blocks = max(1, -(-size["n"] // per_block), min(least_blocks or spark.sparkContext.defaultParallelism, -(-size["n"] // 1024)))
    query_blocks = max(1, -(-asked.count() // per_block))
    dealt = lambda df, m, salt: df.withColumn("block", F.pmod(F.xxhash64(F.lit(salt), "rid"), F.lit(m)))
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<long>"))
    packed, blocks_path = staged(dealt(rows, blocks, 1).groupBy("block").applyInPandas(pack, PACKED), "topk-blocks")
    v_side = packed.withColumnRenamed("block", "v_block")
    q_side = dealt(asked, query_blocks, 2).groupBy("block").applyInPandas(pack, PACKED).withColumnRenamed("block", "q_block")
    cell = ["q_block", "v_block"]
    seen = v_side.withColumn("q_block", numbers(query_blocks)).groupBy(*cell).cogroup(q_side.withColumn("v_block", numbers(blocks)).groupBy(*cell)).applyInPandas(gather(lists, k), TOP)
    seen, seen_path = staged(seen, "topk-lists")
    of = ["query_id", "qrid"]
    tops = seen.select(*of, F.inline("top")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    nth = F.row_number().over(W.partitionBy(*of).orderBy(F.desc("score"), "vec_id", "rid", "copy"))
    cut = tops.withColumn("nth", nth).filter(F.col("nth") == k).select(*of, F.col("score").alias("cut"))
    lows = seen.groupBy(*of).agg(F.array(*[F.min(F.col("lows")[g]) for g in range(lists)]).alias("lows"))
    total = F.aggregate("lows", F.lit(0).cast("long"), lambda a, x: a + x)
    # Without k rows seen there is no cutoff, and everything is sufficient.
    cutoffs = lows.join(cut, of, "left").withColumn("slack", F.coalesce(F.col("cut") - total, F.lit(0)).cast("long"))
    reaches = F.exists(F.zip_with("highs", "lows", lambda h, low: (h - low) * lists >= F.col("slack")), lambda x: x)
    wanted, wanted_path = staged(seen.select(*of, "v_block", "highs").join(cutoffs, of).filter(reaches).drop("cut").withColumn("q_block", F.pmod(F.xxhash64("qrid"), F.lit(query_blocks))), "topk-open")
    cells = wanted.join(asked.select(F.col("id").alias("query_id"), F.col("rid").alias("qrid"), "v"), of)
    own = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  the sides share their origin
    needed, cells = own(v_side.join(wanted.select(*cell).distinct(), "v_block")), own(cells)
    found = needed.groupBy(*cell).cogroup(cells.groupBy(*cell)).applyInPandas(collect_and_resolve(lists, k), FOUND)
    found, _ = staged(found, "topk-found")
    for path in (blocks_path, seen_path, wanted_path):
        unstage(spark, path)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long"))))
    ranked = found.select(*of, "vec_id", "rid", "score", copies.alias("copy"))
    order = W.partitionBy(*of).orderBy(F.desc("score"), "vec_id", "rid", "copy")
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
