"""Greedy batches of rows in order, over blocks of rows in parallel."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.sources.files import numbered
from quadrille.sources.staging import staged, unstage

#: Rows of a block, unless ``limit`` is larger: every row weighs 1 at least, so a batch ends in its block or the next.
BLOCK = 1 << 17


@dataclass
class Blocks:
    """What is known of all blocks: an entry for each BLOCK rows, not for rows."""

    rows: int
    base: np.ndarray
    last: np.ndarray
    fresh: np.ndarray

    def of_start(self, t: np.ndarray) -> np.ndarray:
        """The blocks of the first rows with a weight of ``t`` or more before them; as many as there are blocks where there is none."""
        return np.searchsorted(self.last, t)


def census(narrow: DataFrame, rows: int) -> Blocks:
    told = narrow.groupBy("block").agg(F.sum("w").alias("w"), F.min_by("key", "no").alias("a"), F.max_by("key", "no").alias("z"), F.max_by("w", "no").alias("last")).orderBy("block").collect()
    ends = np.cumsum([r["w"] for r in told]) if told else np.zeros(0, np.int64)
    fresh = np.array([k == 0 or r["a"] != told[k - 1]["z"] for k, r in enumerate(told)], bool)
    return Blocks(rows, ends - np.array([r["w"] for r in told], np.int64), ends - np.array([r["last"] for r in told], np.int64), fresh)


@dataclass
class Block:
    """The rows of one block in order: where groups start, and where the batch after that of each row would start.

    ``after`` is a row of the block, or -1 where no batch follows in it; ``exit`` is the
    last start of a chain of batches that goes on into the next block, or -1.
    """

    first: int
    key: np.ndarray
    start: np.ndarray
    before: np.ndarray
    after: np.ndarray
    exit: np.ndarray

    @classmethod
    def of(cls, rows: pd.DataFrame, blocks: Blocks, limit: int) -> Block:
        rows = rows.sort_values("no")
        b, n, key = int(rows["block"].iloc[0]), len(rows), rows["key"].to_numpy(object)
        w = rows["w"].to_numpy(np.int64)
        upto = blocks.base[b] + np.cumsum(w)
        before = upto - w
        start = np.append(blocks.fresh[b], key[1:] != key[:-1])
        heads = np.append(np.flatnonzero(start), n)
        end = heads[np.searchsorted(heads, np.arange(n), side="right")]
        goes_on = b + 1 < len(blocks.base) and not blocks.fresh[b + 1]
        after = np.searchsorted(upto, before + limit) + 1
        open_ = (end == n) & goes_on
        leaves = open_ & (after >= n)
        after = np.where(after < end, after, -1)
        at = np.arange(n)
        exit_ = np.where(leaves, at, -1)
        jump = np.where(leaves, at, after)
        while True:  # a chain is followed twice as far each time
            further = np.where(jump >= 0, jump[jump], -1)
            if (further == jump).all():
                break
            jump = further
        exit_ = np.where(jump >= 0, np.where(leaves[jump], jump, -1), -1)
        return cls(int(rows["no"].iloc[0]), key, start, before, after, exit_)


def reached(nodes: DataFrame) -> DataFrame:
    """(node, entry) of all nodes that marked ones lead to, by pointer jumping over staged tables; ``nodes`` is (node, entry, jump, mark)."""
    known = staged(nodes, "batch-nodes")
    entries, seen = known.select("node", "entry"), known.filter("mark").count()
    now = known
    while True:
        ends = now.select(F.col("node").alias("jump"), F.col("jump").alias("further"), F.lit(True).alias("real"))
        stepped = now.join(ends, "jump", "left")
        moved = stepped.select("node", F.col("further").alias("jump"), "mark")
        marks = stepped.filter(F.col("mark") & F.col("real")).select(F.col("jump").alias("node"), F.lit(None).cast("long").alias("jump"), F.lit(True).alias("mark"))
        step = staged(moved.unionByName(marks).groupBy("node").agg(F.max("jump").alias("jump"), F.max("mark").alias("mark")), "batch-nodes")
        if now is not known:
            unstage(now)
        now, count = step, step.filter("mark").count()
        if count == seen:
            return now.filter("mark").select("node").join(entries, "node")
        seen = count


def batches(df: DataFrame, group: str, order: str, weight: str, limit: int, block: int = BLOCK) -> DataFrame:
    """Add ``batch``: rows of a group in order, a new batch once the weights of one reach ``limit`` (a row weighs 1 at least).

    Each batch starts where the last one ends, but what follows a start is the same
    whoever leads to it. So blocks of rows, numbered over the whole table, work out by
    themselves where a chain of batches that starts at any row leaves them; pointer
    jumping over those rows alone (fewer than ``limit`` a block) finds the chains that
    start at a group's first row, in as many rounds as the blocks of a group have binary
    digits; and each block marks its starts from where they enter it. No task holds more
    than a block, whatever the size of a group; the driver gets a row a block.

    Rows that tie in ``order`` may come in any order; a null group is a group.
    """
    spark: SparkSession = df.sparkSession
    rows = max(block, limit)
    laid = numbered(df, [group, order], "__no")
    key = F.concat(F.when(F.col(group).isNull(), "n").otherwise("v"), F.coalesce(F.col(group).cast("string"), F.lit("")))
    w = F.greatest(F.coalesce(F.col(weight).cast("long"), F.lit(1)), F.lit(1))
    number = F.col("__no")
    narrow = staged(laid.select(number.alias("no"), key.alias("key"), w.alias("w"), F.floor((number - 1) / rows).alias("block")), "batch-rows")
    blocks = spark.sparkContext.broadcast(census(narrow, rows))
    read: Callable[[pd.DataFrame], Block] = lambda part: Block.of(part, blocks.value, limit)

    def leaving(part: pd.DataFrame) -> pd.DataFrame:
        """The rows that chains leave a block from, and which of them a group's first row leads to."""
        x = read(part)
        at = np.flatnonzero(x.exit == np.arange(len(x.exit)))
        heads = x.exit[x.start]
        t = x.before[at] + limit
        to = blocks.value.of_start(t)
        out = pd.DataFrame({"node": x.first + at, "t": t, "block": to, "key": x.key[at], "mark": np.isin(at, heads[heads >= 0])})
        return out[to < len(blocks.value.base)]

    def entering(part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Where chains enter a block, and where they leave it again."""
        if not len(asked) or not len(part):
            return pd.DataFrame({"node": [], "entry": [], "jump": [], "mark": []})
        x = read(part)
        at = np.searchsorted(x.before, asked["t"].to_numpy(np.int64))
        same = x.key[at] == asked["key"].to_numpy(object)
        out = x.exit[at]
        jump = pd.arrays.IntegerArray(x.first + out.astype(np.int64), out < 0)
        return pd.DataFrame({"node": asked["node"].array, "entry": x.first + at, "jump": jump, "mark": asked["mark"].array})[same]

    def marked(part: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        """Every row with the starts up to it in the block, and up to its group's first row if that is in the block."""
        if not len(part):
            return pd.DataFrame({"no": [], "block": [], "n": [], "head": []})
        x = read(part)
        after, is_start = x.after.tolist(), x.start.copy()
        for i in [*np.flatnonzero(x.start).tolist(), *(entries["entry"].to_numpy(np.int64) - x.first).tolist()]:
            while i >= 0:
                is_start[i] = True
                i = after[i]
        n = np.cumsum(is_start)
        head = np.where(np.cumsum(x.start) > 0, np.maximum.accumulate(np.where(x.start, n, 0)), -1)
        return pd.DataFrame({"no": x.first + np.arange(len(n)), "block": int(part["block"].iloc[0]), "n": n, "head": head})

    asked = narrow.groupBy("block").applyInPandas(leaving, "node long, t long, block long, key string, mark boolean")
    by_block = narrow.groupBy("block")
    nodes = by_block.cogroup(asked.groupBy("block")).applyInPandas(entering, "node long, entry long, jump long, mark boolean")
    entries = reached(nodes).select("entry", F.floor((F.col("entry") - 1) / rows).alias("block"))
    told = staged(by_block.cogroup(entries.groupBy("block")).applyInPandas(marked, "no long, block long, n long, head long"), "batch-marks")
    ends = told.groupBy("block").agg(F.max("n").alias("n"), F.max("head").alias("head")).orderBy("block").collect()
    starts, total, open_head = [], 0, 0
    for r in ends:
        starts.append((r["block"], total, open_head))
        open_head = total + r["head"] if r["head"] >= 0 else open_head
        total += r["n"]
    carried = F.broadcast(spark.createDataFrame(starts or [(0, 0, 0)], "block long, base long, open long"))
    number = told.join(carried, "block").select(F.col("no").alias("__no"), (F.col("base") + F.col("n") - F.when(F.col("head") >= 0, F.col("base") + F.col("head")).otherwise(F.col("open"))).alias("batch"))
    return laid.join(number, "__no").drop("__no")
