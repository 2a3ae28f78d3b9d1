"""Corpus-wide removal of repeated lines, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, lower_ascii, met, packed, staged, unpacked


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WS)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, max_docs: int = 1) -> DataFrame:
    """Drop lines whose key is found in more than ``max_docs`` documents.

    A line's key is the line stripped of white space and lower-cased (ASCII);
    keys of at least ``min_chars`` code points count. The smallest document id
    that holds a key keeps its lines. Returns all columns of ``docs`` with the
    text replaced, and ``n_lines`` (before) and ``n_dropped`` (long).

    Keys travel as 128 hash bits. Documents of a key are counted by partial
    aggregates (a hot line is one row per task); the keys to drop are staged, and in
    the join back the few that hold a large share of all lines are salted. The kept
    text never enters the key shuffle.

    Null or empty text is one empty line. A row whose id is null neither counts
    as a document nor loses lines. Rows that repeat an id count as the same
    document. Columns named like those added are replaced.
    """
    base = packed(docs, id_col, text_col).withColumn("__th", F.xxhash64("__text"))
    lines = base.filter(F.col("__id").isNotNull()).select("__id", "__th", F.posexplode(F.split("__text", "\n", -1)).alias("__pos", "__line"))
    keyed = (
        lines.select("__id", "__th", "__pos", line_key(F.col("__line")).alias("__key"))
        .filter(F.char_length("__key") >= min_chars)
        .select("__id", "__th", "__pos", F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(7), "__key").alias("__h2"))
    )
    if max_docs == 1:
        found = keyed.groupBy("__h1", "__h2").agg(F.min("__id").alias("__first"), F.max("__id").alias("__last"), F.count("*").alias("__n"))
        found = found.filter(F.col("__first") != F.col("__last")).drop("__last")
    else:
        found = keyed.groupBy("__h1", "__h2", "__id").agg(F.count("*").alias("__n")).groupBy("__h1", "__h2").agg(F.min("__id").alias("__first"), F.count("*").alias("__docs"), F.sum("__n").alias("__n"))
        found = found.filter(F.col("__docs") > max_docs).drop("__docs")
    found, _ = staged(found, "line-keys")
    drops = (
        met(keyed, found, ["__h1", "__h2"], ["__id", "__pos"], "__n")
        .filter(F.col("__id") != F.col("__first"))
        .groupBy("__id", "__th")
        .agg(F.sort_array(F.collect_set("__pos")).alias("__drops"))
    )
    joined = base.join(drops, ["__id", "__th"], "left").select("__rec", F.split("__text", "\n", -1).alias("__lines"), F.coalesce("__drops", F.array().cast("array<int>")).alias("__drops"))
    # The stretches between dropped positions, so that the work is linear in the lines.
    size = F.size("__lines")
    ends = F.concat("__drops", F.array(size))
    starts = F.concat(F.array(F.lit(0)), F.transform("__drops", lambda p: p + 1))
    cut = joined.select("__rec", "__lines", F.size("__drops").alias("__nd"), F.arrays_zip(starts.alias("s"), ends.alias("e")).alias("__runs"))
    kept = F.flatten(F.transform("__runs", lambda r: F.slice(F.col("__lines"), r["s"] + 1, r["e"] - r["s"])))
    return unpacked(
        cut,
        docs,
        {text_col: F.array_join(F.when(F.col("__nd") == 0, F.col("__lines")).otherwise(kept), "\n"), "n_lines": F.size("__lines").cast("long"), "n_dropped": F.col("__nd").cast("long")},
    )
