"""Exact duplicates: counting quotient filters find repeated fingerprints, whole texts settle them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_RUN, met, staged

#: Fingerprints that one filter is built of; a partition with more makes several.
HELD = 1 << 20
#: The bits of a fingerprint, and those of its quotient at most: a remainder then holds any count of one filter.
BITS, MOST_QUOTIENT = 64, 28
FILTER = "block long, quotient_bits int, slots long, occupied binary, run_ends binary, counters binary, remainders binary"


def bits_of(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def packed_block(values: np.ndarray, counts: np.ndarray, quotient_bits: int, block_bits: int) -> tuple:
    """One block of a filter: sorted distinct fingerprints that share their first ``block_bits``.

    ``occupied`` has a bit for each quotient of the block, ``run_ends`` marks the last slot
    of each quotient's run, and ``counters`` the slots that hold the count of the remainder
    before them; a remainder without one counts once.
    """
    left = BITS - quotient_bits
    quotients = (values >> np.uint64(left)).astype(np.int64) & ((1 << (quotient_bits - block_bits)) - 1)
    occupied = np.zeros(1 << (quotient_bits - block_bits), bool)
    occupied[quotients] = True
    many = counts > 1
    at = np.arange(len(values)) + np.cumsum(many) - many
    slots = np.zeros(len(values) + int(many.sum()), np.uint64)
    slots[at] = values & np.uint64((1 << left) - 1)
    counters = np.zeros(len(slots), bool)
    counters[at[many] + 1] = True
    slots[at[many] + 1] = counts[many]
    ends = np.zeros(len(slots), bool)
    last = np.append(quotients[1:] != quotients[:-1], True)
    ends[(at + many)[last]] = True
    width = (left + 7) // 8
    raw = slots.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
    return quotient_bits, len(slots), bits_of(occupied), bits_of(ends), bits_of(counters), raw.tobytes()


def unpacked_block(block: int, block_bits: int, quotient_bits: int, slots: int, occupied: bytes, run_ends: bytes, counters: bytes, remainders: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a block and their counts; nothing is lost."""
    left = BITS - quotient_bits
    width = (left + 7) // 8
    raw = np.zeros((slots, 8), np.uint8)
    raw[:, 8 - width :] = np.frombuffer(remainders, np.uint8).reshape(slots, width)
    values = raw.view(">u8").ravel().astype(np.uint64)
    ends, counted = flags_of(run_ends, slots), flags_of(counters, slots)
    quotients = np.flatnonzero(flags_of(occupied, 1 << (quotient_bits - block_bits))).astype(np.uint64)
    run = np.cumsum(ends) - ends  # which run each slot is in
    at = np.flatnonzero(~counted)
    counts = np.ones(len(at), np.int64)
    with_count = np.append(counted[1:], False)[at]
    counts[with_count] = values[at[with_count] + 1].astype(np.int64)
    high = (np.uint64(block) << np.uint64(quotient_bits - block_bits)) | quotients[run[at]]
    return (high << np.uint64(left)) | values[at], counts


def filter_rows(prints: np.ndarray, block_bits: int) -> pa.RecordBatch:
    """A filter of one stretch of fingerprints, a row for each of its blocks; with as many quotients as the next power of two has fingerprints."""
    values, counts = np.unique(prints, return_counts=True)
    quotient_bits = min(MOST_QUOTIENT, max(block_bits, int(len(values) - 1).bit_length()))
    block = (values >> np.uint64(BITS - block_bits)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    rows = [(int(block[a]), *packed_block(values[a:e], counts[a:e].astype(np.uint64), quotient_bits, block_bits)) for a, e in zip(cuts, np.append(cuts[1:], len(values)), strict=True)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = [f.split()[0] for f in FILTER.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def built(block_bits: int):
    """Tasks: the filters of a partition's fingerprints."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in parts:
            held.append(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += part.num_rows
            if n >= HELD:
                yield filter_rows(np.concatenate(held), block_bits)
                held, n = [], 0
        if n:
            yield filter_rows(np.concatenate(held), block_bits)

    return run


def merged(block_bits: int):
    """Tasks: blocks of all filters, sorted by block; the fingerprints that count more than once in all of them."""

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        values, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(values, kind="stable")  # merges the sorted runs
        values, counts = values[order], counts[order]
        new = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        return values[new], np.add.reduceat(counts, new)

    def found(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        values, counts = summed(held)
        many = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(values[many].view(np.int64)), pa.array(counts[many])], names=["__fp", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, n = None, [], 0
        for part in parts:
            for row in part.to_pylist():
                if row["block"] != at and held:
                    yield found(held)
                    held, n = [], 0
                at = row.pop("block")
                held.append(unpacked_block(at, block_bits, **row))
                n += len(held[-1][0])
                if n > HELD and len(held) > 1:  # merged as they come, so a block holds its distinct fingerprints only
                    held = [summed(held)]
                    n = 0
        if held:
            yield found(held)

    return run


def repeated_fingerprints(prints: DataFrame) -> DataFrame:
    """(__fp, n) of the 64-bit fingerprints (one column, long) that occur more than once.

    Every partition makes counting quotient filters of its fingerprints. Their blocks are
    shuffled and merged by sorted remainders, so a fingerprint of any number of rows is
    one slot and one counter a filter by then.
    """
    spark = prints.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    block_bits = min(MOST_QUOTIENT, (16 * tasks - 1).bit_length())
    blocks = prints.mapInArrow(built(block_bits), FILTER)
    return blocks.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(merged(block_bits), "__fp long, n long")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS_RUN, " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint=F.xxhash64) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row: which rows have equal texts, and which of them stays.

    Texts are equal when they are the same bytes after every run of white space has become
    one space. Fingerprints of 64 bits go into counting quotient filters; only rows whose
    fingerprint counts more than once take part in the comparison of whole texts, which
    is a grouping by fingerprint and text: copies within a task become one row before
    they are shuffled, and rows of hot fingerprints are dealt out. ``fingerprint`` may be
    any function of a text to a long; texts that share one by chance stay apart.

    Null text counts as empty. The smallest id of a group stays; rows that repeat it all
    do. A null id stays only where no row of its group has an id (keep_id is null then).
    Only id and text are read, so other columns can't clash.
    """
    text = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), text.alias("__text")).withColumn("__fp", fingerprint("__text"))
    narrow, _ = staged(rows.select("__id", "__fp", F.unhex(F.sha2("__text", 256)).alias("__sha")), "exact-prints")
    found, _ = staged(repeated_fingerprints(narrow.select("__fp")), "exact-repeats")
    same = met(rows, found, ["__fp"], ["__id"]).groupBy("__fp", "__text").agg(F.min("__id").alias("keep_id"), F.count("*").alias("n"))
    # Groups are of whole texts; their digests only bring them back to narrow rows.
    groups, _ = staged(same.select("__fp", F.unhex(F.sha2("__text", 256)).alias("__sha"), "keep_id", "n", F.col("n").alias("group_size")), "exact-groups")
    told = met(narrow, groups, ["__fp", "__sha"], ["__id"], how="left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("__id")).otherwise(F.col("keep_id"))
    return told.select(
        F.col("__id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("__id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("__sha")).alias("text_sha256"),
    )
