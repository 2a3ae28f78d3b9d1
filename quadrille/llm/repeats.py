"""Removal of long byte strings that occur elsewhere in the corpus, exactly, by prefix doubling.

Spark sorts pairs of ranks of positions at growing offsets and ranks the pairs anew;
positions whose pair is unique leave, and what is ranked is soon longer than the
threshold. So that a corpus of n bytes doesn't move n rows, the positions are anchors:
the least gram of some window of grams. Every string of ``length`` bytes holds an anchor
whose choice depends on that string alone, so equal strings meet at equal anchors. The
first symbol of an anchor is the bytes around it, 272 of them for a length of 400; so
the offsets are one anchor, and then the first anchor that takes the pair past the
threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import met, staged, unstage
from .text import FIELDS, ODD, SLICE, mix, stretch_hash, summed

GRAM = 16
#: Marks that a task gathers before it passes them on.
MARKS = 1 << 17
#: Groups with more different surroundings than this are matched row by row instead of in a task.
GROUP = 4096
#: Groups up to this size share a bin of about BIN_ROWS rows.
SMALL_GROUP, BIN_ROWS = 64, 2000


def window_size(length: int) -> int:
    """The widest window for which a string's middle, a window from either end, still holds a whole window."""
    return (length - GRAM) // 3


def sums(part: np.ndarray) -> list[np.ndarray]:
    return [summed(part, *field) for field in FIELDS]


def gram_order(part: np.ndarray) -> np.ndarray:
    """A number for the 16 bytes from each place on, by which the least of a window is chosen."""
    x = part.astype(np.uint64)
    for n in (1, 2, 4):
        x = x[:-n] | (x[n:] << np.uint64(8 * n))
    return mix(x[:-8] * ODD + x[8:])


def anchors(part: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the rightmost least gram of some window of grams."""
    n = len(part) - GRAM + 1
    if n < window:
        return np.zeros(0, np.int64)
    low = (gram_order(part) >> np.uint64(24) << np.uint64(24)) | (np.uint64((1 << 24) - 1) - np.arange(n, dtype=np.uint64))
    span = 1
    while span < window:
        step = min(span, window - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return np.unique((np.uint64((1 << 24) - 1) - (low & np.uint64((1 << 24) - 1))).astype(np.int64))


#: Bits of each distance that a mark packs into one number.
BITS = 20
#: Symbols of the places where a document starts and ends.
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def packed_gaps(back: np.ndarray, ahead: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (back.astype(np.int64) << (2 * BITS)) | (ahead.astype(np.int64) << BITS) | low.astype(np.int64)


def anchored(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbol, pos, gaps) of a document's anchors, and of its start and end.

    An anchor answers for the strings of which it is the first anchor a window or more
    from their start: they start in [lo, hi], past the anchor before it (or at the
    start) up to a window before it (or at the last string). ``symbol`` names the
    surroundings that all those strings hold. ``gaps`` packs the distances back to the
    anchor before (or the start), ahead to the first anchor whose surroundings reach
    past all those strings (or the end), and back to ``hi``. Long documents are worked
    off in slices.
    """
    w, n = window_size(length), len(data)
    buffer = np.frombuffer(data, np.uint8)
    for s in range(0, n if n >= length else 0, SLICE):
        base, end = max(0, s - 4 * w), min(n, s + SLICE + length + 4 * w)
        part = buffer[base:end]
        total = sums(part)
        pos = anchors(part, w)
        before = np.concatenate([[-(1 << 30)], pos[:-1]])
        lo = np.maximum(before - w + 1, -base)
        hi = np.minimum(pos - w, n - length - base)
        good = (lo <= hi) & (pos - w >= 0) & (pos + GRAM + w <= len(part))
        pos, before, hi = pos[good], before[good], hi[good]
        if not len(pos):
            continue
        first, last = base == 0, end == n
        at = np.searchsorted(pos, pos + length - GRAM - 2 * w)
        ahead = np.where(at < len(pos), pos[np.minimum(at, len(pos) - 1)], pos[-1] + 1) - pos
        back = np.where(before < w, pos + 1 if first else 0, pos - before)
        mine = (pos + base >= s) & (pos + base < s + SLICE)
        symbol = stretch_hash(total, pos - w, pos + GRAM + w)[mine]
        place, gaps = pos[mine] + base, packed_gaps(back[mine], ahead[mine], (pos - hi)[mine])
        if first and mine[0]:
            symbol = np.append(symbol, mix(stretch_hash(total, np.array([0]), pos[:1] + GRAM + w) + START))
            place, gaps = np.append(place, -1), np.append(gaps, 0)
        if last and mine[-1]:
            symbol = np.append(symbol, mix(stretch_hash(total, pos[-1:] - w, np.array([len(part)])) + END))
            place, gaps = np.append(place, pos[-1] + 1 + base), np.append(gaps, 0)
        yield symbol.view(np.int64), place, gaps


def in_order(reach: int):
    """Tasks: beside each anchor's rank those of the anchors ``back`` and ``ahead``, out of rows in the order of documents; -1 where that one has left.

    A document may run over many batches, so what lies within ``reach`` of the end of one is seen again with the next.
    """

    def beside(rows: pd.DataFrame) -> pd.DataFrame:
        did, th, pos, gaps, rank = (rows[c].to_numpy() for c in ("did", "th", "pos", "gaps", "rank"))
        new = np.ones(len(rows), bool)
        new[1:] = (did[1:] != did[:-1]) | (th[1:] != th[:-1])
        place = (np.cumsum(new) << 33) + pos
        mask, found = (1 << BITS) - 1, {}
        for c, distance in (("prior", -(gaps >> (2 * BITS))), ("later", (gaps >> BITS) & mask)):
            at = np.minimum(np.searchsorted(place, place + distance), len(place) - 1)
            found[c] = np.where((place[at] == place + distance) & (distance != 0), rank[at], -1)
        return rows.assign(**found)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            rows = part.assign(fresh=True)
            if held is not None:
                rows = pd.concat([held, rows], ignore_index=True)
            if not len(rows):
                continue
            did, th, pos, fresh = (rows[c].to_numpy() for c in ("did", "th", "pos", "fresh"))
            same = (did == did[-1]) & (th == th[-1])
            due = fresh & ~(same & (pos > pos[-1] - reach))
            yield beside(rows)[due & (rows["gaps"].to_numpy() != 0)].drop(columns="fresh")
            held = rows.assign(fresh=fresh & ~due)[same & (pos > pos[-1] - 2 * reach)]
        if held is not None and len(held):
            yield beside(held)[held["fresh"].to_numpy() & (held["gaps"].to_numpy() != 0)].drop(columns="fresh")

    return run


def ranked(rows: DataFrame, keys: list[str], tag: str, *extra: Column) -> DataFrame:
    """(keys, rank, n, extra) of the keys that are found more than once, ``rank`` being their place in sorted order."""
    often = rows.groupBy(*keys).agg(F.count("*").alias("n"), *extra).filter("n > 1")
    return staged(often.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), tag)[0]


def match_group(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Of strings around equal contexts, the starts of those found at least twice, for the anchors seen once; ``rows`` holds whole contexts."""
    held = [strings(row, length) for row in rows.itertuples(index=False)]
    start = np.concatenate([h[0] for h in held])
    owner = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
    offset = rows["pos"].to_numpy()[owner] - start
    name = np.concatenate([h[1] for h in held])
    context = rows["c"].to_numpy()[owner]
    order = np.lexsort((name, offset, context))
    same = (name[order][1:] == name[order][:-1]) & (offset[order][1:] == offset[order][:-1]) & (context[order][1:] == context[order][:-1])
    found = np.zeros(len(name), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    found &= rows["n"].to_numpy()[owner] == 1
    return runs(rows, owner[found], start[found], length)


def runs(rows: pd.DataFrame, owner: np.ndarray, start: np.ndarray, length: int) -> pd.DataFrame:
    """Runs of successive starts as covered spans."""
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start))[: len(first)] - 1
    at = owner[first]
    return pd.DataFrame({"did": rows["did"].to_numpy()[at], "th": rows["th"].to_numpy()[at], "a": start[first], "b": start[last] + length})


def strings(row, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names of an anchor's strings; their common context is left out, so windows of the rest name them."""
    rest = np.frombuffer(row.rest, np.uint8)
    size = length - GRAM - 2 * window_size(length)
    start = np.arange(row.lo, row.hi + 1)
    at = start - row.lo
    return start, stretch_hash(sums(rest), at, at + size)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(id, kept, n_bytes, n_removed, n_spans): every document without the bytes of repeated strings.

    A byte goes if a string of ``length`` bytes covers it that also starts anywhere
    else in the corpus, the same document included; strings are judged on the input.
    ``kept`` is binary: the cut may split a character.

    Anchors are ranked by the bytes around them; unique ones leave. Then pairs of
    ranks are ranked: each anchor's with that of the anchor before it, and that rank
    with that of the first anchor whose surroundings reach past all strings that the
    anchor answers for. Those strings are repeated where the last rank is. What is
    left, the edges of repeats, is compared string by string among equal surroundings.
    Ranks are sorted out of partial counts, keys of many positions are salted in the
    joins back, and only different surroundings of an anchor meet: in one task up to
    GROUP of them, beyond that as rows of single strings.

    Null or empty text is no bytes. Rows that repeat id and text are documents of
    their own, so both lose what they share. A null id is allowed. Any number of
    bytes in a text is worked off in slices.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    base = base.select("id", F.coalesce("id", F.lit(-(2**63))).alias("did"), F.xxhash64("text").alias("th"), "text")

    def locate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["symbol", "did", "th", "pos", "gaps"]
        for part in parts:
            rows, held = [], 0
            for did, th, text in zip(part["did"], part["th"], part["text"], strict=True):
                for c, p, g in anchored(text.encode("utf-8", "surrogatepass"), length):
                    rows.append((c, np.full(len(c), did), np.full(len(c), th), p, g))
                    held += len(c)
                    if held >= MARKS:
                        yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*rows, strict=True)), strict=True)))
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*rows, strict=True)), strict=True)))

    w, mask = window_size(length), (1 << BITS) - 1
    marks = base.filter(F.octet_length("text") >= length).select("did", "th", "text").mapInPandas(locate, "symbol long, did long, th long, pos int, gaps long")
    marks, marks_path = staged(marks, "repeat-anchors")
    place = ["did", "th", "pos"]
    # Round 0: ranks of the surroundings, and beside each those of the anchors that its pairs take.
    known = met(marks, ranked(marks, ["symbol"], "repeat-ranks"), ["symbol"], place, "n").drop("symbol")
    lined = known.repartition("did", "th").sortWithinPartitions("did", "th", "pos")
    seen, seen_path = staged(lined.mapInPandas(in_order(2 * length), "did long, th long, pos int, gaps long, rank long, prior long, later long"), "repeat-places")
    unstage(spark, marks_path)
    gap, ahead = F.shiftright("gaps", 2 * BITS), F.shiftright("gaps", BITS).bitwiseAND(mask)
    # A place one of whose anchors has left is unique: it keeps a number of its own, which no rank is, in place of one.
    alone = lambda salt: -1 - F.pmod(F.xxhash64(F.lit(salt), *place), F.lit(1 << 62))
    seen = seen.select(*place, "gaps", F.col("rank").alias("c"), F.when((F.col("prior") < 0) | (F.col("later") < 0), alone(1)).otherwise(F.col("prior")).alias("prior"), "later", gap.alias("gap"))
    # Round 1: with the anchor before. Round 2: with the anchor ahead, past the threshold.
    pair = ["prior", "gap", "c"]
    one = met(seen, ranked(seen.filter("prior >= 0"), pair, "repeat-ranks"), pair, place, "n", "left")
    one, one_path = staged(one.select(*place, "gaps", "c", F.coalesce("rank", alone(2)).alias("prior"), "later", ahead.alias("gap")), "repeat-pairs")
    unstage(spark, seen_path)
    pair = ["prior", "gap", "later"]
    ranks = ranked(one.filter("prior >= 0"), pair, "repeat-ranks", F.min("c").alias("c"), F.min(F.struct(*place, "gaps")).alias("at"))
    two, _ = staged(met(one, ranks.select(*pair, "rank", "n"), pair, place, "n", "left").select(*place, "gaps", "c", "rank"), "repeat-pairs")
    unstage(spark, one_path)
    back, low = F.shiftright("gaps", 2 * BITS), F.col("gaps").bitwiseAND(mask)
    lo, hi = F.greatest(F.col("pos") - back - w + 1, F.lit(0)).cast("int"), (F.col("pos") - low).cast("int")
    settled = two.filter("rank IS NOT NULL").select("did", "th", lo.alias("a"), (hi + length).alias("b"))
    # Different surroundings of equal anchors: those that are unique, and one place of each that is not.
    around = two.filter("rank IS NULL").select("c", F.lit(1).cast("long").alias("n"), *place, "gaps").unionByName(ranks.select("c", "n", "at.*"))
    edges = around.groupBy("c").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1")
    edges, _ = staged(edges.select("c", "kinds", F.col("kinds").alias("rows")), "repeat-kinds")
    open_ = met(around, edges, ["c"], place, "rows").select("c", "kinds", "n", *place, lo.alias("lo"), hi.alias("hi"))
    wanted = open_.groupBy("did", "th").agg(F.collect_list(F.struct("c", "kinds", "n", "pos", "lo", "hi")).alias("places"))

    def squeeze(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1)
        for part in parts:
            yield part.assign(text=[pack.compress(x.encode("utf-8", "surrogatepass")) for x in part["text"]]).rename(columns={"text": "z"})

    # Texts are shuffled compressed, which halves what the two joins move.
    packed = base.select(F.col("id").cast("string").alias("name"), "did", "th", "text").mapInPandas(squeeze, "name string, did long, th long, z binary")

    def fetch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            rows = []
            for did, th, z, places in zip(part["did"], part["th"], part["z"], part["places"], strict=True):
                data = unpack.decompress(z)
                for p in places:
                    rest = data[p["lo"] : p["pos"] - w] + data[p["pos"] + GRAM + w : p["hi"] + length]
                    rows.append((p["c"], p["kinds"], p["n"], did, th, p["pos"], p["lo"], p["hi"], rest))
            yield pd.DataFrame(rows, columns=["c", "kinds", "n", "did", "th", "pos", "lo", "hi", "rest"])

    one = packed.select("did", "th", "z").join(wanted, ["did", "th"]).dropDuplicates(["did", "th"])
    parts, _ = staged(one.mapInPandas(fetch, "c long, kinds long, n long, did long, th long, pos int, lo int, hi int, rest binary"), "repeat-edges")
    spans = "did long, th long, a int, b int"
    match = lambda rows: match_group(rows, length)
    # Small groups are matched many at a time.
    bins = max(1, parts.count() // BIN_ROWS)
    binned = parts.filter(F.col("kinds") <= SMALL_GROUP).groupBy(F.pmod("c", F.lit(bins))).applyInPandas(match, spans)
    small = binned.unionByName(parts.filter((F.col("kinds") > SMALL_GROUP) & (F.col("kinds") <= GROUP)).groupBy("c").applyInPandas(match, spans))

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                start, name = strings(row, length)
                yield pd.DataFrame({"c": row.c, "offset": row.pos - start, "name": name.view(np.int64), "n": row.n, "did": row.did, "th": row.th, "start": start})

    loose = parts.filter(F.col("kinds") > GROUP).mapInPandas(single, "c long, offset int, name long, n long, did long, th long, start int")
    again = loose.groupBy("c", "offset", "name").agg(F.count("*").alias("seen")).filter("seen > 1").drop("seen")
    large = loose.filter("n = 1").join(again, ["c", "offset", "name"]).select("did", "th", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    covered = settled.unionByName(small).unionByName(large).groupBy("did", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            rows = []
            for name, z, found in zip(part["name"], part["z"], part["spans"], strict=True):
                data, kept, cuts = unpack.decompress(z), [], 0
                end = 0
                for a, b in sorted((s["a"], s["b"]) for s in (found if found is not None else [])):
                    if a > end or not cuts:
                        kept.append(data[end:a])
                        cuts += 1
                    end = max(end, b)
                kept.append(data[end:])
                left = b"".join(kept)
                rows.append((name, left, len(data), len(data) - len(left), cuts))
            yield pd.DataFrame(rows, columns=["name", "kept", "n_bytes", "n_removed", "n_spans"])

    out = packed.join(covered, ["did", "th"], "left").select("name", "z", "spans").mapInPandas(cut, "name string, kept binary, n_bytes long, n_removed long, n_spans long")
    return out.select(F.col("name").cast("long").alias("id"), "kept", "n_bytes", "n_removed", "n_spans")
