"""Alignment of the tokens of two tokenizers, and how well linked id pairs agree over all documents."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT_KEYS, SALTS, staged
from .pieces import MARK, default_model

#: Text of a batch in bytes, and its documents at most; a longer text is a batch of its own.
TOGETHER, MOST_DOCS = 1 << 21, 1 << 14
#: Links spelled out at a time, and those of a group from which distinct ids are counted first.
LINKS, LARGE = 1 << 21, 1 << 12
#: Characters of the stretches whose pieces a task keeps.
KEPT = 2_000_000

#: The alphabet of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up, in order. A fixed rule.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The pattern that splits text before merges of such vocabularies; a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}


def stretches_of(pieces: Iterable[str]) -> re.Pattern:
    """Where texts may be cut so that no piece spans a cut: before spaces and, unless a piece holds one, around line ends."""
    pieces = list(pieces)
    if any(MARK in p.lstrip(MARK) for p in pieces) or any("\n" in p for p in pieces):
        raise ValueError("a piece spans a space or a line end, so texts can't be encoded stretch by stretch")
    return re.compile(" *[^ \n]+| +|\n")


class BytePairs:
    """A byte-level vocabulary out of its JSON: ids and the bytes of each. Strings of special tokens are plain text."""

    def __init__(self, data: bytes):
        import tiktoken

        told = json.loads(data)
        special = {t["id"] for t in told["added_tokens"]}
        back = byte_alphabet()
        ranks = {bytes(back[c] for c in s): i for s, i in told["model"]["vocab"].items() if i not in special}
        # Entries are numbered in the order of their merges, so ids are ranks.
        self.encoding = tiktoken.Encoding("pairs", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.surface = [b""] * (max(ranks.values()) + 1)
        for s, i in ranks.items():
            self.surface[i] = s

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.encoding.encode_ordinary(" " + t), np.int64) for t in texts]


class Pieces:
    """A model of pieces with byte fallback; it puts the space before a text itself.

    No piece goes on past a space or a line end, so a text is the sequence of its
    stretches (a word with the spaces before it), whose pieces are kept.
    """

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.surface = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.stretch = stretches_of(p for i, p in enumerate(pieces) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)))
        self.kept: dict[str, bytes] = {}
        self.chars = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.chars > KEPT:
            self.kept, self.chars = {}, 0
        split = [self.stretch.findall(" " + t) for t in texts]
        new = list(dict.fromkeys(s for x in split for s in x if s not in self.kept))
        # Behind a line end, which makes two tokens of its own, a stretch is encoded as within a text.
        made = self.model.encode(["\n" + s for s in new], num_threads=1)
        for s, ids in zip(new, made, strict=True):
            self.kept[s] = np.array(ids[2:], np.int32).tobytes()
            self.chars += len(s)
        return [np.frombuffer(b"".join(map(self.kept.__getitem__, x)), np.int32).astype(np.int64) for x in split]


class Aligner:
    """Both tokenizers, and the tables that turn ids to byte lengths and to text."""

    def __init__(self, a: bytes, b: bytes):
        self.sides = (BytePairs(a), Pieces(b))
        self.lengths = [np.array([len(s) for s in side.surface], np.int64) for side in self.sides]
        self.bits = [len(side.surface).bit_length() for side in self.sides]
        # Text of an id and of what comes after it: another of its group, or the group's other side or end.
        self.words, self.first = [], []
        for side, end in zip(self.sides, (b"|", b";"), strict=True):
            for after in (b",", end):
                self.first.append(len(self.words))
                self.words += [b"%d%s" % (i, after) for i in range(len(side.surface))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts have tokens, and per side the ids of those texts and their numbers."""
        some = [k for k, t in enumerate(texts) if t and MARK not in t]
        ids = [side.encode([texts[k] for k in some]) for side in self.sides]
        raw = [(" " + texts[k]).encode("utf-8", "surrogatepass") for k in some]
        joined = [[b"".join(map(side.surface.__getitem__, x.tolist())) for x in xs] for side, xs in zip(self.sides, ids, strict=True)]
        fine = [k for k in range(len(some)) if joined[0][k] == raw[k] == joined[1][k]]
        size = [np.fromiter((len(xs[k]) for k in fine), np.int64, len(fine)) for xs in ids]
        return np.array([some[k] for k in fine], np.int64), [np.concatenate([np.zeros(0, np.int64), *[xs[k] for k in fine]]) for xs in ids], size

    def batch(self, texts: list[str]) -> dict:
        """Tokens, groups and links of some texts.

        Texts are laid end to end, and the bytes of both sides are the same, so one
        search finds where tokens of both sides end, for all texts.
        """
        rows, ids, size = self.encode(texts)
        ends = [np.cumsum(n[x]) for n, x in zip(self.lengths, ids, strict=True)]
        cuts = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(cuts, e) for e in ends]
        doc = [np.repeat(rows, n) for n in size]
        per = [np.bincount(g, minlength=len(cuts)) for g in group]
        of = doc[0][np.cumsum(per[0]) - 1] if len(cuts) else np.zeros(0, np.int64)
        n = len(texts)
        count = lambda at, w=None: np.bincount(at, w, n).astype(np.int64)
        links = np.zeros(n, np.int64)
        np.add.at(links, of, per[0] * per[1])
        told = [""] * n
        for row, text in zip(rows.tolist(), self.written(ids, group, size), strict=True):
            told[row] = hashlib.sha256(text).hexdigest()
        return {"n_a": count(doc[0]), "n_b": count(doc[1]), "n_groups": count(of), "n_links": links, "groups_sha256": told, "rows": rows, "ids": ids, "size": size, "ends": ends, "cuts": cuts, "group": group, "doc": doc, "per": per, "of": of}

    def written(self, ids: list[np.ndarray], group: list[np.ndarray], size: list[np.ndarray]) -> Iterator[bytes]:
        """Of each text `a1,a2|b1;a3|b2,b3`: the ids of both sides, group by group."""
        words = []
        for k in range(2):
            last = np.append(group[k][1:] != group[k][:-1], True)[: len(group[k])]
            words.append(ids[k] + np.where(last, self.first[2 * k + 1], self.first[2 * k]))
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        at = np.concatenate(words)[order].tolist()
        ends = np.cumsum(size[0] + size[1]).tolist()
        for a, e in zip([0, *ends], ends, strict=False):
            yield b"".join(map(self.words.__getitem__, at[a:e]))[:-1]

    def postings(self, got: dict) -> tuple[np.ndarray, ...]:
        """(a, b, doc, times) of all links, distinct and in that order.

        A group's links are all pairs of its tokens of both sides; they are spelled out
        LINKS at a time, and in large groups ids are counted before they are paired.
        """
        (ia, ib), (ga, gb), (na, nb) = got["ids"], got["group"], got["per"]
        bits_b, bits_d = self.bits[1], MOST_DOCS.bit_length()
        named = lambda a, b, d: (((a << bits_b) | b) << bits_d) | d
        start = np.cumsum(nb) - nb
        large = na * nb > LARGE
        each = np.where(large, 0, nb)[ga] if len(ga) else np.zeros(0, np.int64)
        upto = np.cumsum(each)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        while at < len(ia):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, side="right")))
            r = each[at:end]
            a = np.repeat(np.arange(at, end), r)
            b = start[ga[a]] + np.arange(len(a)) - np.repeat(np.cumsum(r) - r, r)
            held.append(np.unique(named(ia[a], ib[b], got["doc"][0][a]), return_counts=True))
            at = end
        ends_a, ends_b = np.cumsum(na), np.cumsum(nb)
        for g in np.flatnonzero(large).tolist():
            ua, ca = np.unique(ia[ends_a[g] - na[g] : ends_a[g]], return_counts=True)
            ub, cb = np.unique(ib[ends_b[g] - nb[g] : ends_b[g]], return_counts=True)
            step = max(1, LINKS // len(ub))
            for k in range(0, len(ua), step):
                held.append((named(ua[k : k + step, None], ub[None], got["of"][g]).ravel(), (ca[k : k + step, None] * cb[None]).ravel()))
        keys, times = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int64)), *held, strict=True))
        if len(held) > 1:
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, times = keys[new], np.add.reduceat(times, new)
        pair = keys >> bits_d
        return pair >> bits_b, pair & ((1 << bits_b) - 1), keys & ((1 << bits_d) - 1), times


@lru_cache(maxsize=2)
def aligner_of(a: bytes, b: bytes) -> Aligner:
    """Kept between the tasks of a worker."""
    return Aligner(a, b)


def default_pairs() -> str:
    """The path of the public byte-level vocabulary; any other path may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_files(spark: SparkSession, a_file: str | None, b_file: str | None):
    """Both vocabularies, read by the driver; they don't grow with the data."""
    raw = []
    for path in (a_file or default_pairs(), b_file or default_model()):
        with open(path, "rb") as f:
            raw.append(f.read())
    return spark.sparkContext.broadcast(tuple(raw))


def batched(part: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of TOGETHER bytes or MOST_DOCS documents at most."""
    ids, texts = part.column("id").to_pylist(), part.column("text")
    at, size = 0, 0
    sizes = [0 if s is None else s for s in part.column("size").to_pylist()]
    for k in range(len(ids)):
        if k > at and (size + sizes[k] > TOGETHER or k - at >= MOST_DOCS):
            yield ids[at:k], texts.slice(at, k - at).to_pylist()
            at, size = k, 0
        size += sizes[k]
    if len(ids) > at:
        yield ids[at:], texts.slice(at).to_pylist()


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.octet_length(text).alias("size"))


TOLD = pa.schema([("batch", pa.int64()), ("k", pa.int32()), ("id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32()), ("docs", pa.list_(pa.int16())), ("times", pa.list_(pa.int32()))])
TOLD_SQL = "batch long, k int, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, n int, docs array<smallint>, times array<int>"


def filled(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in TOLD], schema=TOLD)


def told_of(files):
    """Tasks: of each batch of texts a row per document, and a row per linked pair with its documents in the batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, batch = aligner_of(*files.value), TaskContext.get().partitionId() << 32
        for part in parts:
            for ids, texts in batched(part):
                got = aligner.batch(texts)
                n = len(ids)
                whole = {c: pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}
                whole |= {"k": pa.array(np.arange(n, dtype=np.int32)), "id": pa.array(ids, pa.int64()), "groups_sha256": pa.array(got["groups_sha256"], pa.string()), "batch": pa.array(np.full(n, batch))}
                yield filled(whole, n)
                a, b, doc, times = aligner.postings(got)
                if len(a):
                    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                    size = np.diff(new, append=len(a))
                    several = np.repeat(np.maximum.reduceat(times, new) > 1, size)  # elsewhere all times are 1 and left out
                    lists = lambda values, sizes, kind: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))
                    kept = np.where(several[new], size, 0)
                    columns = {"a": pa.array(a[new], pa.int32()), "b": pa.array(b[new], pa.int32()), "n": pa.array(size, pa.int32()), "docs": lists(doc, size, pa.int16()), "times": lists(times[several], kept, pa.int32())}
                    yield filled(columns | {"batch": pa.array(np.full(len(new), batch))}, len(new))
                batch += 1

    return run


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, count, best, total) out of rows (a, b, n): the documents of each linked id pair, whether they are the most that ``a`` has with any ``b``, and the sum for ``a``.

    An ``a`` has no more rows here than the other vocabulary has ids.
    """
    counts = postings.groupBy("a", "b").agg(F.sum("n").alias("count"))
    of_a = W.partitionBy("a")
    return counts.select("a", "b", "count", (F.col("count") == F.max("count").over(of_a)).alias("best"), F.sum("count").over(of_a).alias("total"))


def token_alignment(docs: DataFrame, a_file: str | None = None, b_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    A space and the text are encoded by a byte-level vocabulary (``a_file``, JSON) and by
    a model of pieces (``b_file``). Byte offsets where tokens of both end cut them into
    groups; in a group all tokens of one side are linked to all of the other. The count
    of an id pair is the number of documents that have it linked anywhere.

    Batches of documents are turned to postings: a row per linked pair with the documents
    of the batch and the times in each. Their counts are summed by pair, and the highest
    found for each ``a``, over narrow rows. Postings and counts are then dealt by side id
    ``a``, those of frequent ids also by batch, and sorted, so that Spark merges both
    streams and may spill; what a posting gives its documents is summed by document, in
    each task before it is shuffled. No task holds the documents of an id.

    Texts that are null, empty, or not given back by the bytes of both sides have no
    tokens: zeros and an empty groups_sha256. Rows that repeat an id, or have none, are
    documents of their own. Only id and text are read, so other columns can't clash.
    """
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    told, _ = staged(rows_of(docs, id_col, text_col).mapInArrow(told_of(broadcast_files(spark, a_file, b_file)), TOLD_SQL), "alignment", compression="zstd")
    postings = told.filter(F.col("a").isNotNull()).select("batch", "a", "b", "n", "docs", "times")
    counts, _ = staged(pair_counts(postings.select("a", "b", "n")), "alignment-counts")
    links = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("total") > links // HOT_KEYS)
    salted = F.broadcast(hot.groupBy("a").agg(F.lit(True).alias("hot")))  # fewer than HOT_KEYS rows
    dealt = postings.join(salted, "a", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("batch"), F.lit(SALTS))).otherwise(0).cast("int")).drop("hot", "n")
    ways = counts.select("a", "b", "count", "best", F.explode(F.sequence(F.lit(0), F.when(F.col("total") > links // HOT_KEYS, SALTS - 1).otherwise(0))).alias("salt"))
    met = dealt.repartition(tasks, "a", "salt").join(ways.repartition(tasks, "a", "salt"), ["a", "salt", "b"])
    each = met.select("batch", "count", "best", "times", F.posexplode("docs").alias("i", "k"))
    each = each.select("batch", F.col("k").cast("int").alias("k"), "count", "best", F.coalesce(F.get("times", "i"), F.lit(1)).cast("long").alias("m"))
    sums = each.groupBy("batch", "k").agg(F.sum(F.when(F.col("best"), F.col("m"))).alias("n_best"), F.sum(F.col("m") * F.col("count")).alias("count_sum"))
    whole = told.filter(F.col("a").isNull()).select("batch", "k", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    none = F.lit(0).cast("long")
    return whole.join(sums, ["batch", "k"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"
    )


def token_groups(docs: DataFrame, a_file: str | None = None, b_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, b_ids, a_group, b_group, ends) per row of ``docs``: the tokens of both sides, the group of each, and the byte of space and text where each group ends."""
    files = broadcast_files(docs.sparkSession, a_file, b_file)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*files.value)
        for part in parts:
            for ids, texts in batched(part):
                got = aligner.batch(texts)
                n = len(ids)
                first = np.full(n, len(got["cuts"]))
                np.minimum.at(first, got["of"], np.arange(len(got["cuts"])))
                byte = np.append(0, got["cuts"])[first]
                lists = lambda values, of: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=n))), pa.int32()), pa.array(values, pa.int32()))
                (da, db), (ga, gb) = got["doc"], got["group"]
                columns = [pa.array(ids, pa.int64()), lists(got["ids"][0], da), lists(got["ids"][1], db), lists(ga - first[da], da), lists(gb - first[db], db), lists(got["cuts"] - byte[got["of"]], got["of"])]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "a_ids", "b_ids", "a_group", "b_group", "ends"])

    lists = "a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, ends array<int>"
    return rows_of(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, {lists}")
