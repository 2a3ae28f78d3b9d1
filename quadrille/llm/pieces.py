"""Merge-type piece encoding with seeded merge dropout, and its lossless decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import mix

MARK = "▁"
MASK = (1 << 64) - 1
#: Characters of the stretches whose runs of merges a task keeps, and the longest stretch of which it does.
KEPT, KEPT_CHARS = 2_000_000, 48
#: Factors of position and piece in the hash that skips a candidate.
AT, PIECE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Stretches merged in step, and characters of text worked off together.
STEP, TOGETHER = 8192, 1 << 20
#: The rank of no candidate.
NONE = (1 << 31) - 1


def default_model() -> str:
    """The path of the public model with byte fallback; any other path may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def draws(at: np.ndarray, piece: np.ndarray) -> np.ndarray:
    return at.astype(np.uint64) * np.uint64(AT) + piece.astype(np.uint64) * np.uint64(PIECE)


def skips(x: np.ndarray, limit: int) -> np.ndarray:
    """Whether the hash of each of ``x`` is under ``limit``."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(PIECE)
    return (x >> np.uint64(32)) < np.uint64(limit)


def code_points(stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters, and each one's stretch and place in it."""
    size = np.fromiter(map(len, stretches), np.int64, len(stretches))
    chars = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32)
    return chars, np.repeat(np.arange(len(size)), size), np.arange(len(chars)) - np.repeat(np.cumsum(size) - size, size)


def content(stretches: list[str]) -> np.ndarray:
    """A number for the characters of each stretch."""
    chars, row, place = code_points(stretches)
    return np.bincount(row, chars * (place + 1.0), len(stretches)).astype(np.uint64)


def key_of(key: np.uint64, stretch: str) -> int:
    return (int(key) + int(content([stretch])[0])) & MASK


@dataclass
class Vocabulary:
    """Pieces and merge scores of a model; small and of fixed size, so it can be broadcast."""

    ids: dict[str, int]
    scores: list[float]
    byte_ids: list[int]
    surface: list[bytes]
    stretch: re.Pattern = field(default=None)

    def __post_init__(self) -> None:
        """Tables for merging many stretches at once: symbols are pieces, or characters that only pieces hold."""
        symbols = dict(self.ids)
        for p in list(self.ids):
            for c in p:
                symbols.setdefault(c, len(self.scores) + len(symbols))
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = i
        # What two symbols merge to, in a sparse table: a pair stands at its hash or up to ``reach`` places on.
        self.bits = max(16, 4 + len(pairs).bit_length())
        self.table, self.merged = np.full((1 << self.bits) + 64, -1, np.int64), np.full((1 << self.bits) + 64, -1, np.int32)
        keys = np.array(list(pairs), np.int64)
        self.reach = 0
        for at, key, made in zip(self.place(keys).tolist(), pairs, pairs.values(), strict=True):
            k = at
            while self.table[k] >= 0:
                k += 1
            self.table[k], self.merged[k], self.reach = key, made, max(self.reach, k - at)
        # The rank of each piece, the best score first; the last one stands for no candidate.
        self.cost = np.append(np.unique(-np.array(self.scores, float), return_inverse=True)[1], NONE).astype(np.int32)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.symbol_of[ord(" ")], self.symbol_of[ord(MARK)] = self.symbol_of[ord(MARK)], -1

    def place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(AT)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pieces_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pieces that pairs of symbols merge to, -1 for none."""
        key = (a.astype(np.int64) << 32) | b
        at = self.place(key)
        made = np.where(self.table[at] == key, self.merged[at], np.int32(-1))
        for k in range(1, self.reach + 1):
            rest = np.flatnonzero((made < 0) & (self.table[at + k - 1] >= 0))
            hit = rest[self.table[at[rest] + k] == key[rest]]
            made[hit] = self.merged[at[hit] + k]
        made[(a < 0) | (b < 0)] = -1
        return made

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        surface = [p.replace(MARK, " ").encode() if ok else b"" for p, ok in zip(pieces, plain, strict=True)]
        for b, i in enumerate(byte_ids):
            surface[i] = bytes([b])
        ids = {p: i for i, (p, ok) in enumerate(zip(pieces, plain, strict=True)) if ok}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("a piece spans a space, so texts can't be encoded stretch by stretch")
        # No piece goes on past a space or, unless the vocabulary holds one, a line end.
        lines = not any("\n" in p for p in ids)
        return cls(ids, [model.get_score(i) for i in range(n)], byte_ids, surface, re.compile(" *[^ \n]+| +|\n" if lines else " *[^ ]+| +"))

    def segment(self, stretch: str, dropout: float, key: int) -> list[int]:
        """Merge the characters of a stretch, best score first, then leftmost; keyed hashes skip candidates.

        A candidate is skipped where the hash of (key, position, piece) is under
        ``dropout``; it comes back only if a neighbour's merge proposes it anew.
        """
        # A mark that is text, not a space, takes no part in merges and is spelled in bytes.
        symbols: list[str | None] = [MARK if c == " " else c for c in stretch]
        literal = [c == MARK for c in stretch]
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, str, str]] = []
        ids, scores = self.ids, self.scores

        def propose(i: int) -> None:
            j = after[i]
            if j >= 0 and not literal[i] and not literal[j]:
                piece = ids.get(symbols[i] + symbols[j])
                if piece is not None:
                    heapq.heappush(agenda, (-scores[piece], i, symbols[i], symbols[j], piece))

        for i in range(n - 1):
            propose(i)
        limit = int(dropout * 2**32)
        while agenda:
            _, i, a, b, piece = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            if limit:
                x = (key + i * AT + piece * PIECE) & MASK
                x = ((x ^ (x >> 32)) * PIECE) & MASK
                x = ((x ^ (x >> 32)) * PIECE) & MASK
                if x >> 32 < limit:
                    continue
            symbols[i], symbols[j] = a + b, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                propose(before[i])
            propose(i)
        out: list[int] = []
        for s, raw in zip(symbols, literal, strict=True):
            if s is not None:
                piece = None if raw else ids.get(s)
                if piece is None:
                    out += [self.byte_ids[b] for b in s.encode("utf-8", "surrogatepass")]
                else:
                    out.append(piece)
        return out

    def segment_all(self, stretches: list[str], keys: np.ndarray | None, limit: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The runs of many short stretches in step: each step merges the best candidate of every stretch that has one.

        With ``keys`` (one a stretch) candidates whose draw is under ``limit`` are no candidates, as in ``segment``.
        Returns the ids, how many merges each run made, and those merges as ``draws``, run by run.
        """
        chars, row, place = code_points(stretches)
        size = np.bincount(row)
        n, width = len(stretches), int(size.max()) + 1
        symbol = np.full((n, width), -1, np.int32)
        symbol[row, place] = self.symbol_of[chars]
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        after[np.arange(n), size - 1] = width - 1  # the last column is an end with symbol -1
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (n, 1))
        piece = np.full((n, width), -1, np.int32)
        cost = np.full((n, width), NONE, np.int32)
        alive = np.zeros((n, width), bool)
        alive[row, place] = True
        steps: list[tuple[np.ndarray, np.ndarray]] = []

        def propose(r: np.ndarray, i: np.ndarray) -> None:
            made = self.pieces_of(symbol[r, i], symbol[r, after[r, i]])
            if keys is not None:
                some = np.flatnonzero(made >= 0)
                made[some[skips(keys[r[some]] + draws(i[some], made[some]), limit)]] = -1
            piece[r, i], cost[r, i] = made, self.cost[made]

        propose(row, place)
        live = np.arange(n)
        while len(live):
            i = cost[live].argmin(axis=1)
            some = cost[live, i] < NONE
            live, i = live[some], i[some]
            j = after[live, i]
            steps.append((live, draws(i, piece[live, i])))
            symbol[live, i] = piece[live, i]
            alive[live, j], cost[live, j] = False, NONE
            k = after[live, j]
            after[live, i] = k
            before[live, k] = i
            propose(live, i)
            h = before[live, i]
            left = h >= 0
            propose(live[left], h[left])
        flat = symbol[alive].astype(np.int32)
        ends = np.cumsum(alive.sum(axis=1))
        known = np.ones(n, bool)
        np.logical_and.at(known, np.nonzero(alive)[0], (flat >= 0) & (flat < len(self.scores)))
        raw, out = flat.tobytes(), []
        for w, (e, c, fine) in enumerate(zip((ends * 4).tolist(), (alive.sum(axis=1) * 4).tolist(), known.tolist(), strict=True)):
            out.append(raw[e - c : e] if fine else self.spelled(stretches[w], alive[w], symbol[w]))
        of, made = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.uint64)), *steps, strict=True))
        return out, np.bincount(of, minlength=n), made[np.argsort(of, kind="stable")]

    def spelled(self, stretch: str, alive: np.ndarray, symbol: np.ndarray) -> bytes:
        """The ids of a stretch some of whose characters are no pieces."""
        out: list[int] = []
        for i in np.flatnonzero(alive):
            s = int(symbol[i])
            out += [s] if 0 <= s < len(self.scores) else [self.byte_ids[b] for b in stretch[i].encode("utf-8", "surrogatepass")]
        return np.array(out, np.int32).tobytes()

    def decode(self, ids: Iterator[int]) -> str:
        surface = self.surface
        return b"".join([surface[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


class Encoder:
    """Encodes whole texts; every occurrence of a stretch has skips of its own.

    An occurrence that skips none of the merges of its stretch's plain run comes out
    as that run does, and runs are kept; the others are merged each by itself.
    """

    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int):
        self.vocabulary, self.limit, self.dropout, self.seed = vocabulary, int(dropout * 2**32), dropout, seed
        self.clear()

    def clear(self) -> None:
        self.roots: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.chars = 0
        self.content = np.zeros(0, np.uint64)
        self.start = np.zeros(1, np.int64)
        self.made = np.zeros(0, np.uint64)

    def merged(self, stretches: list[str], keys: np.ndarray | None) -> Iterator[tuple[list[int], list[bytes], np.ndarray, np.ndarray]]:
        """``segment_all`` of stretches of like length at a time, with their places."""
        order = sorted(range(len(stretches)), key=lambda k: len(stretches[k]))
        for a in range(0, len(order), STEP):
            part = order[a : a + STEP]
            yield part, *self.vocabulary.segment_all([stretches[k] for k in part], None if keys is None else keys[part], self.limit)

    def keep(self, stretches: list[str]) -> None:
        """Make the plain runs of new stretches."""
        for part, ids, count, made in self.merged(stretches, None):
            some = [stretches[k] for k in part]
            self.roots.update(zip(some, range(len(self.ids), len(self.ids) + len(some)), strict=True))
            self.ids += ids
            self.chars += sum(map(len, some))
            self.content = np.append(self.content, content(some))
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(count)])
            self.made = np.concatenate([self.made, made])

    def keys(self, doc: int, n: int) -> np.ndarray:
        """A key for each stretch of a document, by the seed, the document and the place of the stretch."""
        base = mix(mix(np.array([self.seed & MASK], np.uint64)) + np.uint64((doc * AT) & MASK))
        return mix(base + np.arange(n, dtype=np.uint64))

    def skipping(self, run: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which occurrences skip a merge of their plain run."""
        n = self.start[run + 1] - self.start[run]
        ends = np.cumsum(n)
        if not self.limit or not len(run) or not ends[-1]:
            return np.zeros(0, np.int64)
        k = np.arange(ends[-1]) + np.repeat(self.start[run] - ends + n, n)
        hit = np.flatnonzero(skips(np.repeat(keys, n) + self.made[k], self.limit))
        return np.unique(np.searchsorted(ends, hit, side="right"))

    def encode_all(self, texts: list[str], docs: list[int]) -> list[np.ndarray]:
        """The ids of each text. Runs that are not kept yet are made for all texts together."""
        if self.chars > KEPT:
            self.clear()
        split = [self.vocabulary.stretch.findall(" " + text) if text else [] for text in texts]
        stretches = [s for x in split for s in x]
        keys = np.concatenate([np.zeros(0, np.uint64), *[self.keys(doc, len(x)) for x, doc in zip(split, docs, strict=True)]])
        run = np.fromiter(map(self.roots.get, stretches, repeat(-1)), np.int64, len(stretches))
        new = np.flatnonzero(run < 0).tolist()
        self.keep([s for s in dict.fromkeys(stretches[k] for k in new) if len(s) <= KEPT_CHARS])
        run[new] = [self.roots.get(stretches[k], -1) for k in new]
        ids = [self.ids[r] if r >= 0 else b"" for r in run.tolist()]
        short = np.flatnonzero(run >= 0)
        keys[short] += self.content[run[short]]
        drawn = short[self.skipping(run[short], keys[short])]
        for part, made, _, _ in self.merged([stretches[k] for k in drawn.tolist()], keys[drawn]):
            for k, x in zip(drawn[part].tolist(), made, strict=True):
                ids[k] = x
        for k in np.flatnonzero(run < 0).tolist():
            ids[k] = np.array(self.vocabulary.segment(stretches[k], self.dropout, key_of(keys[k], stretches[k])), np.int32).tobytes()
        ends = np.cumsum([len(x) for x in split]).tolist()
        return [np.frombuffer(b"".join(ids[e - len(x) : e]), np.int32) for x, e in zip(split, ends, strict=True)]

    def encode(self, text: str, doc: int) -> np.ndarray:
        return self.encode_all([text], [doc])[0]


def encode_documents(docs: DataFrame, model_file: str | None = None, dropout: float = 0.1, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, n_tokens, lossless) of every whole text, one row per row of ``docs``.

    Segmentation is by merges of the model's pieces; each candidate merge is
    skipped with probability ``dropout`` by a hash of the seed, the document, the
    place of the stretch (a word with the spaces before it) in it, the stretch, the
    position and the piece. So every occurrence has draws of its own, and results
    are the same on every run. With
    ``dropout`` 0 the pieces are the model's own. Characters outside the
    vocabulary, and the mark U+2581 itself, are spelled in bytes, so decoding
    gives back every text exactly; ``lossless`` says that it did.

    Null text stays null (n_tokens 0, lossless true), empty text has no pieces. A
    null id encodes as id 0. The vocabulary is broadcast; rows stay where they are
    read, so there is no shuffle, and a long text is one row as in the input.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary.load(model_file or default_model()))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary.value, dropout, seed)
        for part in parts:
            texts, docs = part["text"].tolist(), part["known"].tolist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < TOGETHER):
                    size += len(texts[end] or "")
                    end += 1
                some = texts[at:end]
                ids = [None if x is None else i for x, i in zip(some, encoder.encode_all([x or "" for x in some], [int(x) for x in docs[at:end]]), strict=True)]
                fine = [x is None or encoder.vocabulary.decode(i.tolist()) == x for x, i in zip(some, ids, strict=True)]
                yield pd.DataFrame({"id": part["id"].iloc[at:end].array, "ids": ids, "n_tokens": [0 if x is None else len(x) for x in ids], "lossless": fine})
                at = end

    i = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(i.cast("string").alias("id"), F.coalesce(i, F.lit(0)).alias("known"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInPandas(run, "id string, ids array<int>, n_tokens long, lossless boolean")
    return out.select(F.col("id").cast("long").alias(id_col), "ids", "n_tokens", "lossless")


def decode_documents(encoded: DataFrame, model_file: str | None = None, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """All columns of ``encoded`` and the decoded text (null for null ids)."""
    spark: SparkSession = encoded.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary.load(model_file or default_model()))

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else vocabulary.value.decode(x.tolist()))

    return encoded.withColumn(text_col, decoded(F.col(f"`{ids_col}`")))
