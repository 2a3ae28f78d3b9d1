"""Fill-in-middle forms of whole texts, cut between units that runs of character classes count."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before the prefix, the suffix and the middle; fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLANKS = np.array([0x20, *range(0x09, 0x0E)], np.uint32)
#: What a run of a class does to units: each of its characters ends one, its last character does, or none.
EACH, LAST, NONE = 0, 1, 2
#: Kinds of units: which characters are of class 1, and what runs of class 0 and of class 1 do.
UNITS = {
    "chars": (lambda c: np.zeros(len(c), bool), (EACH, EACH)),
    "lines": (lambda c: c == 10, (NONE, EACH)),
    "words": (lambda c: ~np.isin(c, BLANKS), (NONE, LAST)),
}
#: Characters of text turned over at a time within a task.
TOGETHER = 1 << 20


@dataclass
class Runs:
    """A text as its maximal runs of one character class, with the units that end up to the end of each."""

    start: np.ndarray
    each: np.ndarray
    units: np.ndarray
    size: int

    @classmethod
    def of(cls, text: str, unit: str) -> Runs:
        """A run ends units as ``UNITS`` says; what is left over at the end of the text is one more."""
        kind, does = UNITS[unit]
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(chars):
            return cls(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), 0)
        of = kind(chars)
        start = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        way = np.array(does)[of[start].astype(np.int64)]
        ended = np.where(way == EACH, np.diff(start, append=len(chars)), np.where(way == LAST, 1, 0))
        ended[-1] = max(ended[-1], 1)
        return cls(start, way == EACH, np.cumsum(ended), len(chars))

    @property
    def n(self) -> int:
        return int(self.units[-1]) if len(self.units) else 0

    def end_of(self, k: int) -> int:
        """The characters before the end of the ``k``-th unit: the run that holds it by binary search, its place in there by counting."""
        if k == 0:
            return 0
        r = int(np.searchsorted(self.units, k))
        if self.each[r]:
            return int(self.start[r]) + k - (int(self.units[r - 1]) if r else 0)
        return int(self.start[r + 1]) if r + 1 < len(self.start) else self.size


def transformed(text: str, h: tuple[int, int, int, int], unit: str, fim_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text under four draws."""
    runs = Runs.of(text, unit)
    n = runs.n
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = runs.end_of(low), runs.end_of(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 7, unit: str = "lines", fim_percent: int = 100, spm_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every whole text, one row per row of ``docs``.

    A text is cut into ``n`` units (``lines`` with their ends, ``words`` with the blanks
    before them, ``chars``) and turned into prefix, suffix and middle at two cuts between
    units. The cuts, whether a text is turned at all (``fim_percent``) and in which order
    (``spm_percent``) are drawn from the SHA-256 of the seed and the id. A text is kept as
    its maximal runs of one character class with cumulative unit counts, so a cut is a
    binary search in the runs and a sum, whatever the number of units.

    Null text counts as empty; empty texts and those that hold a sentinel stay plain, with
    null prefix_chars and middle_chars. A null id draws like an empty one; rows that
    repeat an id have the same draws. Only id and text are read, so other columns can't
    clash. Rows stay where they are read: there is no shuffle, and a long text is one row
    as in the input.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, at = part["text"].tolist(), 0
            draws = part[["h1", "h2", "h3", "h4"]].to_numpy(np.int64).tolist()
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < TOGETHER):
                    size += len(texts[end])
                    end += 1
                made = [transformed(t, tuple(h), unit, fim_percent, spm_percent) for t, h in zip(texts[at:end], draws[at:end], strict=True)]
                n, form, prefix, middle, output = map(list, zip(*made, strict=True))
                yield pd.DataFrame({"id": part["id"].iloc[at:end].array, "n": n, "form": form, "prefix_chars": pd.array(prefix, "Int64"), "middle_chars": pd.array(middle, "Int64"), "output": output})
                at = end

    i = F.col(f"`{id_col}`").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(i.cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    # The id goes through Python as text, since a null among numbers would make them all floating.
    rows = docs.select(i.cast("string").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *draws)
    out = rows.mapInPandas(run, "id string, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that a form was made of; exact, since no turned text holds a sentinel and no sentinel's end is another's start."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(first) + 1, F.lit(2**31 - 1))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.char_length(one) + len(second) + 1, F.lit(2**31 - 1))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.char_length(two) + len(MIDDLE) + 1, F.lit(2**31 - 1))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output)
