"""Quality rules that vote or abstain, joined by a label model; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, WS, WS_RUN, barrier, packed, staged, unpacked
from .label_model import fit, pattern_counts

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the corpus languages; fixed values.
STOPWORDS = ("the of and to in is that it for on with as was be by this are from or have der die und das den von zu mit ist ein eine sich nicht auf dem de la le les des et en un une est que dans pour qui du el los las y por con para una no se").split()
COMMON_FORMS = sorted({form for w in STOPWORDS for form in (w, w.capitalize())})


@dataclass(frozen=True)
class Rule:
    """A rule votes +1 below ``good`` (above, if good > bad), -1 beyond ``bad``, else abstains, as it does on texts of fewer than ``least_words``."""

    name: str
    measure: Column
    good: float
    bad: float
    least_words: int = 20

    def vote(self) -> Column:
        low = self.good <= self.bad
        plus = self.measure <= self.good if low else self.measure >= self.good
        minus = self.measure >= self.bad if low else self.measure <= self.bad
        return F.when(F.col("n_words") < self.least_words, 0).when(plus, 1).when(minus, -1).otherwise(0)


def ratio(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))


def default_rules() -> list[Rule]:
    """Thresholds are those of common web-text filters; the gaps between them are abstentions."""
    return [
        Rule("length", F.col("n_words"), 80, 49, least_words=0),
        Rule("symbols", ratio("n_symbols", "n_words"), 0.05, 0.1),
        Rule("repeats", ratio("n_repeat_words", "n_words"), 0.3, 0.5),
        Rule("lines", ratio("n_dup_lines", "n_text_lines"), 0.3, 0.6),
        Rule("stopwords", ratio("n_stopwords", "n_words"), 0.12, 0.04),
        Rule("word_length", F.abs(ratio("word_chars", "n_words") - 6.0), 2.5, 4.5),
        Rule("capitals", ratio("n_capitals", "word_chars"), 0.1, 0.3),
    ]


def measures(df: DataFrame, text: str = "__text") -> DataFrame:
    """Add the counts that the rules read, all as long, computed on whole texts."""
    words = F.filter(F.split(text, WS_RUN, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")
    df = barrier(df, __words=words, __lines=lines)
    n = F.size("__words")
    df = barrier(df, __hashes=F.transform("__words", lambda w: F.xxhash64(w)))
    m = F.greatest(n - 2, F.lit(0))
    pairs = F.zip_with(F.slice("__hashes", 1, m), F.slice("__hashes", 2, m), lambda a, b: F.xxhash64(a, b))
    df = barrier(df, __grams=F.zip_with(pairs, F.slice("__hashes", 3, m), lambda ab, c: F.xxhash64(ab, c))).drop("__hashes")
    # Only texts with a repeated window are sorted. Neighbours with equal hashes are repeats.
    repeats = F.size(F.array_distinct("__grams")) < F.size("__grams")
    df = barrier(df, __grams=F.when(repeats, F.sort_array(F.transform("__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop(df["__grams"])
    g = F.col("__grams")
    k = F.size(g) - 1
    twins = F.filter(F.zip_with(F.slice(g, 1, k), F.slice(g, 2, k), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"]))), lambda t: t.isNotNull())
    df = barrier(df, __starts=F.when(g.isNotNull(), F.sort_array(F.array_distinct(F.flatten(twins))))).drop("__grams")
    s = F.col("__starts")
    steps = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.when(s.isNull(), 0).otherwise(3 + F.aggregate(steps, F.lit(0), lambda acc, x: acc + x))
    made = {
        "n_words": n,
        "word_chars": F.aggregate("__words", F.lit(0), lambda acc, w: acc + F.char_length(w)),
        "n_symbols": F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, "")),
        "n_text_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered,
        "n_capitals": F.char_length(text) - F.char_length(F.translate(text, UPPER, "")),
        "n_stopwords": F.size(F.filter("__words", lambda w: w.isin(COMMON_FORMS))),
    }
    return barrier(df, **{k: v.cast("long") for k, v in made.items()}).drop("__words", "__lines", "__starts")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, threshold: float = 0.5, drop: tuple[str, ...] = ()) -> DataFrame:
    """Judge every document by the posterior of voting rules.

    Returns all columns of ``docs`` with the counts of ``measures``, ``base_failed``
    (fewer than 50 words, or over half of the words in repeated 3-word windows),
    ``quality`` (posterior probability that the document is good) and ``kept``
    (not base_failed and quality >= threshold). Accuracies are estimated over all
    documents. No row is dropped. The judged table is staged once in the shared
    folder, so texts are measured once; columns not needed should be left out of
    ``docs`` or named in ``drop``.

    Null text has no words and fails the base rules. An empty table gives an
    empty result. Repeated rows are judged alike. Columns of ``docs`` named like
    those added are replaced.
    """
    rules = default_rules() if rules is None else rules
    carried = docs.drop(*drop)
    judged = measures(packed(docs, id_col, text_col)).drop("__text", "__id")
    judged, _ = staged(judged.withColumn("__rec", F.struct(*[F.col("__rec").getField(c).alias(c) for c in carried.columns])), "rules")
    votes = [r.vote() for r in rules]
    model = fit(pattern_counts(judged, votes), len(rules))
    names = ["n_words", "word_chars", "n_symbols", "n_text_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_stopwords"]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    quality = model.posterior(votes)
    made = {n: F.col(n) for n in names} | {"base_failed": failed, "quality": quality, "kept": ~failed & (quality >= threshold)}
    return unpacked(judged, carried, made)
