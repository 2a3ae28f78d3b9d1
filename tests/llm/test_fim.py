"""Cuts against units spelled out one by one, and exact restoring."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quadrille.llm.fim import Runs, fill_in_middle, restored

UNITS = {"lines": r"[^\n]*\n|[^\n]+", "words": r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", "chars": r"(?s)."}
TEXTS = ["", None, "\n", "\n\n\n", "a", "a\n", "\na", "a\n\nb\nc", "one\ntwo <P> three", "<S>", "tail <M", "<", "P>\n<S\n>M", "é\n\U0001f600x\n y\r\nz", "word " * 50_000, "l\n" * 50_000, " x  y\t\n z "]


@pytest.mark.parametrize("unit", UNITS)
def test_every_cut(unit):
    rng = random.Random(5)
    for text in [t or "" for t in TEXTS if len(t or "") < 1000] + ["".join(rng.choices("ab \n\t\U0001f600", k=rng.randint(1, 60))) for _ in range(300)]:
        units, runs = re.findall(UNITS[unit], text), Runs.of(text, unit)
        assert runs.n == len(units)
        assert [runs.end_of(k) for k in range(runs.n + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def brute(i, text, unit, fim, spm):
    text, digest = text or "", hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(UNITS[unit], text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return i, len(units), "plain", None, None, text, text
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return i, len(units), form, len(p), len(m), out, text


@pytest.mark.parametrize(("unit", "fim", "spm"), [("lines", 100, 50), ("words", 60, 30), ("chars", 100, 100), ("lines", 0, 0)])
def test_forms_and_restoring(spark, unit, fim, spm):
    rng = random.Random(fim)
    rows = [(None if k == 4 else k, t) for k, t in enumerate(TEXTS)] + [(3, "again\nand again"), (3, "again\nand again")] + [(100 + k, "".join(rng.choices("abc<PSM> \n", k=200))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("h1", F.lit(0)).withColumn("id", F.lit(0))
    out = fill_in_middle(df, unit=unit, fim_percent=fim, spm_percent=spm).withColumn("back", restored(F.col("output"), F.col("form")))
    assert Counter(tuple(r) for r in out.collect()) == Counter(brute(i, t, unit, fim, spm) for i, t in rows)
    assert fill_in_middle(df.limit(0)).count() == 0
