"""A label model for rules that vote or abstain, fitted by expectation-maximisation.

The statistics are counts of vote patterns: with k rules there are at most 3^k,
whatever the size of the corpus, so what reaches the driver is bounded.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Starting rates of a +1 among a rule's votes: on good documents, on bad ones of another rule's kind, on those of its own.
GOOD, OTHER, EXPERT = 0.97, 0.85, 0.05


@dataclass(frozen=True)
class LabelModel:
    """shares[0] is P(good), shares[j + 1] that of the bad documents of the kind rule j is there for.

    plus[y][i] is the probability that rule i, where it votes on a document of class
    y, votes +1: the accuracies of the rules. Abstentions carry no evidence.
    """

    shares: list[float]
    plus: list[list[float]]

    def weights(self, votes: tuple[int, ...]) -> list[float]:
        logs = [math.log(p) + sum(math.log(r if v > 0 else 1 - r) for r, v in zip(rates, votes, strict=True) if v) for p, rates in zip(self.shares, self.plus, strict=True)]
        top = max(logs)
        return [math.exp(x - top) for x in logs]

    def quality(self, votes: tuple[int, ...]) -> float:
        """P(good | votes)."""
        w = self.weights(votes)
        return w[0] / sum(w)

    def posterior(self, votes: list[Column]) -> Column:
        """``quality`` of each row, looked up by its pattern."""
        table = [self.quality(p[::-1]) for p in product((-1, 0, 1), repeat=len(votes))]
        return F.element_at(F.from_json(F.lit(json.dumps(table)), "array<double>"), pattern(votes) + 1)


def pattern(votes: list[Column]) -> Column:
    """The number of a combination of votes, digit j to base 3 being that of rule j."""
    return sum(((v + 1) * 3**j for j, v in enumerate(votes)), F.lit(0)).cast("int")


def pattern_counts(df: DataFrame, votes: list[Column]) -> list[tuple[tuple[int, ...], int]]:
    """How many rows show each combination of votes (at most 3^len(votes) of them)."""
    rows = df.select(pattern(votes).alias("__pattern")).groupBy("__pattern").count().collect()
    return sorted((tuple(r["__pattern"] // 3**j % 3 - 1 for j in range(len(votes))), r["count"]) for r in rows)


def fit(patterns: list[tuple[tuple[int, ...], int]], k: int, prior: float = 0.8, rounds: int = 300, smooth: float = 2.0, precise: float = 0.5) -> LabelModel:
    """Expectation-maximisation over counted vote patterns.

    Documents are good, or bad in the way that one of the rules is there to find;
    given that class, the rules that vote do so independently. The classes start from
    GOOD, OTHER and EXPERT, which weigh as ``smooth`` pseudo-documents. A rule votes
    +1 on at least ``precise`` of the good documents and -1 on at least half of those of
    its own kind, so no class can turn against its meaning. Where only one rule objects,
    the counts alone can't tell whether documents are bad or the rule is wrong; a
    ``precise`` near 1 says that the rules are seldom wrong. With no rows the starting
    values come back.
    """
    start = [[GOOD] * k] + [[EXPERT if i == j else OTHER for i in range(k)] for j in range(k)]
    first = [prior] + [(1 - prior) / k] * k
    total = sum(n for _, n in patterns)
    model = LabelModel(first, start)
    for _ in range(rounds if total else 0):
        mass = [0.0] * (k + 1)
        won, cast = ([[0.0] * k for _ in range(k + 1)] for _ in range(2))
        for votes, n in patterns:
            w = model.weights(votes)
            scale = n / sum(w)
            for y, x in enumerate(w):
                mass[y] += x * scale
                for i, v in enumerate(votes):
                    if v:
                        cast[y][i] += x * scale
                        won[y][i] += x * scale * (v > 0)
        shares = [(m + smooth * p) / (total + smooth) for m, p in zip(mass, first, strict=True)]
        plus = [[(won[y][i] + smooth * start[y][i]) / (cast[y][i] + smooth) for i in range(k)] for y in range(k + 1)]
        plus[0] = [max(precise, r) for r in plus[0]]
        for j in range(k):
            plus[j + 1][j] = min(0.5, plus[j + 1][j])
        moved = max(abs(a - b) for a, b in zip(shares, model.shares, strict=True))
        model = LabelModel(shares, plus)
        if moved < 1e-9:
            break
    return model
