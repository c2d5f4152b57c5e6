"""Exact order statistics and quantiles over any number of rows.

The built-in exact ``percentile`` keeps every distinct value in one buffer, so it is used only when
the column is known to be short. Beyond that the target rank is bracketed by a sketch, the rows in and
around the bracket are counted, and the bracket is narrowed again; each round shrinks it by about
``SKETCH_ACCURACY / 4``. All columns and ranks share the scans, and every round is a map-side
aggregation with a constant-size result, so no shuffle carries rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SMALL = 200_000          # values that may be held in one aggregation buffer
FETCH = 5_000            # values that all searches together may read to the driver
SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """Rank ``k`` (0-based) lies in the open interval (low, high), holding ``inside`` values."""

    column: str
    k: int
    inside: int
    below: int = 0
    low: float | int | None = None
    high: float | int | None = None
    value: float | int | None = None
    halve: bool = False      # the sketch made no progress: integers too large for its doubles

    def interval(self) -> Column:
        c = F.col(self.column)
        test = c.isNotNull()
        if self.low is not None:
            test = test & (c > F.lit(self.low))
        if self.high is not None:
            test = test & (c < F.lit(self.high))
        return test


def _aggregate(df: DataFrame, columns: list[Column]):
    return df.agg(*[c.alias(f"a{i}") for i, c in enumerate(columns)]).first() if columns else []


def _narrow(df: DataFrame, searches: list[_Search], accuracy: int) -> None:
    """Two scans: bracket each rank by a sketch, then count around the bracket ends."""
    brackets = []
    for s in searches:
        slack = 2.0 / accuracy
        at = (s.k - s.below) / s.inside
        value = F.when(s.interval(), F.col(s.column))
        brackets.append(F.array(F.min(value), F.max(value)) if s.halve else
                        F.percentile_approx(value, [max(at - slack, 0.0), min(at + slack, 1.0)], accuracy))
    ends = [[(pair[0] + pair[1]) // 2] * 2 if s.halve else list(pair)
            for s, pair in zip(searches, _aggregate(df, brackets))]

    counts = []
    for s, (a, b) in zip(searches, ends):
        c, inside = F.col(s.column), s.interval()
        counts += [F.count_if(inside & test) for test in
                   (c < F.lit(a), c == F.lit(a), c < F.lit(b), c == F.lit(b))]
    counted = list(_aggregate(df, counts))

    for i, (s, (a, b)) in enumerate(zip(searches, ends)):
        lt_a, eq_a, lt_b, eq_b = counted[4 * i:4 * i + 4]
        j, before = s.k - s.below, s.inside
        if j < lt_a:
            s.high, s.inside = a, lt_a
        elif j < lt_a + eq_a:
            s.value = a
        elif j < lt_b:
            s.below, s.low, s.high, s.inside = s.below + lt_a + eq_a, a, b, lt_b - lt_a - eq_a
        elif j < lt_b + eq_b:
            s.value = b
        else:
            s.below, s.low, s.inside = s.below + lt_b + eq_b, b, s.inside - lt_b - eq_b
        s.halve = s.inside == before


def _fetch(df: DataFrame, searches: list[_Search]) -> None:
    """Read the few remaining values of each interval, pre-counted by value."""
    tagged = [F.when(s.interval(), F.struct(F.lit(i).alias("i"), F.col(s.column).cast("string").alias("raw")))
              for i, s in enumerate(searches)]
    rows = (df.select(F.explode(F.filter(F.array(*tagged), lambda x: x.isNotNull())).alias("t"))
            .groupBy("t.i", "t.raw").agg(F.count("*").alias("n")).collect())
    values: dict[int, list] = {}
    for row in rows:
        values.setdefault(row["i"], []).append((row["raw"], row["n"]))
    for i, s in enumerate(searches):
        j, number = s.k - s.below, _python_type(df, s.column)
        for raw, n in sorted(values[i], key=lambda t: number(t[0])):
            if j < n:
                s.value = number(raw)
                break
            j -= n


def _python_type(df: DataFrame, column: str):
    return int if df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long") else float


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], small: int = SMALL,
                     accuracy: int = SKETCH_ACCURACY,
                     counts: dict[str, int] | None = None) -> dict[str, dict[int, float | int]]:
    """The values at 0-based ``ranks`` of each numeric column, NULLs left out."""
    df = df.select(*ranks)
    if counts is None:
        counted = _aggregate(df, [F.count(c) for c in ranks])
        counts = dict(zip(ranks, counted))
    searches = [_Search(c, k, counts[c]) for c, ks in ranks.items() for k in ks if 0 <= k < counts[c]]
    pending = searches
    while pending:
        limit = min(small, FETCH // len(pending))
        near = [s for s in pending if s.inside <= limit]
        if near:
            _fetch(df, near)
        far = [s for s in pending if s.inside > limit]
        if far:
            _narrow(df, far, accuracy)
        pending = [s for s in far if s.value is None]
    found: dict[str, dict[int, float | int]] = {c: {} for c in ranks}
    for s in searches:
        found[s.column][s.k] = s.value
    return found


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float], exact: bool = True,
              small: int = SMALL, accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbouring ranks; NULLs left out.

    ``exact=False`` answers from one sketch pass.
    """
    if not columns:
        return {}
    if not exact:
        got = _aggregate(df, [F.percentile_approx(c, probabilities, accuracy) for c in columns])
        return {c: list(v) if v is not None else [None] * len(probabilities) for c, v in zip(columns, got)}
    counts = dict(zip(columns, _aggregate(df, [F.count(c) for c in columns])))
    if max(counts.values()) <= small:
        got = _aggregate(df, [F.percentile(c, F.array(*[F.lit(p) for p in probabilities])) for c in columns])
        return {c: list(v) if v is not None else [None] * len(probabilities) for c, v in zip(columns, got)}
    ranks = {c: sorted({k for p in probabilities for k in _neighbours(counts[c], p)}) for c in columns}
    found = order_statistics(df, ranks, small, accuracy, counts)
    return {c: [_interpolate(found[c], counts[c], p) for p in probabilities] for c in columns}


def _neighbours(n: int, p: float) -> tuple[int, int]:
    at = (n - 1) * p
    return math.floor(at), math.ceil(at)


def _interpolate(found: dict[int, float | int], n: int, p: float) -> float | None:
    if n == 0:
        return None
    low, high = _neighbours(n, p)
    weight = (n - 1) * p - low
    return float(found[low] * (1 - weight) + found[high] * weight) if high > low else float(found[low])
