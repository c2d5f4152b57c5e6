"""What all folds but one teach about the columns, for every fold in the passes of one fit.

Counts, means, squares, extremes and value counts are kept per fold; what the rows outside fold m teach is the sum over the other folds.
Medians are searched for all models together: a pass counts values by (fold, bin) between the points of a sketch, and only the bins that hold
a wanted rank are looked into again. The numbers that reach the driver are bounded by folds, columns and bins; vocabularies by ``max_labels``,
longer ones stay in a code table.

Rows whose fold is missing or outside 0 to k-1 belong to every model. A NaN teaches nothing, as a missing value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.operators.orderstats import FETCH, SKETCH_ACCURACY, _neighbours
from ledgerlark.operators.preprocess import MAX_LABELS, Fitted, code_table
from ledgerlark.session import materialise

GRID = 64                 # points of a sketch between which values are counted
FOLD = "__fold"


def _taught(by_fold: np.ndarray) -> np.ndarray:
    """Sums over (folds + rows of no fold, ...) as sums over the rows of each model, the model of all rows last."""
    whole = by_fold.sum(axis=0)
    return np.concatenate([whole - by_fold[:-1], whole[None]])


def _folded(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fold: str, k: int) -> DataFrame:
    number = F.col(fold).cast("int")
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in numeric]
    return df.select(F.when(number.between(0, k - 1), number).otherwise(k).alias(FOLD), *values, *[F.col(f"`{c}`") for c in categorical])


# --- numbers --------------------------------------------------------------------------------

def fold_moments(rows: DataFrame, columns: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by fold, and (fold, column, [count, mean, sum of squares about it, min, max])."""
    aggregates = [a for c in columns for a in (F.count(f"`{c}`"), F.avg(f"`{c}`"), F.var_pop(f"`{c}`"), F.min(f"`{c}`"), F.max(f"`{c}`"))]
    found = rows.groupBy(FOLD).agg(F.count("*").alias("n"), *[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).collect()
    sizes, moments = np.zeros(k + 1, dtype=np.int64), np.zeros((k + 1, len(columns), 5))
    for row in found:                                   # one row per fold
        sizes[row[FOLD]] = row["n"]
        moments[row[FOLD]] = np.array([0.0 if v is None else v for v in row[2:]], dtype=np.float64).reshape(-1, 5)
    moments[:, :, 2] *= moments[:, :, 0]
    return sizes, moments


def scaling(parts: np.ndarray, missing: int, median: float) -> tuple[float, float]:
    """Mean and population deviation of groups (count, mean, squares, min, max) and of ``missing`` values put at the median."""
    parts = np.vstack([parts, [missing, median, 0.0, median, median]])
    parts = parts[parts[:, 0] > 0]
    if not len(parts):
        return 0.0, 1.0
    n, means = parts[:, 0], parts[:, 1]
    if parts[:, 3].min() == parts[:, 4].max():
        return float(parts[0, 3]), 1.0
    mean = means[0] + (n * (means - means[0])).sum() / n.sum()
    squares = (parts[:, 2] + n * (means - mean) ** 2).sum()
    return float(mean), float(np.sqrt(squares / n.sum())) or 1.0


@dataclass
class _Open:
    """The open interval (low, high) of a column, and the ranks looked for in it."""

    column: str
    low: float | None
    high: float | None
    below: np.ndarray            # values up to ``low`` by fold
    inside: np.ndarray           # values in the interval by fold
    wanted: list[tuple[int, int]]       # (model, rank)

    def test(self) -> Column:
        c = F.col(f"`{self.column}`")
        out = c.isNotNull()
        if self.low is not None:
            out = out & (c > F.lit(self.low))
        return out & (c < F.lit(self.high)) if self.high is not None else out


def _sketched(rows: DataFrame, intervals: list[_Open]) -> list[np.ndarray]:
    shares = [(n + 0.5) / GRID for n in range(GRID)]
    found = rows.agg(*[F.percentile_approx(F.when(i.test(), F.col(f"`{i.column}`")), shares, SKETCH_ACCURACY).alias(f"a{n}")
                       for n, i in enumerate(intervals)]).first()
    return [np.unique(np.array(edges, dtype=np.float64)) for edges in found]


def _counted(rows: DataFrame, intervals: list[_Open], edges: list[np.ndarray], k: int) -> list[np.ndarray]:
    """(fold, bin) counts of each interval: bin 2i+1 is the value edges[i], bin 2i what lies before it."""
    asked = [(i.column, -np.inf if i.low is None else i.low, np.inf if i.high is None else i.high, i.low is None, i.high is None)
             for i in intervals]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k + 1) * (2 * len(e) + 1), dtype=np.int64) for e in edges]
        for batch in batches:
            folds = batch.column(FOLD).to_numpy(zero_copy_only=False).astype(np.int64)
            for n, (column, low, high, from_start, to_end) in enumerate(asked):
                values = batch.column(column).to_numpy(zero_copy_only=False).astype(np.float64)
                own = ~np.isnan(values) & ((values > low) | from_start) & ((values < high) | to_end)
                at = np.searchsorted(edges[n], values[own], "left") + np.searchsorted(edges[n], values[own], "right")
                sums[n] += np.bincount(folds[own] * (2 * len(edges[n]) + 1) + at, minlength=len(sums[n]))
        for n, counts in enumerate(sums):
            filled = np.flatnonzero(counts)
            if len(filled):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(filled), n), pa.int32()), pa.array(filled, pa.int32()),
                                                  pa.array(counts[filled], pa.int64())], names=["i", "place", "n"])

    out = [np.zeros((k + 1) * (2 * len(e) + 1), dtype=np.int64) for e in edges]
    for r in rows.mapInArrow(work, "i int, place int, n long").groupBy("i", "place").agg(F.sum("n").alias("n")).collect():
        out[r["i"]][r["place"]] = r["n"]                # a row per (interval, fold, bin)
    return [o.reshape(k + 1, -1) for o in out]


def _fetched(rows: DataFrame, intervals: list[_Open], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The values of short intervals in order, and their counts (fold, value)."""
    tagged = F.array(*[F.when(i.test(), F.struct(F.lit(n).alias("i"), F.col(f"`{i.column}`").alias("v"))) for n, i in enumerate(intervals)])
    found = (rows.select(FOLD, F.explode(F.filter(tagged, lambda t: t.isNotNull())).alias("t"))
             .groupBy(F.col("t.i").alias("i"), F.col("t.v").alias("v"), FOLD).count().collect())
    out = []
    for n in range(len(intervals)):
        own = [(r["v"], r[FOLD], r["count"]) for r in found if r["i"] == n]
        values = np.unique(np.array([v for v, _, _ in own], dtype=np.float64))
        counts = np.zeros((k + 1, len(values)), dtype=np.int64)
        for v, fold, c in own:
            counts[fold, np.searchsorted(values, v)] += c
        out.append((values, counts))
    return out


def fold_ranks(rows: DataFrame, counts: dict[str, np.ndarray], wanted: dict[str, list[tuple[int, int]]], k: int,
               fetch: int = FETCH) -> dict[str, dict[tuple[int, int], float]]:
    """The value at each (model, 0-based rank) of each column; ``counts`` are the columns' values by fold."""
    nothing = np.zeros(k + 1, dtype=np.int64)
    found: dict[str, dict[tuple[int, int], float]] = {c: {} for c in wanted}
    pending = [_Open(c, None, None, nothing, counts[c], ranks) for c, ranks in wanted.items() if ranks]
    while pending:
        limit = fetch // len(pending)
        near = [i for i in pending if i.inside.sum() <= limit]
        far = [i for i in pending if i.inside.sum() > limit]
        pending = []
        for i, (values, by_fold) in zip(near, _fetched(rows, near, k) if near else []):
            upto = _taught(i.below)[:, None] + np.cumsum(_taught(by_fold), axis=1)
            for model, rank in i.wanted:
                found[i.column][model, rank] = float(values[np.searchsorted(upto[model], rank, "right")])
        edges = _sketched(rows, far) if far else []
        for i, edge, by_fold in zip(far, edges, _counted(rows, far, edges, k) if far else []):
            upto = _taught(i.below)[:, None] + np.cumsum(_taught(by_fold), axis=1)
            opened: dict[int, list[tuple[int, int]]] = {}
            for model, rank in i.wanted:
                bin_ = int(np.searchsorted(upto[model], rank, "right"))
                if bin_ % 2:
                    found[i.column][model, rank] = float(edge[bin_ // 2])
                else:
                    opened.setdefault(bin_, []).append((model, rank))
            for bin_, ranks in opened.items():
                low = float(edge[bin_ // 2 - 1]) if bin_ else i.low
                high = float(edge[bin_ // 2]) if bin_ // 2 < len(edge) else i.high
                pending.append(_Open(i.column, low, high, i.below + by_fold[:, :bin_].sum(axis=1), by_fold[:, bin_], ranks))
    return found


def fold_medians(rows: DataFrame, columns: Sequence[str], counts: dict[str, np.ndarray], k: int, fetch: int = FETCH) -> list[dict[str, float]]:
    """The medians of each model, 0 for a column without values."""
    sizes = {c: _taught(counts[c]) for c in columns}
    wanted = {c: sorted({(m, r) for m, n in enumerate(sizes[c].tolist()) if n for r in _neighbours(n, 0.5)}) for c in columns}
    found = fold_ranks(rows, counts, wanted, k, fetch)

    def median(c: str, m: int) -> float:
        if not sizes[c][m]:
            return 0.0
        low, high = (found[c][m, r] for r in _neighbours(int(sizes[c][m]), 0.5))
        return low if low == high else low * 0.5 + high * 0.5

    return [{c: median(c, m) for c in columns} for m in range(k + 1)]


# --- categories -----------------------------------------------------------------------------

def fold_value_counts(rows: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """(column, value, taught): how often each model's rows hold the value, in one shuffle of combined counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    counts = (rows.select(FOLD, F.explode(pairs).alias("p")).select(FOLD, "p.*").filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count("*").alias("n"), F.array(*[F.count_if(F.col(FOLD) == m) for m in range(k)]).alias("own")))
    return counts.select("column", "value", F.concat(F.transform("own", lambda n: F.col("n") - n), F.array("n")).alias("taught"))


def _fit_categories(rows: DataFrame, fits: list[Fitted], columns: list[str], k: int, max_labels: int) -> None:
    counts = materialise(fold_value_counts(rows, columns, k), "fold-counts")
    aggregates = []
    for m in range(k + 1):
        n = F.col("taught")[m]
        aggregates += [F.min_by(F.when(n > 0, F.col("value")), F.when(n > 0, F.struct(-n, F.col("value")))).alias(f"mode{m}")]
    found = {r["column"]: r for r in counts.groupBy("column").agg(F.count("*").alias("size"), *aggregates).collect()}
    kept = [c for c in columns if c not in found or found[c]["size"] <= max_labels]
    words: dict[str, list[tuple[str, list[int]]]] = {c: [] for c in kept}
    for r in counts.filter(F.col("column").isin(kept)).select("column", "value", "taught").collect() if kept else []:
        words[r["column"]].append((r["value"], r["taught"]))
    for c in kept:
        words[c].sort(key=lambda w: w[0].encode())
    joined = [c for c in columns if c not in kept]
    codes = None
    if joined:
        models = F.filter(F.sequence(F.lit(0), F.lit(k)), lambda m: F.get("taught", m) > 0)
        each = counts.filter(F.col("column").isin(joined)).select("column", "value", F.explode(models).alias("model"))
        codes = materialise(code_table(each.select(F.concat_ws("/", "model", "column").alias("column"), "value")), "codes")
    for m, fitted in enumerate(fits):
        fitted.modes = {c: (found[c][f"mode{m}"] or "") if c in found else "" for c in columns}
        fitted.labels = {c: [v for v, taught in words[c] if taught[m]] or [""] for c in kept}
        if joined:
            names = F.col("column").isin([f"{m}/{c}" for c in joined])
            fitted.code_table = codes.filter(names).withColumn("column", F.expr(f"substring(column, {len(str(m)) + 2})"))


def fit_folds(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fold: str, k: int, scale: bool = True,
              max_labels: int = MAX_LABELS, fetch: int = FETCH) -> list[Fitted]:
    """``preprocess.fit`` of the rows outside each fold, and of all rows last."""
    numeric, categorical = list(numeric), list(categorical)
    rows = _folded(df, numeric, categorical, fold, k)
    fits = [Fitted(numeric, categorical) for _ in range(k + 1)]
    if numeric and scale:
        sizes, moments = fold_moments(rows, numeric, k)
        counts = {c: moments[:, i, 0].astype(np.int64) for i, c in enumerate(numeric)}
        total = _taught(sizes)
        for m, (fitted, medians) in enumerate(zip(fits, fold_medians(rows, numeric, counts, k, fetch))):
            fitted.medians = medians
            inside = [f for f in range(k + 1) if f != m or m == k]
            scales = {c: scaling(moments[inside, i], int(total[m] - _taught(counts[c])[m]), medians[c]) for i, c in enumerate(numeric)}
            fitted.means, fitted.deviations = {c: s[0] for c, s in scales.items()}, {c: s[1] for c, s in scales.items()}
    if categorical:
        _fit_categories(rows, fits, categorical, k, max_labels)
    return fits
