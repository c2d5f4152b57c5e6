"""Logistic regressions of all folds and candidates in the passes of one, by Newton steps.

The rows are written once as blocks of plain numbers and category places. A pass makes each fold's features from them (impute, scale, look up
codes) and adds up, for every regression that is still moving, the loss, its gradient and its Hessian, a few hundred numbers each. The sums of a
regression meet in one place and come to the driver, where the next step is found: of the smooth part by second order, with the L1 part kept
whole (proximal Newton, by coordinates). A step that does not lower the objective is halved. A handful of passes serves all
folds and candidates, whatever the number of rows.

The objective is MLlib's: the weighted mean of the log loss and ``strength`` times the elastic net on the features as they are, intercept left
out. Rows without label teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators.preprocess import Fitted
from ledgerlark.session import materialise

CHUNK = 512                # rows of one small matrix product
PRECISION = 1e-10          # of the objective, by which a further step would lower it at most
SHORTEST = 2.0 ** -20      # step


@dataclass(frozen=True)
class Regression:
    """One model: it leaves the rows of ``fold`` out; ``weights`` are by label."""

    fold: int
    weights: dict[int, float]
    strength: float
    l1_ratio: float = 0.0
    max_iter: int = 100


@dataclass(frozen=True)
class Encoder:
    """A fold's features from numbers and category places (-1 for missing) of the vocabulary of all rows."""

    medians: np.ndarray
    means: np.ndarray
    deviations: np.ndarray
    codes: list[np.ndarray]                # by place, the code of a missing category last

    @classmethod
    def of(cls, fitted: Fitted, labels: dict[str, list[str]]) -> Encoder:
        codes = []
        for c in fitted.categorical:
            place = {word: float(n) for n, word in enumerate(fitted.labels[c])}
            codes.append(np.array([place.get(word, -1.0) for word in (*labels[c], fitted.modes[c])]))
        return cls(*(np.array([d[c] for c in fitted.numeric], dtype=np.float64) for d in (fitted.medians, fitted.means, fitted.deviations)), codes)

    def features(self, x: np.ndarray) -> np.ndarray:
        """(rows, features, then 1 for the intercept)."""
        n = len(self.medians)
        numbers = (np.where(np.isnan(x[:, :n]), self.medians, x[:, :n]) - self.means) / self.deviations
        places = x[:, n:].astype(np.int64)
        return np.hstack([numbers, *(code[places[:, [j]]] for j, code in enumerate(self.codes)), np.ones((len(x), 1))])


def blocks(df: DataFrame, row_id: str, columns: Sequence[str], label: str, fold: str) -> DataFrame:
    """(ids, x, label, fold) blocks of the rows; a missing number is NaN."""
    kind, width = df.schema[row_id].dataType.simpleString(), len(columns)
    rows = df.select(F.col(row_id).alias("id"), F.col(label).cast("double").alias("label"), F.col(fold).cast("int").alias("fold"),
                     F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, width)
                plain = [batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (("label", "<f8"), ("fold", "<i4"))]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("id").to_pylist()], pa.list_(batch.schema.field("id").type)),
                                                  *(pa.array([v.tobytes()], pa.binary()) for v in (x, *plain))], names=["ids", "x", "label", "fold"])

    return materialise(rows.mapInArrow(work, f"ids array<{kind}>, x binary, label binary, fold binary"), "blocks")


def _opened(batch: pa.RecordBatch, row: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, label, fold = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in (("x", "<f8"), ("label", "<f8"), ("fold", "<i4")))
    return x.reshape(-1, width), label, fold


def _sums(x: np.ndarray, label: np.ndarray, weights: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """(regressions, [weight, loss, gradient, Hessian]) of rows with features ``x`` by the coefficients (features, regressions).

    Products are of small matrices: they need no threads of their own beside Spark's tasks.
    """
    n, d = x.shape
    short = -n % CHUNK
    x = np.vstack([x, np.zeros((short, d))]).reshape(-1, CHUNK, d)
    label, weights = np.append(label, np.zeros(short)).reshape(-1, CHUNK), np.vstack([weights, np.zeros((short, beta.shape[1]))]).reshape(-1, CHUNK, beta.shape[1])
    margin = x @ beta
    chance = np.exp(-np.logaddexp(0, -margin))
    loss = (weights * (np.logaddexp(0, margin) - label[..., None] * margin)).sum(axis=(0, 1))
    turned = x.transpose(0, 2, 1)
    gradient = (turned @ (weights * (chance - label[..., None]))).sum(axis=0)
    curved = weights * chance * (1 - chance)
    hessian = [(turned @ (x * curved[..., [m]])).sum(axis=0).ravel() for m in range(beta.shape[1])]
    return np.hstack([np.stack([weights.sum(axis=(0, 1)), loss], axis=1), gradient.T, np.array(hessian)])


def _pass(rows: DataFrame, encoders: list[Encoder], asked: list[Regression], trials: dict[int, np.ndarray], width: int) -> dict[int, np.ndarray]:
    """The sums of every regression of ``trials`` at its coefficients there."""
    by_fold: dict[int, list[int]] = {}
    for m in trials:
        by_fold.setdefault(asked[m].fold, []).append(m)
    schema, target = "model int, sums binary", pa.schema([("model", pa.int32()), ("sums", pa.binary())])

    def packed(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], schema=target)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                x, label, fold = _opened(batch, row, width)
                for k, models in by_fold.items():
                    own = np.flatnonzero((fold != k) & ~np.isnan(label))
                    y = label[own]
                    weights = np.ones((len(own), len(models)))
                    for j, m in enumerate(models):
                        for value, weight in asked[m].weights.items():
                            weights[y == value, j] = weight
                    sums = _sums(encoders[k].features(x[own]), y, weights, np.stack([trials[m] for m in models], axis=1))
                    for m, part in zip(models, sums):
                        found[m] = found[m] + part if m in found else part
        yield from packed(found)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for m, raw in zip(batch.column("model").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(raw, "<f8")
                found[m] = found[m] + part if m in found else part
        yield from packed(found)

    parts = rows.select("x", "label", "fold").mapInArrow(add, schema).repartition("model").mapInArrow(meet, schema)
    return {r["model"]: np.frombuffer(bytes(r["sums"]), "<f8") for r in parts.collect()}      # a row per regression


def penalty(beta: np.ndarray, r: Regression) -> float:
    return r.strength * (r.l1_ratio * np.abs(beta[:-1]).sum() + (1 - r.l1_ratio) / 2 * (beta[:-1] ** 2).sum())


def newton_step(beta: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, r: Regression, sweeps: int = 2000) -> np.ndarray:
    """The step that lowers the second-order form of the loss plus the penalty most."""
    d = len(beta)
    ridge = np.r_[np.full(d - 1, r.strength * (1 - r.l1_ratio)), 0.0]
    a = hessian + np.diag(ridge + 1e-12 * max(float(np.trace(hessian)) / d, 1e-300))
    linear = gradient + ridge * beta
    if not r.l1_ratio or not r.strength:
        return np.linalg.lstsq(a, -linear, rcond=None)[0]
    limit, scale, new = np.r_[np.full(d - 1, r.strength * r.l1_ratio), 0.0], np.diag(a), beta.copy()
    slope = linear.copy()                                 # of the second-order form at ``new``
    for _ in range(sweeps):
        moved = 0.0
        for j in range(d):
            if scale[j] <= 0:
                continue
            at = new[j] - slope[j] / scale[j]
            value = np.sign(at) * max(abs(at) - limit[j] / scale[j], 0.0)
            change = value - new[j]
            if change:
                slope += a[:, j] * change
                new[j] = value
                moved = max(moved, scale[j] * change * change)
        if moved < 1e-18:
            break
    return new - beta


@dataclass
class _State:
    beta: np.ndarray
    step: np.ndarray
    value: float = np.inf
    fall: float = 0.0          # of the objective by a full step, to first order and with the penalty whole; negative
    length: float = 1.0
    tried: int = 0


@dataclass
class Regressions:
    """Coefficients of all regressions, the intercept last."""

    encoders: list[Encoder]
    asked: list[Regression]
    coefficients: list[np.ndarray]
    passes: int = 0
    columns: list[str] = field(default_factory=list)

    def held_out(self, rows: DataFrame, row_id: str, groups: Sequence[Sequence[int]]) -> DataFrame:
        """(group, id, fold, label, score): each row by the regression of its group that has left its fold out."""
        kind = rows.schema["ids"].dataType.elementType
        of_fold = [{self.asked[m].fold: m for m in group} for group in groups]
        encoders, coefficients, width = self.encoders, self.coefficients, len(self.columns)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    x, label, fold = _opened(batch, row, width)
                    ids = batch.column("ids").slice(row, 1).flatten()
                    whole = pa.array(label, mask=np.isnan(label))
                    scores = np.full((len(groups), len(x)), np.nan)
                    for k in np.unique(fold).tolist():
                        own = np.flatnonzero(fold == k)
                        if not 0 <= k < len(encoders):
                            continue
                        features = encoders[k].features(x[own])
                        for g, models in enumerate(of_fold):
                            if k in models:
                                scores[g, own] = np.exp(-np.logaddexp(0, -(features * coefficients[models[k]]).sum(axis=1)))
                    for g in range(len(groups)):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), g, dtype=np.int32)), ids, pa.array(fold), whole, pa.array(scores[g])],
                                                         names=["group", row_id, "fold", "label", "score"])

        return rows.mapInArrow(work, f"group int, `{row_id}` {kind.simpleString()}, fold int, label double, score double")


def regress(rows: DataFrame, columns: Sequence[str], encoders: list[Encoder], asked: list[Regression]) -> Regressions:
    """All regressions over ``blocks``, in as many passes as the slowest takes."""
    d = len(columns) + 1
    states = [_State(np.zeros(d), np.zeros(d)) for _ in asked]
    active, passes = list(range(len(asked))), 0
    while active:
        found = _pass(rows, encoders, asked, {m: states[m].beta + states[m].length * states[m].step for m in active}, len(columns))
        passes += 1
        moving = []
        for m in active:
            s, r = states[m], asked[m]
            if m not in found or found[m][0] <= 0:        # no rows
                continue
            sums = found[m] / found[m][0]
            trial = s.beta + s.length * s.step
            value = float(sums[1]) + penalty(trial, r)
            s.tried += 1
            if not value <= s.value + 1e-4 * s.length * s.fall + 1e-14 * abs(s.value if np.isfinite(s.value) else 0.0):
                s.length /= 2
                if s.length >= SHORTEST and s.tried < r.max_iter:
                    moving.append(m)
                continue
            gradient, hessian = sums[2:2 + d], sums[2 + d:].reshape(d, d)
            s.beta, s.value, s.length = trial, value, 1.0
            s.step = newton_step(trial, gradient, hessian, r)
            s.fall = float(gradient @ s.step) + penalty(trial + s.step, r) - penalty(trial, r)
            if s.fall < -PRECISION * max(abs(value), 1e-300) and s.tried < r.max_iter:
                moving.append(m)
        active = moving
    return Regressions(encoders, list(asked), [s.beta for s in states], passes, list(columns))
