"""Perceptrons of all folds in the passes of one, by L-BFGS.

The blocks are those of ``logistic``; the executors keep them as arrays. A pass makes each fold's features, runs every perceptron that still moves
forward and back over its rows by matrix products, and adds up loss and gradient; the sums meet by model and come to the driver, where the next
step is found. Over few rows, and with a model for each core, a task trains a model by itself. Products are of 32 bits, sums and steps of 64. Objective, layers (sigmoid, softmax on top), start and stopping rules are those of MLlib's perceptron; its model holds the result. A
step that does not lower the loss enough is cut to a tenth at least and a half at most, as a parabola has it. Rows without label teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ledgerlark.operators.logistic import Encoder, _opened

CHUNK = 512                # rows of one matrix product
HISTORY, MEMORY = 10, 20   # steps that shape a direction, losses that tell a standstill
TASK_WORK = 4_000          # rows times models of a task at least
STEEPEST = 40.0            # sum that a unit of 32 bits is given
SMALLEST = np.float32(1e-25)
ALONE = 500_000            # rows that one task is given to train a model by itself
GATHERED = 64 << 20        # bytes of sums that come from the tasks directly


def shapes(layers: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(layers, layers[1:]))


def started(layers: Sequence[int], seed: int) -> np.ndarray:
    """Weights (inputs, outputs) and offsets of each layer, one after the other."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.uniform(-2.4, 2.4, (a + 1) * b) / a for a, b in shapes(layers)])


def _layers(theta: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in shapes(layers):
        out.append((theta[at:at + a * b].reshape(a, b), theta[at + a * b:at + (a + 1) * b]))
        at += (a + 1) * b
    return out


def _forward(x: np.ndarray, weights: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The outputs of each layer, the log shares of the classes last."""
    out = [x]
    for n, (w, offset) in enumerate(weights):
        z = out[-1] @ w
        z += offset
        if n + 1 < len(weights):
            limit = STEEPEST if z.dtype == np.float32 else 500
            np.clip(z, -limit, limit, out=z)
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
        else:
            z = z.astype(np.float64)
            z -= z.max(axis=1, keepdims=True)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        out.append(z)
    return out


def sums(x: np.ndarray, label: np.ndarray, theta: np.ndarray, layers: Sequence[int]) -> np.ndarray:
    """[rows, loss, gradient]; products are of the type of ``x`` and ``theta``, sums over the chunks of 64 bits."""
    weights, out = _layers(theta, layers), np.zeros(2 + len(theta))
    for start in range(0, len(x), CHUNK):
        y = label[start:start + CHUNK].astype(np.int64)
        outputs, at = _forward(x[start:start + CHUNK], weights), np.arange(len(y))
        out[0] += len(y)
        out[1] -= outputs[-1][at, y].sum()
        delta, end = np.exp(outputs[-1]), len(out)
        delta[at, y] -= 1
        delta = delta.astype(x.dtype, copy=False)
        _flushed(delta)
        for n in range(len(weights) - 1, -1, -1):
            w, rise = weights[n][0], outputs[n]
            out[end - w.shape[1]:end] += delta.sum(axis=0)
            end -= w.shape[1] + w.size
            out[end:end + w.size] += (rise.T @ delta).ravel()
            if n:
                delta = delta @ w.T
                delta *= rise
                delta *= np.subtract(1, rise, out=rise)
                _flushed(delta)
    return out


def _flushed(delta: np.ndarray) -> None:
    """Without numbers so small that a processor takes a hundred times as long for them; they add nothing to sums of others."""
    if delta.dtype == np.float32:
        delta[np.abs(delta) < SMALLEST] = 0


class _Sums:
    def __init__(self, said):
        self.said = said

    def __call__(self, blocks) -> Iterator[tuple[int, np.ndarray]]:
        encoders, trials, layers = self.said.value
        found: dict[int, np.ndarray] = {}
        for x, label, fold in blocks:
            for m, theta in trials.items():
                own = np.flatnonzero((fold != m) & ~np.isnan(label))
                if len(own):
                    add(found, m, sums(_inputs(encoders[m], x[own]), label[own], theta.astype(np.float32), layers))
        yield from found.items()


def _inputs(encoder: Encoder, x: np.ndarray) -> np.ndarray:
    return encoder.features(x)[:, :-1].astype(np.float32)


def add(found: dict[int, np.ndarray], m: int, part: np.ndarray) -> None:
    if m in found:
        found[m] += part
    else:
        found[m] = part


def _alone(told, m: int, state: _State, tol: float, max_iter: int) -> _State:
    """The perceptron that leaves the rows of fold m out, trained over all rows inside a task."""
    blocks, encoders, layers = told
    kept = []
    for x, label, fold in _Arrays(layers[0])(blocks):
        own = np.flatnonzero((fold != m) & ~np.isnan(label))
        if len(own):
            kept.append((_inputs(encoders[m], x[own]), label[own]))
    moves = bool(kept)
    while moves:
        theta, found = state.trial().astype(np.float32), 0.0
        for x, label in kept:
            found = found + sums(x, label, theta, layers)
        moves = state.told(found[1] / found[0], found[2:] / found[0], tol, max_iter)
    return state


@contextmanager
def _one_thread(environment: dict) -> Iterator[None]:
    """Products inside tasks start no threads of their own beside Spark's tasks."""
    name = "OPENBLAS_NUM_THREADS"
    before = environment.get(name)
    environment[name] = "1"
    try:
        yield
    finally:
        environment.pop(name) if before is None else environment.update({name: before})


@dataclass
class _State:
    theta: np.ndarray
    value: float = np.inf
    gradient: np.ndarray | None = None
    step: np.ndarray | None = None
    length: float = 1.0
    slope: float = 0.0
    values: list[float] = field(default_factory=list)
    past: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def trial(self) -> np.ndarray:
        return self.theta if self.step is None else self.theta + self.length * self.step

    def direction(self) -> np.ndarray:
        d, used = -self.gradient, []
        for s, y in reversed(self.past):
            a = (s @ d) / (s @ y)
            d = d - a * y
            used.append(a)
        if self.past:
            s, y = self.past[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(self.past, reversed(used)):
            d = d + (a - (y @ d) / (s @ y)) * s
        return d

    def told(self, value: float, gradient: np.ndarray, tol: float, max_iter: int) -> bool:
        """Takes the sums at the trial; whether there is a further step."""
        if self.step is not None and not value <= self.value + 1e-4 * self.length * self.slope:
            rise = value - self.value - self.length * self.slope           # above the straight line: a parabola through both has its lowest point there
            share = -self.length * self.slope / (2 * rise) if np.isfinite(rise) else 0.0
            self.length *= min(max(share, 0.1), 0.5)
            return self.length > 1e-10
        if self.step is not None:
            s, y = self.length * self.step, gradient - self.gradient
            if s @ y > 1e-12 * (y @ y):
                self.past = [*self.past, (s, y)][-HISTORY:]
            self.theta = self.theta + s
        self.value, self.gradient = value, gradient
        self.values.append(value)
        recent = self.values[-MEMORY:]
        if (len(self.values) > max_iter or np.linalg.norm(gradient) <= max(tol * abs(value), 1e-8)
                or (len(self.values) > MEMORY and abs(value - max(recent)) <= tol * abs(self.values[0]))):
            return False
        self.step = self.direction()
        self.slope = float(gradient @ self.step)
        self.length = 1.0 if self.past else 1.0 / max(float(np.linalg.norm(gradient)), 1e-12)
        return True


@dataclass
class Perceptrons:
    """Weights of the perceptrons of all folds, and of all rows last where asked for."""

    encoders: list[Encoder]
    layers: list[int]
    thetas: list[np.ndarray]
    values: list[list[float]]

    def held_out(self, rows: DataFrame, row_id: str, folds: int) -> DataFrame:
        """(id, fold, label, score): each row by the perceptron that has left its fold out."""
        kind = rows.schema["ids"].dataType.elementType
        encoders, thetas, layers = self.encoders, self.thetas, self.layers

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    x, label, fold = _opened(batch, row, layers[0])
                    score = np.full(len(x), np.nan)
                    for m in np.unique(fold[(fold >= 0) & (fold < folds)]).tolist():
                        own = np.flatnonzero(fold == m)
                        score[own] = np.exp(_forward(encoders[m].features(x[own])[:, :-1], _layers(thetas[m], layers))[-1][:, 1])
                    table = pa.RecordBatch.from_arrays([batch.column("ids").slice(row, 1).flatten(), pa.array(fold), pa.array(label, mask=np.isnan(label)), pa.array(score)],
                                                       names=[row_id, "fold", "label", "score"])
                    yield table.filter(pa.array((fold >= 0) & (fold < folds)))

        return rows.mapInArrow(work, f"`{row_id}` {kind.simpleString()}, fold int, label double, score double")


class _Arrays:
    def __init__(self, width: int):
        self.width = width

    def __call__(self, rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for row in rows:
            label, fold = np.frombuffer(row["label"], "<f8"), np.frombuffer(row["fold"], "<i4")
            yield np.frombuffer(row["x"], "<f8").reshape(-1, self.width), label, fold


def train(rows: DataFrame, n: int, encoders: list[Encoder], layers: Sequence[int], max_iter: int, tol: float, seed: int) -> Perceptrons:
    """A perceptron for each encoder over the blocks ``rows`` of ``n`` rows; the m-th leaves the rows of fold m out."""
    sc, layers = rows.sparkSession.sparkContext, list(layers)
    states = [_State(started(layers, seed + m)) for m in range(len(encoders))]
    with _one_thread(sc.environment):
        if n <= ALONE and 2 * len(states) > sc.defaultParallelism:
            states = _trained_alone(rows, sc, encoders, layers, states, tol, max_iter)
        else:
            _trained_by_passes(rows, sc, n, encoders, layers, states, tol, max_iter)
    return Perceptrons(encoders, layers, [s.theta for s in states], [s.values for s in states])


def _trained_alone(rows: DataFrame, sc, encoders: list[Encoder], layers: list[int], states: list[_State], tol: float, max_iter: int) -> list[_State]:
    blocks = [r.asDict() for r in rows.select("x", "label", "fold").collect()]          # at most ``ALONE`` rows of numbers
    told = sc.broadcast((blocks, encoders, layers))
    found = sc.parallelize(list(enumerate(states)), len(states)).map(lambda at: _alone(told.value, *at, tol, max_iter)).map(lambda s: (s.theta, s.values)).collect()
    told.destroy()
    return [_State(theta, values=values) for theta, values in found]


def _trained_by_passes(rows: DataFrame, sc, n: int, encoders: list[Encoder], layers: list[int], states: list[_State], tol: float, max_iter: int) -> None:
    kept, parts = rows.select("x", "label", "fold").rdd, max(1, n * len(encoders) // TASK_WORK)
    if parts < sc.defaultParallelism:
        kept = kept.coalesce(parts)
    elif kept.getNumPartitions() < sc.defaultParallelism:
        kept = kept.repartition(sc.defaultParallelism)
    kept = kept.mapPartitions(_Arrays(layers[0])).persist(StorageLevel.MEMORY_AND_DISK)
    active = list(range(len(states)))
    while active:
        told = sc.broadcast((encoders, {m: states[m].trial() for m in active}, layers))
        parts, found = kept.mapPartitions(_Sums(told)), {}
        if len(active) * kept.getNumPartitions() * len(states[0].theta) * 8 > GATHERED:
            found = parts.reduceByKey(np.add, min(len(active), sc.defaultParallelism)).collectAsMap()      # a vector a model
        else:
            for m, part in parts.collect():
                add(found, m, part)
        told.destroy()
        active = [m for m in active if m in found and states[m].told(found[m][1] / found[m][0], found[m][2:] / found[m][0], tol, max_iter)]
    kept.unpersist()
