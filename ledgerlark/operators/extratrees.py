"""Extremely randomised trees: per node and feature one threshold drawn between the node's bounds, no binning.

A level takes two passes over blocks of raw values for all trees of all folds' models. The first finds bounds and class weights of each open
node by (tree, node); where they meet, ``columns`` features that vary there are drawn, and a threshold for each, by a hash of (seed, tree,
node, feature). The second adds up what goes left, and the split with the least impurity is taken. A tree is thus a function of
the rows and the seed, however the rows are dealt. Trees of model m (``n_trees`` of each) leave the rows of fold m out.

A task holds the sums of ``OPEN_NODES`` nodes; a level with more takes further passes. Only drawn splits come to the driver, a row a node, and the
trees' size bounds what is broadcast. A missing value goes right and has no part in the bounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators.boosting import _mixed
from ledgerlark.session import materialise

OPEN_NODES = 20_000
DIGITS = 9                 # of an impurity that decide


@dataclass(frozen=True)
class ExtraParams:
    n_trees: int = 100
    max_depth: int = 15
    min_rows: int = 1
    columns: int = 0           # features tried in a node, 0 for the square root of their number
    seed: int = 42


def draws(seed: int, tree: int, path: int, n: int, use: int) -> np.ndarray:
    """Numbers of [0, 1) for the features of a node: ``use`` 0 orders them, 1 places their thresholds."""
    keys = np.array([hash_ & 0x7FFFFFFFFFFFFFFF for hash_ in ((path * 1_000_003 + tree) * 4099 + f for f in range(n))], dtype=np.int64)
    return _mixed(keys, seed * 2 + use)


def drawn_splits(low: np.ndarray, high: np.ndarray, tree: int, path: int, p: ExtraParams) -> list[tuple[int, float]]:
    """(feature, threshold) of the features tried in a node, in the order drawn; those with one value or none are passed over."""
    n = len(low)
    order, places = (draws(p.seed, tree, path, n, use) for use in (0, 1))
    varying = [f for f in np.argsort(order, kind="stable").tolist() if low[f] < high[f]]
    out = []
    for f in varying[:p.columns or max(1, int(np.sqrt(n)))]:
        threshold = low[f] + places[f] * (high[f] - low[f])
        out.append((f, float(threshold if threshold < high[f] else low[f])))
    return out


def impurity(left: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Gini impurity after the split as a share of the node's weight, from (..., [weight of 0, weight of 1, rows])."""
    out = 0.0
    for part in (left, whole - left):
        total = np.maximum(part[..., 0] + part[..., 1], 1e-300)
        out = out + 2 * part[..., 0] * part[..., 1] / total
    return np.round(out / (whole[..., 0] + whole[..., 1]), DIGITS)


@dataclass
class ExtraTree:
    """Nodes in the order of their making; ``feature`` is -1 in leaves, ``path`` is 1 at the top, then 2p and 2p+1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    path: list[int] = field(default_factory=lambda: [1])

    def split(self, node: int, feature: int, threshold: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.threshold[node], self.left[node] = feature, threshold, len(self.feature)
        for side, value in enumerate(values):
            for column, entry in zip((self.feature, self.threshold, self.left, self.value, self.path),
                                     (-1, 0.0, 0, value, 2 * self.path[node] + side)):
                column.append(entry)
        return self.left[node], self.left[node] + 1

    def nodes_of(self, x: np.ndarray) -> np.ndarray:
        feature, threshold, left = np.array(self.feature), np.array(self.threshold), np.array(self.left)
        node = np.zeros(len(x), dtype=np.int64)
        inner = np.arange(len(x)) if feature[0] >= 0 else np.arange(0)
        while len(inner):
            now = node[inner]
            node[inner] = left[now] + ~(x[inner, feature[now]] <= threshold[now])
            inner = inner[feature[node[inner]] >= 0]
        return node


def _blocks(df: DataFrame, features: Sequence[str], label: str, weight: str | None, fold: str | None) -> DataFrame:
    rows = df.select(F.col(label).cast("double").alias("label"),
                     (F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)).alias("weight"),
                     (F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)).alias("fold"),
                     F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("x")).filter("label IS NOT NULL AND weight > 0")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                cells = [flat, *(batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (("label", "<f8"), ("weight", "<f8"), ("fold", "<i4")))]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["x", "label", "weight", "fold"])

    return materialise(rows.mapInArrow(work, "x binary, label binary, weight binary, fold binary"), "blocks")


def _summed(blocks: DataFrame, trees: list[ExtraTree], opened: list[tuple[int, int]], n_trees: int, width: int, slot_sums, merge, finish) -> dict[int, tuple]:
    """``finish(slot, sums)`` of every open node, where sums are what ``slot_sums`` returns for the node's rows in a block, put together by ``merge``."""
    by_tree: dict[int, list[tuple[int, int]]] = {}
    for slot, (tree, node) in enumerate(opened):
        by_tree.setdefault(tree, []).append((slot, node))
    busy = {t: trees[t] for t in by_tree}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                label, weight, fold = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in (("label", "<f8"), ("weight", "<f8"), ("fold", "<i4")))
                x = np.frombuffer(batch.column("x")[row].as_py(), "<f8").reshape(len(label), width)
                for t, slots in by_tree.items():
                    slot_of = np.full(len(busy[t].feature), -1, dtype=np.int64)
                    slot_of[[n for _, n in slots]] = [s for s, _ in slots]
                    slot = slot_of[busy[t].nodes_of(x)]
                    own = np.flatnonzero((slot >= 0) & (fold != t // n_trees))
                    if not len(own):
                        continue
                    own = own[np.argsort(slot[own], kind="stable")]
                    starts = np.flatnonzero(np.r_[True, np.diff(slot[own]) > 0])
                    sums = slot_sums(x[own], label[own], weight[own], slot[own], starts)
                    for s, part in zip(slot[own][starts].tolist(), sums):
                        found[s] = merge(found[s], part) if s in found else part
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())],
                                             names=["slot", "sums"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, raw in zip(batch.column("slot").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(raw, "<f8")
                found[s] = merge(found[s], part) if s in found else part
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([finish(s, v) for s, v in found.items()], pa.list_(pa.float64()))],
                                             names=["slot", "numbers"])

    parts = blocks.mapInArrow(add, "slot int, sums binary").repartition("slot")
    return {r["slot"]: r["numbers"] for r in parts.mapInArrow(meet, "slot int, numbers array<double>").collect()}      # a row per open node


def _class_weights(label, weight, starts) -> np.ndarray:
    return np.stack([np.add.reduceat(v, starts) for v in (weight * (label < 0.5), weight * (label >= 0.5), np.ones(len(label)))], axis=1)


def _level(blocks: DataFrame, trees: list[ExtraTree], opened: list[tuple[int, int]], width: int, p: ExtraParams) -> list[tuple[int, int]]:
    """Splits the open (tree, node)s that can be split and returns their children."""
    def bounds(x, label, weight, slot, starts):
        return np.hstack([np.fmin.reduceat(x, starts), np.fmax.reduceat(x, starts), _class_weights(label, weight, starts)])

    def wider(a, b):
        return np.concatenate([np.fmin(a[:width], b[:width]), np.fmax(a[width:-3], b[width:-3]), a[-3:] + b[-3:]])

    paths = [trees[t].path[n] for t, n in opened]

    def draw(slot, v):
        w0, w1, n = v[-3:]
        if not w0 or not w1 or n < 2 * max(1, p.min_rows):
            return [w0, w1, n]
        return [w0, w1, n, *(number for split in drawn_splits(v[:width], v[width:-3], opened[slot][0], paths[slot], p) for number in split)]

    drawn = _summed(blocks, trees, opened, p.n_trees, width, bounds, wider, draw)
    for slot, (w0, w1, *_) in drawn.items():
        tree, node = opened[slot]
        trees[tree].value[node] = w1 / (w0 + w1)
    asked = [slot for slot, numbers in drawn.items() if len(numbers) > 3]
    if not asked:
        return []
    tried = max((len(drawn[s]) - 3) // 2 for s in asked)
    feature, threshold = np.zeros((len(asked), tried), dtype=np.int64), np.full((len(asked), tried), -np.inf)
    whole = np.array([drawn[s][:3] for s in asked])
    for i, s in enumerate(asked):
        pairs = np.array(drawn[s][3:]).reshape(-1, 2)
        feature[i, :len(pairs)], threshold[i, :len(pairs)] = pairs[:, 0], pairs[:, 1]

    def lefts(x, label, weight, slot, starts):
        goes = np.take_along_axis(x, feature[slot], axis=1) <= threshold[slot]
        return np.stack([_class_weights(label, weight * goes[:, j], starts) * [1, 1, 0] + np.add.reduceat(goes[:, j].astype(float), starts)[:, None] * [0, 0, 1]
                         for j in range(tried)], axis=1).reshape(len(starts), -1)

    def choose(slot, v):
        left = v.reshape(tried, 3)
        fits = (left[:, 2] >= max(1, p.min_rows)) & (whole[slot, 2] - left[:, 2] >= max(1, p.min_rows))
        if not fits.any():
            return [-1.0, 0.0, 0.0, 0.0]
        best = int(np.argmin(np.where(fits, impurity(left, whole[slot]), np.inf)))
        return [float(best), *left[best].tolist()]

    children = []
    for slot, (best, l0, l1, _) in sorted(_summed(blocks, trees, [opened[s] for s in asked], p.n_trees, width, lefts, np.add, choose).items()):
        if best >= 0:
            (tree, node), (w0, w1, _) = opened[asked[slot]], whole[slot]
            values = (l1 / (l0 + l1), (w1 - l1) / (w0 + w1 - l0 - l1))
            best = int(best)
            children += [(tree, child) for child in trees[tree].split(node, int(feature[slot, best]), float(threshold[slot, best]), values)]
    return children


@dataclass
class ExtraForest:
    """The trees of the models of all folds, those of the model of all rows last."""

    features: list[str]
    trees: list[list[ExtraTree]]

    def score(self, df: DataFrame, score: str = "score", fold: str | None = None) -> DataFrame:
        """``df`` with the mean leaf share by the model of all rows, or with ``fold`` by the model that has not seen the row's fold."""
        trees, n_folds, width = self.trees, len(self.trees) - 1, len(self.features)
        kept = [f for f in df.schema if f.name != score]
        given = df.select(*[F.col(f"`{f.name}`") for f in kept], F.array(*[F.col(f"`{c}`").cast("double") for c in self.features]).alias("__values"),
                          (F.coalesce(F.col(fold).cast("int"), F.lit(n_folds)) if fold else F.lit(n_folds)).alias("__model"))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("__values").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
                model, out = batch.column("__model").to_numpy(zero_copy_only=False), np.zeros(batch.num_rows)
                for m in np.unique(model).tolist():
                    own, forest = np.flatnonzero(model == m), trees[m if 0 <= m < n_folds else n_folds]
                    out[own] = sum(np.array(t.value)[t.nodes_of(x[own])] for t in forest) / len(forest)
                rest = batch.select([f.name for f in kept])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(out)], schema=rest.schema.append(pa.field(score, pa.float64())))

        return given.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{score}` double")


def grow(df: DataFrame, features: Sequence[str], label: str, params: ExtraParams = ExtraParams(), weight: str | None = None,
         fold: str | None = None, n_folds: int = 0, open_nodes: int = OPEN_NODES) -> ExtraForest:
    """Forests of all folds (rows whose ``fold`` is m take no part in model m) and of all rows, level by level together."""
    p, features = params, list(features)
    blocks = _blocks(df, features, label, weight, fold)
    trees = [ExtraTree() for _ in range((n_folds + 1) * p.n_trees)]
    opened = [(t, 0) for t in range(len(trees))]
    for _ in range(p.max_depth):
        nodes, opened = opened, []
        for start in range(0, len(nodes), open_nodes):
            opened += _level(blocks, trees, nodes[start:start + open_nodes], len(features), p)
        if not opened:
            break
    return ExtraForest(features, [trees[m * p.n_trees:(m + 1) * p.n_trees] for m in range(n_folds + 1)])
