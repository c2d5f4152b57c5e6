"""Boosted and single trees of all folds in the passes of one, over blocks of bins that the executors keep.

Model m learns from the rows outside fold m and is judged by those inside; a model whose number is no row's fold learns from all. Every model has its own
``Lesson``: class weights, the bins that missing values are put into, and the columns it reads, where a category is encoded by its own rows. A
row also has the bins that the model of its fold gives it, so that it is judged by what that model has learnt and by nothing else.

Several settings (the candidates of a search) grow side by side too: model m of setting c is number c * models + m.

A pass adds up gradients, hessians and counts by (model, node, feature, bin), of the smaller child of each split only: the other one is the
parent less that. Over few rows a task takes a model each, and all of its passes. Features share a sum by the product of their bins where that has few enough cells, which is then added up by each of them. Where a child's rows need no
counting (its hessian alone is bounded), counts are of some rows and only tell which child is the smaller one. What comes to the driver is bounded by models, open nodes, features and bins, whatever the number of rows; with many tasks it is
added up by model first. Splits, leaf values and draws are those of ``boosting``.

Blocks are written once and kept in memory or on disk by the executors, with each model's scores beside them; scores advance with every
round, in the first pass of the next one, and every ``WRITTEN`` rounds the blocks are read again from the written table, so that no lineage grows with the rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators.boosting import DIGITS, BoostingParams, Tree, bin_edges, drawn_columns, drawn_rows, leaf_score, leaf_weight
from ledgerlark.operators.models import best_round
from ledgerlark.session import materialise

WRITTEN = 100              # rounds after which scores are worked out from the written blocks again
BLOCK_ROWS = 250_000
TASK_WORK = 150_000        # rows times models of a task at least
CELLS = 4_500              # of a sum that several features share
JOINTS = 32                # of them that a task holds
SOME = 8                   # every so many rows are counted where counts only tell the smaller child
CODED = 8                  # levels of a tree whose leaves fit into 8 bits
ALONE = 500_000            # rows that one task is given to grow a model by itself
LEVELS = 12                # of a tree at most: the driver holds the sums of a level
GATHERED = 32 << 20        # bytes of sums that come from the tasks directly


@dataclass(frozen=True)
class Lesson:
    """What a model knows of the columns. ``values`` are put in for what is missing, NaN leaves it missing; ``taught`` are the category places it has seen."""

    weights: dict[int, float]
    columns: list[int]                             # of the table, by feature
    held: list[int]                                # the same for the rows it is judged by
    values: np.ndarray
    taught: dict[int, np.ndarray] = field(default_factory=dict)

    def judged(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) of rows that the model has not seen."""
        out = x[:, self.held].astype(np.float64)
        for f, taught in self.taught.items():
            place = np.where(np.isnan(out[:, f]), -1, out[:, f]).astype(np.int64)
            known = (place >= 0) & np.append(taught, False)[place]
            out[:, f] = np.where(known | np.isnan(out[:, f]), out[:, f], -1.0)
        return np.where(np.isnan(out), self.values, out)


def _bin(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(values), len(edges) + 1, np.searchsorted(edges, values, side="left")).astype(np.uint8)


@dataclass
class Blocks:
    """A written table of blocks, and what is needed to read it."""

    table: DataFrame
    edges: list[np.ndarray]
    lessons: list[Lesson]
    rows: int

    @property
    def missing(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges])

    def kept(self, models: int) -> RDD:
        """The blocks as arrays, with scores of so many models, in tasks that are worth their start."""
        cores = self.table.sparkSession.sparkContext.defaultParallelism
        parts = self.rows * models // TASK_WORK
        rdd = self.table.select("key", "label", "fold", "bins", "held").rdd
        rdd = rdd.coalesce(max(1, parts)) if parts < cores else rdd
        return rdd.mapPartitions(_Opened(len(self.edges), range(models)))


def written(rows: DataFrame, row_id: str, columns: Sequence[str], features: Sequence[int], label: str, fold: str, lessons: list[Lesson], bins: int) -> Blocks:
    """Blocks of ``rows``: ``columns`` are the table's, ``features`` the places of those whose quantiles bound each feature's bins."""
    if bins > 250:
        raise ValueError("at most 250 bins")
    edges = bin_edges(rows, [columns[n] for n in features], bins)
    kind, of = rows.schema[row_id].dataType.simpleString(), np.zeros(len(columns), dtype=np.int64)
    for lesson in lessons:
        for f, places in enumerate(zip(lesson.columns, lesson.held)):
            of[list(places)] = f
    given = rows.select(F.col(row_id).alias("id"), F.xxhash64(row_id).alias("key"), F.col(label).cast("double").alias("label"),
                        F.coalesce(F.col(fold).cast("int"), F.lit(-1)).alias("fold"), F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(columns))
            key, y, part = (batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (("key", "<i8"), ("label", "<f8"), ("fold", "<i4")))
            held = np.zeros((len(edges), len(x)), dtype=np.uint8)
            for m in np.unique(part).tolist():
                if 0 <= m < len(lessons):
                    own = np.flatnonzero(part == m)
                    held[:, own] = [_bin(v, e) for v, e in zip(lessons[m].judged(x[own]).T, edges)]
            binned = np.stack([_bin(x[:, j], edges[of[j]]) for j in range(len(columns))])
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("id").to_pylist()], pa.list_(batch.schema.field("id").type)), *(pa.array([v.tobytes()], pa.binary()) for v in (key, y, part, binned, held))],
                names=["ids", "key", "label", "fold", "bins", "held"])

    table = materialise(given.mapInArrow(work, f"ids array<{kind}>, key binary, label binary, fold binary, bins binary, held binary"), "blocks")
    return Blocks(table, edges, lessons, rows.count())


@dataclass
class _Block:
    key: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    bins: np.ndarray           # (columns, rows)
    held: np.ndarray           # (features, rows)
    margins: dict[int, np.ndarray]      # of the models that still grow


class _Opened:
    def __init__(self, features: int, models: Sequence[int]):
        self.features, self.models = features, models

    def __call__(self, rows) -> Iterator[_Block]:
        waiting, n = [], 0
        for row in rows:
            one = self.arrays(row)
            waiting.append(one)
            n += len(one[0])
            if n >= BLOCK_ROWS:
                yield self.joined(waiting)
                waiting, n = [], 0
        if waiting:
            yield self.joined(waiting)

    def arrays(self, row) -> tuple[np.ndarray, ...]:
        key, label, fold = (np.frombuffer(row[c], t) for c, t in (("key", "<i8"), ("label", "<f8"), ("fold", "<i4")))
        return key, label.astype(np.float32), fold.astype(np.int16), *(np.frombuffer(row[c], np.uint8).reshape(-1, len(key)) for c in ("bins", "held"))

    def joined(self, waiting: list[tuple[np.ndarray, ...]]) -> _Block:
        arrays = [np.concatenate(v, axis=-1) for v in zip(*waiting)]
        return _Block(*arrays, {k: np.zeros(len(arrays[0]), dtype=np.float32) for k in self.models})


def _picked(bins: np.ndarray, columns: Sequence[int], rows: np.ndarray, features) -> np.ndarray:
    """(features, rows) of some rows, filled for ``features`` alone."""
    out = np.empty((len(columns), len(rows)), dtype=bins.dtype)
    for f in features:
        np.take(bins[columns[f]], rows, out=out[f])
    return out


class _Walk:
    """A tree as its splits by level. The place of a row is 8 bits: its turns so far, 0 after a leaf."""

    def __init__(self, tree: Tree, missing: np.ndarray):
        self.tree, self.missing, self.levels = tree, missing, []
        self.ends = {0: 0}                                     # node by place
        while any(tree.feature[node] >= 0 for node in self.ends.values()):
            self.levels.append([(at, node) for at, node in self.ends.items() if tree.feature[node] >= 0])
            below = {}
            for at, node in self.ends.items():
                if tree.feature[node] < 0:
                    below[2 * at] = node
                else:
                    below[2 * at], below[2 * at + 1] = tree.left[node], tree.right[node]
            self.ends = below

    def places(self, bins: np.ndarray, columns: Sequence[int]) -> np.ndarray:
        """Of the rows of (columns, rows); a node of the tree where it is too deep."""
        tree, n = self.tree, bins.shape[1]
        if len(self.levels) > CODED:
            return tree.nodes_of(_picked(bins, columns, np.arange(n), {f for f in tree.feature if f >= 0}).T, self.missing)
        place = np.zeros(n, dtype=np.uint8)
        for depth, level in enumerate(self.levels):
            turned = np.zeros(n, dtype=bool)
            for at, node in level:
                f = tree.feature[node]
                value = bins[columns[f]]
                right = value > tree.bin[node]
                if tree.missing_left[node]:
                    right &= value != int(self.missing[f])
                if depth:
                    right &= place == at
                turned |= right
            place += place
            place += turned.view(np.uint8)
        return place

    def table(self, of_node: np.ndarray) -> np.ndarray:
        """``of_node`` by place."""
        if len(self.levels) > CODED:
            return of_node
        out = np.zeros(1 << len(self.levels), dtype=of_node.dtype)
        out[list(self.ends)] = of_node[list(self.ends.values())]
        return out


def _rise(trees: list[Tree], bins: np.ndarray, columns: Sequence[int], missing: np.ndarray) -> np.ndarray:
    """The trees' scores of the rows of (columns, rows)."""
    out = np.zeros(bins.shape[1])
    for tree in trees:
        walk = _Walk(tree, missing)
        out += walk.table(np.array(tree.value))[walk.places(bins, columns)]
    return out


def _all_of(x: np.ndarray) -> range:
    return range(len(x))


class _Advanced:
    def __init__(self, said):
        self.said = said

    def __call__(self, blocks) -> Iterator[_Block]:
        trees, lessons, missing = self.said.value
        for b in blocks:
            margins = {}
            for k, own in trees.items():
                m = k % len(lessons)
                out = np.flatnonzero(b.fold == m)
                rise = _rise(own, b.bins, lessons[m].columns, missing)
                rise[out] = _rise(own, b.held[:, out], _all_of(b.held), missing)
                margins[k] = (b.margins[k] + rise).astype(np.float32)
            yield replace(b, margins=margins)


@dataclass
class _Asked:
    """What a pass looks at: by model the open nodes (their slots), the tree so far and the trees since the scores were advanced."""

    slots: dict[int, dict[int, int]]
    growing: dict[int, Tree]
    recent: dict[int, list[Tree]]
    round: int
    losses: bool
    boosted: bool


def counted(p: BoostingParams, boosted: bool) -> bool:
    """Whether the rows of a child must be known."""
    return not boosted or p.min_rows > 1 or p.min_child_weight <= 0


def grouped(widths: Sequence[int], cells: int) -> list[list[int]]:
    """Features that share a sum: the products of their bins are at most ``cells``, in one of few sizes, or they are alone."""
    return _grouped(tuple(widths), next((c for c in (CELLS, CELLS // 4, CELLS // 16) if c <= cells), 0))


@lru_cache
def _grouped(widths: tuple[int, ...], cells: int) -> list[list[int]]:
    groups: list[tuple[int, list[int]]] = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        for n, (size, members) in enumerate(groups):
            if size * widths[f] <= cells:
                groups[n] = size * widths[f], [*members, f]
                break
        else:
            groups.append((widths[f], [f]))
    return [members for _, members in groups]


class _Joint:
    """Bins of several features as one number, worked out once for all models that read the same columns."""

    def __init__(self, bins: np.ndarray, widths: Sequence[int]):
        self.bins, self.widths, self.known = bins, widths, {}

    def of(self, features: Sequence[int], columns: Sequence[int]) -> np.ndarray:
        if len(features) == 1:
            return self.bins[columns[features[0]]]
        key = tuple(columns[f] for f in features)
        if key not in self.known:
            if len(self.known) >= JOINTS:
                self.known.clear()
            out = self.bins[key[0]].astype(np.uint16)
            for f, column in zip(features[1:], key[1:]):
                out *= np.uint16(self.widths[f])
                out += self.bins[column]
            self.known[key] = out
        return self.known[key]


def _by_feature(joint: np.ndarray) -> Iterator[np.ndarray]:
    """(sums, bins) of each feature of (sums, bins of the first, bins of the second, ...)."""
    count, *bins = joint.shape
    for n, own in enumerate(bins):
        before, after = math.prod(bins[:n]), math.prod(bins[n + 1:])
        part = (joint.reshape(-1, after) @ np.ones(after)).reshape(count, before, own) if after > 1 else joint.reshape(count, before, own)
        yield part.sum(axis=1) if before > 1 else part[:, 0]


class _Sums:
    """(model, histogram (feature, [gradient, hessian, count], slot, bin)) of a task; (-1 - model, [loss, weight]) for losses."""

    def __init__(self, said):
        self.said = said

    def __call__(self, blocks) -> Iterator[tuple[int, np.ndarray]]:
        asked, lessons, missing, params = self.said.value
        widths, sums = [int(v) + 1 for v in missing], {}
        for b in blocks:
            known, joint = ~np.isnan(b.label), _Joint(b.bins, widths)
            positive, outside = b.label > 0.5, {}
            for k, slots in asked.slots.items():
                m, p = k % len(lessons), params[k // len(lessons)]
                weights = np.array([lessons[m].weights.get(v, 1.0) for v in (0, 1)])
                if asked.losses:
                    out = np.flatnonzero((b.fold == m) & known)
                    if len(out):
                        margin, y = b.margins[k][out] + _rise(asked.recent[k], b.held[:, out], _all_of(b.held), missing), b.label[out]
                        w = np.where(y > 0.5, weights[1], weights[0])
                        self.add(sums, -1 - k, np.array([((np.logaddexp(0, margin) - y * margin) * w).sum(), w.sum()]))
                if not slots:
                    continue
                if m not in outside:
                    outside[m] = known & (b.fold != m)
                tree, used, slot = asked.growing[k], outside[m], None
                if len(tree.feature) > 1:
                    walk, slot_of = _Walk(tree, missing), np.full(len(tree.feature), -1)
                    slot_of[list(slots)] = list(slots.values())
                    slot_of, place = walk.table(slot_of), walk.places(b.bins, lessons[m].columns)
                    used = used & self.inside(place, slot_of)
                rows = np.flatnonzero(used)
                if p.row_share < 1:
                    rows = rows[drawn_rows(b.key[rows], p, asked.round, m)]
                if not len(rows):
                    continue
                if len(tree.feature) > 1:
                    slot = slot_of[place[rows]]
                self.add(sums, k, self.histogram(b, joint, lessons[m].columns, rows, slot, len(slots), positive[rows], weights, asked, k, m, p, missing))
        yield from sums.items()

    @staticmethod
    def inside(place: np.ndarray, slot_of: np.ndarray) -> np.ndarray:
        opened = np.flatnonzero(slot_of >= 0)
        if len(opened) > 40:
            return (slot_of >= 0)[place]
        out = place == opened[0]
        for at in opened[1:]:
            out |= place == at
        return out

    @staticmethod
    def histogram(b: _Block, joint: _Joint, columns, rows, slot, slots, positive, weights, asked: _Asked, k: int, m: int, p: BoostingParams, missing) -> np.ndarray:
        w = np.where(positive, weights[1], weights[0])
        if asked.boosted:
            margin = b.margins[k][rows]
            if asked.recent[k]:
                margin = margin + _rise(asked.recent[k], b.bins[:, rows], columns, missing)
            with np.errstate(over="ignore"):
                chance = (1 / (1 + np.exp(-margin))).astype(np.float64)
            g, h = w * (chance - positive), w * chance * (1 - chance)
        else:
            g, h = -w * positive, w
        bins, whole = max(joint.widths), counted(p, asked.boosted)
        some = slice(None) if whole or len(rows) < 4_096 else slice(None, None, SOME)
        out, drawn = np.zeros((len(missing), 3, slots, bins)), set(drawn_columns(len(missing), p, asked.round, m).tolist())
        for members in grouped(joint.widths, min(CELLS, len(rows) // (2 * slots))):
            if not drawn.intersection(members):
                continue
            shape = [joint.widths[f] for f in members]
            size, at = slots * math.prod(shape), np.take(joint.of(members, columns), rows)
            at = at.astype(np.int64) if slot is None else slot * (size // slots) + at
            sums = np.stack([np.bincount(at, g, size), np.bincount(at, h, size), np.bincount(at[some], minlength=size)])
            for f, part in zip(members, _by_feature(sums.reshape(3 * slots, *shape))):
                out[f, :, :, :part.shape[1]] = part.reshape(3, slots, -1)
        return out

    @staticmethod
    def add(sums: dict[int, np.ndarray], key: int, part: np.ndarray) -> None:
        if key in sums:
            sums[key] += part
        else:
            sums[key] = part


def _gathered(rdd: RDD, size: int) -> dict[int, np.ndarray]:
    if size * rdd.getNumPartitions() > GATHERED:
        return rdd.reduceByKey(np.add, min(rdd.getNumPartitions(), rdd.context.defaultParallelism)).collectAsMap()
    out: dict[int, np.ndarray] = {}
    for key, part in rdd.collect():
        _Sums.add(out, key, part)
    return out


def best_splits(hist: np.ndarray, missing: np.ndarray, imputed: np.ndarray, columns: np.ndarray, p: BoostingParams, whole_counts: bool = True) -> list[tuple | None]:
    """For each node of (nodes, features, bins, 3): (gain, feature, bin, missing left, sums left, sums right), None if nothing is won.

    Without ``whole_counts`` the counts are of some rows, and children are bounded by their hessian alone.
    """
    hist = hist[:, columns].copy()
    missing, imputed, places = missing[columns], imputed[columns], np.arange(len(columns))
    own = imputed >= 0
    hist[:, places[own], imputed[own]] += hist[:, places[own], missing[own]]
    hist[:, places[own], missing[own]] = 0
    lost = hist[:, places, missing].copy()                                      # (nodes, features, 3)
    hist[:, places, missing] = 0
    known = np.cumsum(hist, axis=2)
    whole = known[:, :, -1] + lost
    allowed = np.arange(hist.shape[2])[None, :] < missing[:, None]
    best = [None] * len(hist)
    top = leaf_score(whole[..., 0], whole[..., 1], p)[..., None]
    sides = []
    for to_left in (False, True):
        left = known + lost[:, :, None] if to_left else known
        right = whole[:, :, None] - left
        fits = allowed & (left[..., 1] >= p.min_child_weight) & (right[..., 1] >= p.min_child_weight)
        if whole_counts:
            fits &= (left[..., 2] >= max(1, p.min_rows)) & (right[..., 2] >= max(1, p.min_rows))
        if to_left:
            fits &= (lost[..., 2 if whole_counts else 1] > 0)[..., None]
        gains = 0.5 * (leaf_score(left[..., 0], left[..., 1], p) + leaf_score(right[..., 0], right[..., 1], p) - top)
        sides.append((np.where(fits, np.round(gains, DIGITS), -np.inf), left, right))
    gains = np.stack([s[0] for s in sides], axis=2)                             # (nodes, features, side, bins)
    for n, at in enumerate(gains.reshape(len(gains), -1).argmax(axis=1).tolist()):
        f, side, b = np.unravel_index(at, gains.shape[1:])
        if gains[n, f, side, b] > max(p.min_gain, 0.0):
            to_left = bool(side) or bool(own[f] and imputed[f] <= b)
            best[n] = (float(gains[n, f, side, b]), int(columns[f]), int(b), to_left, sides[side][1][n, f, b], sides[side][2][n, f, b])
    return best


@dataclass
class Grown:
    """Trees of every model, cut to the best round with patience; ``gains`` by feature; losses of the judged rows after 0, 1, ... rounds."""

    blocks: Blocks
    trees: list[list[Tree]]
    gains: np.ndarray
    losses: list[list[float]]
    boosted: bool

    def held_out(self, row_id: str) -> DataFrame:
        """(id, fold, label, score) of the rows that a model has left out."""
        trees, missing, boosted, features = self.trees, self.blocks.missing, self.boosted, len(self.blocks.edges)
        kind = self.blocks.table.schema["ids"].dataType.elementType.simpleString()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    label, fold = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in (("label", "<f8"), ("fold", "<i4")))
                    held = np.frombuffer(batch.column("held")[row].as_py(), np.uint8).reshape(features, -1)
                    score, judged = np.zeros(len(label)), (fold >= 0) & (fold < len(trees))
                    for m in np.unique(fold[judged]).tolist():
                        own = np.flatnonzero(fold == m)
                        score[own] = chance(_scored(trees[m], held[:, own], missing), boosted)
                    table = pa.RecordBatch.from_arrays([batch.column("ids").slice(row, 1).flatten(), pa.array(fold), pa.array(label, mask=np.isnan(label)), pa.array(score)],
                                                       names=[row_id, "fold", "label", "score"])
                    yield table.filter(pa.array(judged))

        return self.blocks.table.select("ids", "label", "fold", "held").mapInArrow(work, f"`{row_id}` {kind}, fold int, label double, score double")


def _scored(trees: list, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """The scores of trees, those of a forest among them."""
    if trees and isinstance(trees[0], Tree):
        return _rise(trees, bins, _all_of(bins), missing)
    return sum((t.scores(bins.T, missing) for t in trees), np.zeros(bins.shape[1]))


def chance(margin: np.ndarray, boosted: bool) -> np.ndarray:
    return 1 / (1 + np.exp(-margin)) if boosted else np.clip(margin, 0.0, 1.0)


def grow(blocks: Blocks, p: BoostingParams, boosted: bool = True) -> Grown:
    """The models of all lessons side by side. Without ``boosted`` one tree each, split by Gini impurity, with the share of positives in its leaves."""
    return grow_all(blocks, [p], boosted)[0]


def grow_all(blocks: Blocks, params: Sequence[BoostingParams], boosted: bool = True, alone: bool = False) -> list[Grown]:
    """``grow`` with each of ``params``, all in the same passes. Those that differ in their rounds alone are the same trees, one has more of them.

    With ``alone`` each model's trees grow in one task that is given all rows, for tables of at most ``ALONE`` rows.
    """
    longest: dict[BoostingParams, int] = {}
    for p in params:
        longest[replace(p, rounds=0)] = max(p.rounds, longest.get(replace(p, rounds=0), 0))
    whole, n, sc = [replace(p, rounds=rounds) for p, rounds in longest.items()], len(blocks.lessons), blocks.table.sparkSession.sparkContext
    job = _Job(blocks.lessons, blocks.edges, whole, boosted)
    with kept_memory(sc.environment):
        if alone:
            grown = _grown_alone(blocks, job, sc)
        else:
            passes = _Passes(blocks, job, sc)
            try:
                grown = _rounds(job, range(n * len(whole)), passes)
            finally:
                passes.end()
    out = []
    for p in params:
        first = list(longest).index(replace(p, rounds=0)) * n
        own, won, lost = zip(*(grown[first + m] for m in range(n)))
        own = [t[:p.rounds if boosted else 1] for t in own]
        won = np.stack([sum(w[:len(t)], np.zeros(len(blocks.edges))) for w, t in zip(won, own)])
        lost = [v[:p.rounds + 1] for v in lost]
        if p.patience and boosted:
            own = [t[:best_round(lost[m][1:], p.patience)] if len(lost[m]) > 1 else t for m, t in enumerate(own)]
        out.append(Grown(blocks, own, won, lost, boosted))
    return out


@contextmanager
def kept_memory(environment: dict) -> Iterator[None]:
    """Python workers that are started inside keep the memory they free: arrays are made anew in every pass."""
    kept = {"MALLOC_MMAP_THRESHOLD_": str(1 << 30), "MALLOC_TRIM_THRESHOLD_": str(1 << 28)}
    before = {name: environment.get(name) for name in kept}
    environment.update(kept)
    try:
        yield
    finally:
        for name, value in before.items():
            environment.pop(name) if value is None else environment.update({name: value})


@dataclass
class _Job:
    """What is grown: model m of setting c is number c * models + m."""

    lessons: list[Lesson]
    edges: list[np.ndarray]
    params: list[BoostingParams]
    boosted: bool

    @property
    def missing(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges])


class _Passes:
    """Looks at the rows by passes over blocks that the executors keep."""

    def __init__(self, blocks: Blocks, job: _Job, sc):
        self.blocks, self.job, self.sc, self.models = blocks, job, sc, len(job.lessons) * len(job.params)
        self.state, self.before, self.said = blocks.kept(self.models).persist(StorageLevel.MEMORY_AND_DISK), None, []

    def looked(self, asked: _Asked) -> dict[int, np.ndarray]:
        job = self.job
        told = self.sc.broadcast((asked, job.lessons, job.missing, job.params))
        size = sum(max(1, len(s)) for s in asked.slots.values()) * len(job.edges) * (int(job.missing.max()) + 1) * 24
        found = _gathered(self.state.mapPartitions(_Sums(told)), size)
        told.destroy()
        if self.before:
            self.before.unpersist()                         # the pass has worked out the new scores
            self.before = None
        return found

    def advance(self, trees: dict[int, list[Tree]], afresh: bool) -> None:
        told = self.sc.broadcast((trees, self.job.lessons, self.job.missing))
        self.before = self.state
        self.state = (self.blocks.kept(self.models) if afresh else self.before).mapPartitions(_Advanced(told)).persist(StorageLevel.MEMORY_AND_DISK)
        self.said.append(told)                              # a lost block is worked out again

    def end(self) -> None:
        for rdd in filter(None, (self.before, self.state)):
            rdd.unpersist()
        for told in self.said:
            told.destroy()


@dataclass
class _Held:
    value: object


class _Alone:
    """The same over all rows inside a task."""

    def __init__(self, rows, job: _Job, model: int):
        self.job, self.state = job, list(_Opened(len(job.edges), [model])(rows))

    def looked(self, asked: _Asked) -> dict[int, np.ndarray]:
        return dict(_Sums(_Held((asked, self.job.lessons, self.job.missing, self.job.params)))(self.state))

    def advance(self, trees: dict[int, list[Tree]], afresh: bool) -> None:
        self.state = list(_Advanced(_Held((trees, self.job.lessons, self.job.missing)))(self.state))


def _grown_alone(blocks: Blocks, job: _Job, sc) -> dict[int, tuple]:
    rows = blocks.table.select("key", "label", "fold", "bins", "held").collect()        # at most ``ALONE`` rows, some 50 bytes each
    told = sc.broadcast(([r.asDict() for r in rows], job))

    def one(model: int) -> tuple:
        rows, job = told.value
        return model, _rounds(job, [model], _Alone(rows, job, model), steady=True)[model]

    models = len(job.lessons) * len(job.params)
    grown = dict(sc.parallelize(range(models), models).map(one).collect())
    told.destroy()
    return grown


def _rounds(job: _Job, models: Sequence[int], view: _Passes | _Alone, steady: bool = False) -> dict[int, tuple]:
    """(trees, gains by feature of each tree, losses of the judged rows after 0, 1, ... rounds) of each of ``models``.

    Scores are worked out from the first tree again after some rounds, unless they are ``steady``.
    """
    params, boosted, lessons, missing = job.params, job.boosted, job.lessons, job.missing
    patience, = {p.patience for p in params}
    n, width = len(lessons), len(missing)
    imputed = [np.array([-1 if np.isnan(v) else int(_bin(np.array([v]), e)[0]) for v, e in zip(l.values, job.edges)]) for l in lessons]
    trees: dict[int, list[Tree]] = {k: [] for k in models}
    gains: dict[int, list[np.ndarray]] = {k: [] for k in models}
    losses: dict[int, list[float]] = {k: [] for k in models}
    advanced, active = 0, list(models)

    def looked(slots, growing, round_, with_loss):
        found = view.looked(_Asked(slots, growing, {k: trees[k][advanced:] for k in slots}, round_, with_loss, boosted))
        for key in [k for k in found if k < 0]:
            loss, weight = found.pop(key)
            losses[-1 - key].append(loss / weight)
        return found

    for round_ in range(max(p.rounds for p in params) if boosted else 1):
        growing = {k: Tree() for k in active}
        slots = {k: {0: 0} for k in active}
        kept: dict[int, dict[int, np.ndarray]] = {k: {} for k in active}       # histograms of the level above
        pairs: dict[int, list[tuple[int, int, int]]] = {k: [] for k in active}  # (parent, looked at, its sibling)
        won = {k: np.zeros(width) for k in active}
        for depth in range(max(params[k // n].max_depth for k in active)):
            found = looked(slots, growing, round_, bool(patience) and boosted and depth == 0)
            for k in list(slots):
                if k not in found:                          # no rows
                    del slots[k]
                    continue
                m, p = k % n, params[k // n]
                columns, hist = drawn_columns(width, p, round_, m), found[k].transpose(0, 2, 3, 1)
                level = {node: hist[:, slot] for node, slot in slots[k].items()}
                level |= {sibling: kept[k][parent] - level[node] for parent, node, sibling in pairs[k]}
                tree, rate = growing[k], p.learning_rate if boosted else 1.0
                if depth == 0:
                    g, h = level[0][columns[0], :, 0].sum(), level[0][columns[0], :, 1].sum()
                    tree.value[0] = rate * float(leaf_weight(g, h, p))
                kept[k], pairs[k], slots[k] = {}, [], {}
                nodes = sorted(level)
                for node, split in zip(nodes, best_splits(np.stack([level[v] for v in nodes]), missing, imputed[m], columns, p, counted(p, boosted))):
                    if split is None:
                        continue
                    gain, f, b, to_left, left, right = split
                    a, c = tree.split(node, f, b, to_left, tuple(rate * float(leaf_weight(s[0], s[1], p)) for s in (left, right)))
                    won[k][f] += gain
                    kept[k][node] = level[node]
                    small, large = (a, c) if left[2] <= right[2] else (c, a)
                    pairs[k].append((node, small, large))
                    slots[k][small] = len(slots[k])
                if not slots[k] or depth + 1 >= p.max_depth:
                    del slots[k]
            if not slots:
                break
        for k in active:
            trees[k].append(growing[k])
            gains[k].append(won[k])
        if patience:
            active = [k for k in active if not losses[k] or len(losses[k]) - 1 - int(np.argmin(losses[k])) < patience]
        ended = [k for k in active if round_ + 1 == params[k // n].rounds]
        if ended and boosted and patience:                  # what the last trees are worth
            looked({k: {} for k in ended}, {k: Tree() for k in ended}, round_ + 1, True)
        active = [k for k in active if k not in ended]
        if not active or not boosted:
            break
        afresh = not steady and (round_ + 1) // WRITTEN > advanced // WRITTEN
        view.advance({k: trees[k][0 if afresh else advanced:] for k in active}, afresh)
        advanced = round_ + 1
    return {k: (trees[k], gains[k], losses[k]) for k in models}
