"""Random forests over blocks of bins: large nodes by shared passes, small ones finished inside tasks.

The rows of a model are kept by the executors with their place in every tree of a group. A pass counts the rows of each open node by (drawn feature,
bin, class), the counts of a node meet, and its best split by Gini impurity is chosen. A node of few rows is not looked at again by all: its rows go to one task,
which grows everything below it. Rows of pure nodes stay where they are, so deep trees move few rows and no task ever holds more than ``LOCAL`` rows of one node.

Sample sizes, counts and gains come from whole numbers, and all draws follow a hash of (seed, tree, row id or path of the node): a forest depends neither on partitions
nor on retries. A group holds so many trees that rows times trees stay below ``GROUP``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel

from ledgerlark.operators.boosting import DIGITS, _mixed
from ledgerlark.operators.foldtrees import Blocks, Lesson, _bin, _gathered

LOCAL = (50_000, 1_000_000)    # rows of a node that one task grows alone, by the size of the table
SHORT = 32_000                 # numbers of nodes that fit into 16 bits
GROUP = 200_000_000            # rows times trees at a time
PIECE = 250_000                # rows of a kept piece
LOOK = 2_048                   # nodes whose counts a task holds at a time
POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(12)])
SHARES = {"sqrt": lambda n: math.ceil(math.sqrt(n)), "all": lambda n: n,
          "log2": lambda n: max(1, math.ceil(math.log2(n))), "onethird": lambda n: math.ceil(n / 3)}


@dataclass(frozen=True)
class ForestParams:
    trees: int
    max_depth: int
    min_rows: int = 1
    tries: int = 4                 # features a node draws
    bootstrap: bool = True         # each tree has rows as often as a Poisson draw says; else all of them once
    seed: int = 42


@dataclass
class ForestTree:
    """Nodes by level; ``feature`` is -1 in leaves, the right child follows the left one. ``value`` is the share of positives over the number of trees."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def __post_init__(self):
        self.feature, self.bin, self.left, self.value = (
            np.asarray(v, dtype=t) for v, t in ((self.feature, np.int16), (self.bin, np.uint8), (self.left, np.int32), (self.value, np.float32)))

    def nodes_of(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The leaf of each row of (rows, features), best with each feature's bins side by side in memory; what is missing is beyond all bins."""
        flat, n = bins.ravel(order="F"), len(bins)
        place, rows = np.zeros(n, dtype=np.int32), np.arange(n)
        while len(rows):
            at = place[rows]
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            rows, at, f = rows[inner], at[inner], f[inner].astype(np.int64)
            place[rows] = self.left[at] + (flat[f * n + rows] > self.bin[at])
        return place

    def scores(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        return self.value[self.nodes_of(bins, missing)].astype(np.float64)


# --- draws ----------------------------------------------------------------------------------

def _stirred(x: np.ndarray) -> np.ndarray:
    z = x + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def root_path(p: ForestParams, tree: int) -> np.ndarray:
    return _stirred(np.array([p.seed * 1_000_003 + tree], dtype=np.uint64))


def child_paths(paths: np.ndarray) -> np.ndarray:
    """Left and right child of each, in turn."""
    return _stirred(paths[:, None] ^ np.array([1, 2], dtype=np.uint64)).ravel()


def drawn_features(paths: np.ndarray, width: int, tries: int) -> np.ndarray:
    """(nodes, tries) of different features, ascending."""
    order = _stirred(paths[:, None] + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, :tries], axis=1)


def drawn_times(keys: np.ndarray, p: ForestParams, tree: int) -> np.ndarray:
    """How often each row is in the tree's sample."""
    return np.searchsorted(POISSON, _mixed(np.ascontiguousarray(keys), p.seed * 31 + tree * 7919 + 3), side="right").astype(np.uint8)


# --- one level ------------------------------------------------------------------------------

def counted(x: np.ndarray, rows: np.ndarray, y: np.ndarray, times: np.ndarray | None, slot: np.ndarray, drawn: np.ndarray, bins: int) -> np.ndarray:
    """(nodes, tries, bins, classes): rows of each node by the bins of its drawn features. ``y``, ``times`` and ``slot`` are those of ``rows``."""
    flat, at, size = x.ravel(), rows * x.shape[1], len(drawn) * bins * 2
    base, out = slot * (bins * 2) + y, []
    for tried in drawn.T:
        out.append(np.bincount(base + flat[at + tried[slot]].astype(np.int64) * 2, times, size).reshape(len(drawn), bins, 2))
    return np.stack(out, axis=1).astype(np.float64)


def best_splits(counts: np.ndarray, drawn: np.ndarray, weights: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each node: gain (0 if nothing is won), feature, bin, and (side, class) counts of its children."""
    left = np.cumsum(counts, axis=2)
    whole = left[:, :1, -1:]
    left = left[:, :, :-1]
    right = whole - left

    def squares(v):
        v = v * weights
        total = v[..., 0] + v[..., 1]
        return (v[..., 0] ** 2 + v[..., 1] ** 2) / np.maximum(total, 1e-300), total

    (a, _), (b, _), (c, total) = squares(left), squares(right), squares(whole)
    fits = (left[..., 0] + left[..., 1] >= min_rows) & (right[..., 0] + right[..., 1] >= min_rows)
    gains = np.where(fits, np.round((a + b - c) / np.maximum(total, 1e-300), DIGITS), 0.0)
    gains = gains.reshape(len(gains), -1)
    at, nodes = gains.argmax(axis=1), np.arange(len(gains))
    tried, cut = np.divmod(at, left.shape[2])
    return gains[nodes, at] * total[:, 0, 0], drawn[nodes, tried], cut, np.stack([left[nodes, tried, cut], right[nodes, tried, cut]], axis=1)


def can_split(tally: np.ndarray, p: ForestParams) -> np.ndarray:
    return (tally > 0).all(axis=1) & (tally.sum(axis=1) >= 2 * max(1, p.min_rows))


def positives(tally: np.ndarray, weights: np.ndarray) -> np.ndarray:
    weighted = tally * weights
    return weighted[:, 1] / np.maximum(weighted.sum(axis=1), 1e-300)


def finished(x: np.ndarray, y: np.ndarray, times: np.ndarray | None, depth: int, path: np.ndarray, bins: int, weights: np.ndarray, p: ForestParams):
    """(feature, bin, left, share of positives) of the nodes below one, itself first, and the gains by feature."""
    width, levels, gained, made = x.shape[1], [], np.zeros(x.shape[1]), 1
    y, times = y.astype(np.int64), None if times is None else times.astype(np.float64)
    rows, slot = np.arange(len(y)), np.zeros(len(y), dtype=np.int64)
    tally = np.bincount(y, times, 2).reshape(1, 2)
    while True:
        k = len(path)
        feature, cut, left, share = np.full(k, -1, np.int16), np.zeros(k, np.uint8), np.zeros(k, np.int32), positives(tally, weights)
        levels.append((feature, cut, left, share))
        opened = np.flatnonzero(can_split(tally, p)) if depth < p.max_depth else []
        if not len(opened):
            break
        place = np.full(k, -1)
        place[opened] = np.arange(len(opened))
        rows, slot = _kept(rows, place[slot])
        drawn, found = drawn_features(path[opened], width, p.tries), []
        for first in range(0, len(opened), LOOK):
            some = np.flatnonzero((slot >= first) & (slot < first + LOOK)) if len(opened) > LOOK else slice(None)
            own, of = rows[some], drawn[first:first + LOOK]
            found.append(best_splits(counted(x, own, y[own], None if times is None else times[own], slot[some] - first, of, bins), of, weights, p.min_rows))
        gain, f, b, sides = (np.concatenate(v) for v in zip(*found))
        won = np.flatnonzero(gain > 0)
        if not len(won):
            break
        feature[opened[won]], cut[opened[won]], left[opened[won]] = f[won], b[won], made + 2 * np.arange(len(won))
        np.add.at(gained, f[won], gain[won])
        child = np.full(len(opened), -1)
        child[won] = 2 * np.arange(len(won))
        rows, slot = _kept(rows, np.where(child[slot] >= 0, child[slot] + (x.ravel()[rows * width + f[slot]] > b[slot]), -1))
        tally, path, made, depth = sides[won].reshape(-1, 2), child_paths(path[opened[won]]), made + 2 * len(won), depth + 1
    return tuple(np.concatenate(v) for v in zip(*levels)), gained


def _kept(rows: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.flatnonzero(slot >= 0)
    return rows[inside], slot[inside]


# --- passes ---------------------------------------------------------------------------------

@dataclass
class _Piece:
    x: np.ndarray                  # (rows, features), missing values put in
    y: np.ndarray
    times: np.ndarray | None       # (trees, rows)
    place: np.ndarray              # (trees, rows): number of the open node; -1 in none, -2 - n in small node n


class _Opened:
    """Pieces of the rows that model ``m`` learns from."""

    def __init__(self, m: int, lesson: Lesson, missing: np.ndarray, imputed: np.ndarray, p: ForestParams, trees: range, start: int):
        self.m, self.lesson, self.missing, self.imputed, self.p, self.trees, self.start = m, lesson, missing, imputed, p, trees, start

    def __call__(self, rows) -> Iterator[_Piece]:
        waiting, n = [], 0
        for row in rows:
            key, label, fold = (np.frombuffer(row[c], t) for c, t in (("key", "<i8"), ("label", "<f8"), ("fold", "<i4")))
            used = np.flatnonzero(~np.isnan(label) & (fold != self.m))
            x = np.frombuffer(row["bins"], np.uint8).reshape(-1, len(key))[self.lesson.columns][:, used]
            x = np.where((x == self.missing[:, None]) & (self.imputed >= 0)[:, None], self.imputed[:, None].astype(np.uint8), x)
            waiting.append((key[used], label[used] > 0.5, np.ascontiguousarray(x.T)))
            n += len(used)
            if n >= PIECE:
                yield self.piece(waiting)
                waiting, n = [], 0
        if n:
            yield self.piece(waiting)

    def piece(self, waiting) -> _Piece:
        key, y, x = (np.concatenate(v) for v in zip(*waiting))
        place, times = np.full((len(self.trees), len(key)), self.start, dtype=np.int16), None
        if self.p.bootstrap:
            times = np.stack([drawn_times(key, self.p, t) for t in self.trees])
            place[times == 0] = -1
        return _Piece(x, y.astype(np.uint8), times, place)


class _Counted:
    """(tree, counts of its open nodes) of a task."""

    def __init__(self, said):
        self.said = said

    def __call__(self, pieces) -> Iterator[tuple[int, np.ndarray]]:
        (drawn, bins), sums = self.said.value, {}
        for piece in pieces:
            for t, tried in drawn.items():
                rows = np.flatnonzero(piece.place[t] >= 0)
                if len(rows):
                    times = None if piece.times is None else piece.times[t, rows].astype(np.float64)
                    part = counted(piece.x, rows, piece.y[rows].astype(np.int64), times, piece.place[t, rows].astype(np.int64), tried, bins)
                    if t in sums:
                        sums[t] += part
                    else:
                        sums[t] = part
        yield from sums.items()


class _Moved:
    """Rows of split nodes at the children, those of leaves at none."""

    def __init__(self, said):
        self.said = said

    def __call__(self, pieces) -> Iterator[_Piece]:
        splits, short = self.said.value
        for piece in pieces:
            kind = piece.place.dtype if short else np.int32
            place, flat, width = piece.place.astype(kind), piece.x.ravel(), piece.x.shape[1]
            for t, (feature, cut, children) in splits.items():
                rows = np.flatnonzero(place[t] >= 0)
                slot = place[t, rows]
                place[t, rows] = children[slot, (flat[rows * width + feature[slot]] > cut[slot]).astype(np.int64)]
            yield _Piece(piece.x, piece.y, piece.times, place)


class _Sent:
    """(number of the small node, its rows) of a task."""

    def __init__(self, said):
        self.said = said

    def __call__(self, pieces) -> Iterator[tuple[int, tuple]]:
        numbers = self.said.value
        for piece in pieces:
            for t, number in numbers.items():
                rows = np.flatnonzero(piece.place[t] <= -2)
                small = -2 - piece.place[t, rows]
                order = np.argsort(small, kind="stable")
                rows, small = rows[order], small[order]
                for own in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(small)) + 1):
                    if len(own):
                        at = rows[own]
                        yield number[small[own[0]]], (piece.x[at].tobytes(), piece.y[at].tobytes(), b"" if piece.times is None else piece.times[t, at].tobytes())


class _Finished:
    def __init__(self, said):
        self.said = said

    def __call__(self, groups):
        about, width, bins, weights, p = self.said.value
        for number, parts in groups:
            x, y, times = (np.frombuffer(b"".join(v), np.uint8) for v in zip(*parts))
            depth, path = about[number]
            yield number, finished(x.reshape(-1, width), y, times if len(times) else None, depth, path, bins, weights, p)


class _Growing:
    """A tree on the driver: its top, the open nodes of the last level, and the small nodes that tasks finish."""

    def __init__(self, path: np.ndarray):
        self.feature, self.bin, self.left, self.value = [-1], [0], [0], [0.0]
        self.opened, self.paths, self.small = [0], path, []         # small: (node, depth, path, rows)

    def level(self, counts: np.ndarray, drawn: np.ndarray, weights: np.ndarray, depth: int, local: int, p: ForestParams, gained: np.ndarray) -> tuple:
        """Splits the open nodes; (feature, bin, places of the children) of each."""
        if depth == 0:
            self.value[0] = float(positives(counts[:, 0].sum(axis=1), weights)[0])
        gain, f, b, sides = best_splits(counts, drawn, weights, p.min_rows)
        below, opened, paths = child_paths(self.paths), [], []
        children = np.full((len(f), 2), -1, dtype=np.int64)
        for n in np.flatnonzero(gain > 0).tolist():
            node = self.opened[n]
            self.feature[node], self.bin[node], self.left[node] = int(f[n]), int(b[n]), len(self.feature)
            gained[f[n]] += gain[n]
            may, shares = can_split(sides[n], p), positives(sides[n], weights)
            for side in (0, 1):
                for column, entry in zip((self.feature, self.bin, self.left, self.value), (-1, 0, 0, float(shares[side]))):
                    column.append(entry)
                if not may[side] or depth + 1 >= p.max_depth:
                    continue
                rows, path = int(sides[n, side].sum()), below[2 * n + side]
                if rows <= local:
                    children[n, side] = -2 - len(self.small)
                    self.small.append((len(self.feature) - 1, depth + 1, path, rows))
                else:
                    children[n, side] = len(opened)
                    opened.append(len(self.feature) - 1)
                    paths.append(path)
        self.opened, self.paths = opened, np.array(paths, dtype=np.uint64)
        return f.astype(np.int64), b.astype(np.uint8), children

    def whole(self, below: dict[int, tuple], trees: int) -> ForestTree:
        """The tree with what was grown below the small nodes."""
        parts = [[np.array(v)] for v in (self.feature, self.bin, self.left, self.value)]
        feature, cut, left, value = (v[0] for v in parts)
        made = len(feature)
        for n, (node, *_) in enumerate(self.small):
            f, b, l, share = below[n]
            l = np.where(f >= 0, l + (made - 1), 0)
            feature[node], cut[node], left[node], value[node] = f[0], b[0], l[0], share[0]
            for part, v in zip(parts, (f, b, l, share)):
                part.append(v[1:])
            made += len(f) - 1
        feature, cut, left, value = (np.concatenate(v) for v in parts)
        return ForestTree(feature, cut, left, value / trees)


def grow(blocks: Blocks, m: int, p: ForestParams, local: int | None = None) -> tuple[list[ForestTree], np.ndarray]:
    """The forest of model ``m`` of the blocks, and its gains by feature, of each tree as shares of one."""
    lesson, missing = blocks.lessons[m], blocks.missing
    imputed = np.array([-1 if np.isnan(v) else int(_bin(np.array([v]), e)[0]) for v, e in zip(lesson.values, blocks.edges)])
    weights = np.array([lesson.weights.get(k, 1.0) for k in (0, 1)])
    local = local or min(max(blocks.rows // 12, LOCAL[0]), LOCAL[1])
    size = max(1, GROUP // max(1, blocks.rows))
    trees, gains = [], np.zeros(len(missing))
    for first in range(0, p.trees, size):
        opening = _Opened(m, lesson, missing, imputed, p, range(first, min(first + size, p.trees)), 0 if blocks.rows > local else -2)
        grown, gained = _group(blocks, opening, weights, local)
        trees += grown
        gains += (gained / np.maximum(gained.sum(axis=1, keepdims=True), 1e-300)).sum(axis=0)
    return trees, gains


def _group(blocks: Blocks, opening: _Opened, weights: np.ndarray, local: int) -> tuple[list[ForestTree], np.ndarray]:
    p, width, bins = opening.p, len(blocks.edges), int(blocks.missing.max()) + 1
    sc, growing = blocks.table.sparkSession.sparkContext, [_Growing(root_path(p, t)) for t in opening.trees]
    gained, said = np.zeros((len(growing), width)), []
    state, before = blocks.table.select("key", "label", "fold", "bins").rdd.mapPartitions(opening).persist(StorageLevel.MEMORY_AND_DISK), None
    if opening.start == -2:
        for tree in growing:
            tree.small, tree.opened = [(0, 0, tree.paths[0], blocks.rows)], []
    depth = 0
    while any(tree.opened for tree in growing):
        drawn = {t: drawn_features(tree.paths, width, p.tries) for t, tree in enumerate(growing) if tree.opened}
        told = sc.broadcast((drawn, bins))
        found = _gathered(state.mapPartitions(_Counted(told)), sum(v.size for v in drawn.values()) * bins * 16)
        told.destroy()
        if before:
            before.unpersist()
        splits = {t: growing[t].level(counts, drawn[t], weights, depth, local, p, gained[t]) for t, counts in found.items()}
        for t in drawn.keys() - found.keys():                   # no rows
            growing[t].opened = []
        short = all(np.abs(children).max() < SHORT for *_, children in splits.values())
        told, before = sc.broadcast((splits, short)), state
        said.append(told)                                       # a lost piece is worked out again
        state = before.mapPartitions(_Moved(told))
        if any(tree.opened for tree in growing):
            state.persist(StorageLevel.MEMORY_AND_DISK)
        depth += 1
    # Large nodes first, in turn over the partitions.
    nodes = sorted(((t, n) for t, tree in enumerate(growing) for n in range(len(tree.small))), key=lambda at: -growing[at[0]].small[at[1]][3])
    number = {at: i for i, at in enumerate(nodes)}
    numbers = {t: [number[t, n] for n in range(len(tree.small))] for t, tree in enumerate(growing) if tree.small}
    about = [(growing[t].small[n][1], growing[t].small[n][2:3]) for t, n in nodes]
    below: list[dict[int, tuple]] = [{} for _ in growing]
    if nodes:
        told = [sc.broadcast(numbers), sc.broadcast(([(d, np.array(path, dtype=np.uint64)) for d, path in about], width, bins, weights, p))]
        rows = sum(growing[t].small[n][3] for t, n in nodes)
        parts = min(len(nodes), max(4 * sc.defaultParallelism, rows // 2_000_000))
        sent = state.mapPartitions(_Sent(told[0])).groupByKey(parts, _itself)
        for i, (nodes_below, won) in sent.mapPartitions(_Finished(told[1])).collect():
            t, n = nodes[i]
            below[t][n] = nodes_below
            gained[t] += won
        said += told
    for kept in filter(None, (before, state)):
        kept.unpersist()
    for told in said:
        told.destroy()
    for tree, done in zip(growing, below):                      # a small node without rows: that of a tree whose sample is empty
        for n in range(len(tree.small)):
            done.setdefault(n, (np.array([-1]), np.array([0]), np.array([0]), np.array([0.0])))
    return [tree.whole(done, p.trees) for tree, done in zip(growing, below)], gained


def _itself(number: int) -> int:
    return number
