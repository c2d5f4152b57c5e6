"""Second-order gradient boosting on histograms, with all folds in the passes of one.

The rows are written once as blocks of binned features. A pass over the blocks adds up gradients, hessians and counts by (model, node,
feature, bin) in each task; the sums of a node meet in one place, where its best split is found, so that a few numbers a node come to the
driver. The models of k folds and of all rows are one more axis of these histograms: they grow side by side, in as many passes as
a single one takes. Rows of fold m take no part in model m; the same passes add up their loss, so early stopping costs no pass, and a model that
has stopped grows no further trees and is cut to its best round.

Missing values have a bin of their own, and each split learns which side they go to. Trees grow by levels, or with ``max_leaves`` by
the best leaf first. Scores are advanced every ``ADVANCE`` rounds into a newly written block table; between, a pass applies the last few trees.

A tree's size bounds what is broadcast and collected; a task holds one histogram a (model, open node). Rows without label, and those with a
weight that is not positive, teach nothing. A task reads few blocks, and some at a time, however large the table is. Draws of rows and columns follow a hash of (seed, round, model, id).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.session import materialise, settings

TASK_ROWS = 250_000        # of a file of blocks at most
READ = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8", "spark.sql.files.maxPartitionBytes": "32m"}     # a record is a block of thousands of rows
ADVANCE = 10               # rounds between two tables of scores
DIGITS = 9                 # of a gain that decide; what is equal up to them goes to the first feature and bin


@dataclass(frozen=True)
class BoostingParams:
    rounds: int = 50
    learning_rate: float = 0.1
    max_depth: int = 6
    max_leaves: int | None = None          # best leaf first, up to so many; by levels if absent
    l1: float = 0.0
    l2: float = 1.0
    max_delta_step: float = 0.0            # greatest leaf weight, 0 for any
    min_child_weight: float = 1.0          # hessian of a child
    min_rows: int = 1
    min_gain: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    bins: int = 64
    patience: int | None = None
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order of their making; ``feature`` is -1 in leaves."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, bin_: int, missing_left: bool, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.missing_left[node] = feature, bin_, missing_left
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for value in values:
            for column, entry in zip((self.feature, self.bin, self.missing_left, self.left, self.right, self.value, self.depth),
                                     (-1, 0, False, 0, 0, value, self.depth[node] + 1)):
                column.append(entry)
        return self.left[node], self.right[node]

    def nodes_of(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The leaf of each row of (rows, features), best with each feature's bins side by side in memory.

        A node looks at one column of its rows; the root takes them all, so a shallow tree costs a few comparisons a row.
        """
        place = np.zeros(len(bins), dtype=np.int64)
        waiting: list[tuple[int, np.ndarray | None]] = [(0, None)]
        while waiting:
            node, own = waiting.pop()
            f = self.feature[node]
            if f < 0:
                if own is None:
                    place[:] = node
                else:
                    place[own] = node
                continue
            value = bins[:, f] if own is None else bins[own, f]
            goes = value <= self.bin[node]
            if self.missing_left[node]:
                goes |= value == missing[f]
            else:
                goes &= value != missing[f]
            left, right = np.flatnonzero(goes), np.flatnonzero(~goes)
            for child, at in ((self.left[node], left), (self.right[node], right)):
                waiting.append((child, at if own is None else own[at]))
        return place

    def scores(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(bins, missing)]


def leaf_weight(g, h, p: BoostingParams):
    """The weight that lowers the second-order loss most, within the step limit."""
    weight = -np.sign(g) * np.maximum(np.abs(g) - p.l1, 0.0) / np.maximum(h + p.l2, 1e-12)
    return np.clip(weight, -p.max_delta_step, p.max_delta_step) if p.max_delta_step > 0 else weight


def leaf_score(g, h, p: BoostingParams):
    """Twice the fall of the penalised loss at the leaf's weight."""
    weight = leaf_weight(g, h, p)
    return -(2 * g * weight + (h + p.l2) * weight ** 2 + 2 * p.l1 * np.abs(weight))


def best_split(hist: np.ndarray, missing: np.ndarray, columns: np.ndarray, p: BoostingParams) -> tuple | None:
    """(gain, feature, bin, missing left, (g, h) left, (g, h) right) from (3, features, bins): gradients, hessians, counts."""
    whole = hist[:, columns[0], :].sum(axis=1)
    best = None
    for f in columns.tolist():
        lost = hist[:, f, missing[f]]
        known = np.cumsum(hist[:, f, :missing[f]], axis=1)
        for to_left in ((False, True) if lost[2] else (False,)):
            left = known + lost[:, None] if to_left else known
            right = whole[:, None] - left
            fits = ((left[1] >= p.min_child_weight) & (right[1] >= p.min_child_weight)
                    & (left[2] >= max(1, p.min_rows)) & (right[2] >= max(1, p.min_rows)))
            if not fits.any():
                continue
            gains = 0.5 * (leaf_score(left[0], left[1], p) + leaf_score(right[0], right[1], p) - leaf_score(whole[0], whole[1], p))
            gains = np.where(fits, np.round(gains, DIGITS), -np.inf)
            at = int(np.argmax(gains))
            if gains[at] > max(p.min_gain, 0.0) and (best is None or gains[at] > best[0]):
                best = (float(gains[at]), f, at, to_left, (float(left[0, at]), float(left[1, at])), (float(right[0, at]), float(right[1, at])))
    return best


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers of [0, 1) from 64-bit integers."""
    z = x.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def drawn_columns(n: int, p: BoostingParams, round_: int, model: int) -> np.ndarray:
    """The features of a tree, at least one."""
    order = np.argsort(_mixed(np.arange(n, dtype=np.int64), p.seed * 7 + round_ * 1009 + model * 9176 + 1), kind="stable")
    return np.sort(order[:max(1, round(n * p.column_share))])


def drawn_rows(keys: np.ndarray, p: BoostingParams, round_: int, model: int) -> np.ndarray:
    """``_mixed`` of the keys below the share, in whole numbers and in place."""
    z = np.ascontiguousarray(keys).view(np.uint64) + np.uint64(((p.seed * 13 + round_ * 7919 + model * 104729 + 2) * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    high = z >> np.uint64(30)
    z ^= high
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= np.right_shift(z, np.uint64(27), out=high)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= np.right_shift(z, np.uint64(31), out=high)
    z >>= np.uint64(11)
    return z < np.uint64(math.ceil(p.row_share * (1 << 53)))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: distinct quantiles, the last bin is open."""
    shares = [n / bins for n in range(1, bins)]
    found = df.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features]).approxQuantile(list(features), shares, 0.25 / bins)
    return [np.unique(np.array(q, dtype=np.float64)) for q in found]


def _binned(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """(rows, features) of bins; a missing value is in the bin after the last one."""
    out = np.empty((len(columns[0]), len(edges)), dtype=np.uint16)
    for f, (values, edge) in enumerate(zip(columns, edges)):
        out[:, f] = np.where(np.isnan(values), len(edge) + 1, np.searchsorted(edge, values, side="left"))
    return out


def _blocks(df: DataFrame, row_id: str, features: Sequence[str], label: str, weight: str | None, fold: str | None,
            edges: list[np.ndarray], n_models: int) -> DataFrame:
    kind, files = df.schema[row_id].dataType.simpleString(), -(-df.count() // TASK_ROWS)
    if files > df.rdd.getNumPartitions():
        df = df.repartition(files, row_id).sortWithinPartitions(row_id)
    rows = df.select(F.col(row_id).alias("id"), F.xxhash64(row_id).alias("key"), F.col(label).cast("double").alias("label"),
                     (F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)).alias("weight"),
                     (F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)).alias("fold"),
                     *[F.col(f"`{f}`").cast("double").alias(f"f{n}") for n, f in enumerate(features)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(f"f{n}").to_numpy(zero_copy_only=False).astype(np.float64) for n in range(len(edges))]
            plain = [batch.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in (("key", "<i8"), ("label", "<f8"), ("weight", "<f8"), ("fold", "<i4"))]
            cells = [pa.array([batch.column("id").to_pylist()], pa.list_(batch.schema.field("id").type)),
                     *(pa.array([x.tobytes()], pa.binary()) for x in (*plain, _binned(values, edges), np.zeros((batch.num_rows, n_models))))]
            yield pa.RecordBatch.from_arrays(cells, names=["ids", "key", "label", "weight", "fold", "bins", "margins"])

    return materialise(rows.mapInArrow(
        work, f"ids array<{kind}>, key binary, label binary, weight binary, fold binary, bins binary, margins binary"), "blocks")


@dataclass
class _Block:
    key: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    bins: np.ndarray
    margins: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, row: int, n_models: int) -> _Block:
        raw = {c: batch.column(c)[row].as_py() for c in ("key", "label", "weight", "fold", "bins", "margins")}
        key = np.frombuffer(raw["key"], "<i8")
        return cls(key, np.frombuffer(raw["label"], "<f8"), np.frombuffer(raw["weight"], "<f8"), np.frombuffer(raw["fold"], "<i4"),
                   np.asfortranarray(np.frombuffer(raw["bins"], np.uint16).reshape(len(key), -1)), np.frombuffer(raw["margins"], "<f8").reshape(len(key), n_models))

    def margin(self, model: int, trees: list[Tree], missing: np.ndarray) -> np.ndarray:
        out = self.margins[:, model].copy()
        for tree in trees:
            out += tree.scores(self.bins, missing)
        return out


def _pass(blocks: DataFrame, trees: list[list[Tree]], growing: dict[int, Tree], open_nodes: dict[int, list[int]], round_: int,
          missing: np.ndarray, n_folds: int, p: BoostingParams, with_loss: bool) -> tuple[dict, dict]:
    """Best splits {(model, node): (split, g, h)} of the open nodes, and the losses {model: (loss, weight)} of held-out rows."""
    n_models, width, n_bins = len(trees), len(missing), int(missing.max()) + 1
    schema = "model int, node int, sums binary"
    target = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(m, n): np.zeros((3, width, n_bins)) for m, nodes in open_nodes.items() for n in nodes}
        losses, columns = np.zeros((n_models, 2)), {m: drawn_columns(width, p, round_, m).tolist() for m in open_nodes}
        for batch in batches:
            for row in range(batch.num_rows):
                block = _Block.of(batch, row, n_models)
                known = (block.weight > 0) & ~np.isnan(block.label)
                for m, nodes in open_nodes.items():
                    margin = block.margin(m, trees[m], missing)
                    chance = 1 / (1 + np.exp(-margin))
                    if with_loss and m < n_folds:
                        out = known & (block.fold == m)
                        losses[m] += ((np.logaddexp(0, margin[out]) - block.label[out] * margin[out]) * block.weight[out]).sum(), block.weight[out].sum()
                    place = growing[m].nodes_of(block.bins, missing)
                    used = known & ((block.fold != m) | (m == n_folds)) & drawn_rows(block.key, p, round_, m)
                    gradient, hessian = block.weight * (chance - block.label), block.weight * chance * (1 - chance)
                    for n in nodes:
                        own = np.flatnonzero(used & (place == n))
                        if not len(own):
                            continue
                        total, g, h = sums[m, n], gradient[own], hessian[own]
                        for f in columns[m]:
                            at = block.bins[own, f].astype(np.intp)
                            total[0, f] += np.bincount(at, g, n_bins)
                            total[1, f] += np.bincount(at, h, n_bins)
                            total[2, f] += np.bincount(at, minlength=n_bins)
        rows = [(m, n, s.tobytes()) for (m, n), s in sums.items() if s[2].any()]
        rows += [(m, -1, s.tobytes()) for m, s in enumerate(losses) if s[1]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), target.types)], schema=target)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for m, n, raw in zip(*(batch.column(c).to_pylist() for c in ("model", "node", "sums"))):
                part = np.frombuffer(raw, "<f8")
                found[m, n] = found[m, n] + part if (m, n) in found else part
        rows = []
        for (m, n), s in found.items():
            if n < 0:
                rows.append((m, n, None, None, None, None, s.tolist()))
                continue
            hist, columns = s.reshape(3, width, n_bins), drawn_columns(width, p, round_, m)
            split = best_split(hist, missing, columns, p)
            g, h = hist[:2, columns[0]].sum(axis=1)
            rows.append((m, n, *(split[:4] if split else (None,) * 4), [g, h, *(split[4] + split[5] if split else ())]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), chosen.types)], schema=chosen)

    chosen = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()),
                        ("missing_left", pa.bool_()), ("numbers", pa.list_(pa.float64()))])
    parts = blocks.select("key", "label", "weight", "fold", "bins", "margins").mapInArrow(add, schema)
    with settings(blocks.sparkSession, READ):
        result = parts.repartition("model", "node").mapInArrow(
            choose, "model int, node int, gain double, feature int, bin int, missing_left boolean, numbers array<double>").collect()
    splits = {(r["model"], r["node"]): r for r in result if r["node"] >= 0}       # a row per open node
    return splits, {r["model"]: tuple(r["numbers"]) for r in result if r["node"] < 0}


def _advanced(blocks: DataFrame, trees: list[list[Tree]], missing: np.ndarray) -> DataFrame:
    """The blocks with the scores of ``trees`` added."""
    n_models, kind = len(trees), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for row in range(batch.num_rows):
                block = _Block.of(batch, row, n_models)
                margins.append(np.stack([block.margin(m, t, missing) for m, t in enumerate(trees)], axis=1).tobytes())
            at = batch.schema.get_field_index("margins")
            yield batch.set_column(at, "margins", pa.array(margins, pa.binary()))

    with settings(blocks.sparkSession, READ):
        return materialise(blocks.mapInArrow(work, kind), "blocks")


@dataclass
class Boosted:
    """Trees of the models of all folds, the model of all rows last."""

    features: list[str]
    edges: list[np.ndarray]
    trees: list[list[Tree]]
    params: BoostingParams
    losses: list[list[float]]              # held-out loss of each fold's model after 0, 1, ... rounds

    @property
    def missing(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges])

    def score(self, df: DataFrame, score: str = "score", fold: str | None = None) -> DataFrame:
        """``df`` with the probability by the model of all rows, or with ``fold`` by the model that has not seen the row's fold."""
        edges, trees, missing, n_folds = self.edges, self.trees, self.missing, len(self.trees) - 1
        kept = [f for f in df.schema if f.name != score]
        given = df.select(*[F.col(f"`{f.name}`") for f in kept], F.array(*[F.col(f"`{c}`").cast("double") for c in self.features]).alias("__values"),
                          (F.coalesce(F.col(fold).cast("int"), F.lit(n_folds)) if fold else F.lit(n_folds)).alias("__model"))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column("__values").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(edges))
                bins, model = _binned(list(values.T), edges), batch.column("__model").to_numpy(zero_copy_only=False)
                out = np.zeros(batch.num_rows)
                for m in np.unique(model).tolist():
                    own = np.flatnonzero(model == m)
                    margin = sum((t.scores(bins[own], missing) for t in trees[m if 0 <= m < n_folds else n_folds]), np.zeros(len(own)))
                    out[own] = 1 / (1 + np.exp(-margin))
                rest = batch.select([f.name for f in kept])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(out)], schema=rest.schema.append(pa.field(score, pa.float64())))

        return given.mapInArrow(work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{score}` double")

    def importances(self) -> dict[str, int]:
        """Splits by feature in the model of all rows."""
        counts = np.bincount([f for t in self.trees[-1] for f in t.feature if f >= 0], minlength=len(self.features))
        return dict(zip(self.features, counts.tolist()))


def _grow(blocks: DataFrame, trees: list[list[Tree]], active: list[int], round_: int, missing: np.ndarray, n_folds: int,
          p: BoostingParams) -> tuple[dict[int, Tree], dict]:
    """One tree for each active model, and the held-out losses before it."""
    growing, queues, losses = {m: Tree() for m in active}, {m: [] for m in active}, {}
    opened = {m: [0] for m in active}
    leaves = {m: 1 for m in active}
    first = True
    while opened:
        splits, found = _pass(blocks, trees, growing, opened, round_, missing, n_folds, p, with_loss=first and n_folds > 0)
        losses, first = found or losses, False
        for (m, node), r in splits.items():
            if node == 0:
                growing[m].value[0] = p.learning_rate * float(leaf_weight(*r["numbers"][:2], p))
            if r["gain"] is not None and growing[m].depth[node] < p.max_depth:
                heapq.heappush(queues[m], (-r["gain"], node, r["feature"], r["bin"], r["missing_left"], r["numbers"][2:]))
        opened = {}
        for m, queue in queues.items():
            while queue and (p.max_leaves is None or leaves[m] < p.max_leaves):
                _, node, feature, bin_, to_left, (lg, lh, rg, rh) = heapq.heappop(queue)
                values = tuple(p.learning_rate * float(leaf_weight(g, h, p)) for g, h in ((lg, lh), (rg, rh)))
                opened.setdefault(m, []).extend(growing[m].split(node, feature, bin_, to_left, values))
                leaves[m] += 1
                if p.max_leaves is not None:
                    break                            # the children may be better than what waits
            if p.max_leaves is not None and leaves[m] >= p.max_leaves:
                opened.pop(m, None)                  # no leaf will be split any more
            elif m in opened:
                opened[m] = [n for n in opened[m] if growing[m].depth[n] < p.max_depth]
                if not opened[m] and not (queue and p.max_leaves is not None):
                    del opened[m]
    return growing, losses


def boost(df: DataFrame, features: Sequence[str], label: str, params: BoostingParams = BoostingParams(), row_id: str = "transaction_id",
          weight: str | None = None, fold: str | None = None, n_folds: int = 0, edges: list[np.ndarray] | None = None) -> Boosted:
    """Models of all folds (rows whose ``fold`` is m take no part in model m) and of all rows, by one sequence of passes.

    With ``patience`` a fold's model stops as its held-out loss does, and is cut to its best round; the model of all
    rows takes the mean of the folds' rounds.
    """
    p, features = params, list(features)
    edges = bin_edges(df, features, p.bins) if edges is None else edges
    missing = np.array([len(e) + 1 for e in edges])
    blocks = _blocks(df, row_id, features, label, weight, fold, edges, n_folds + 1)
    whole: list[list[Tree]] = [[] for _ in range(n_folds + 1)]
    recent: list[list[Tree]] = [[] for _ in range(n_folds + 1)]
    losses: list[list[float]] = [[] for _ in range(n_folds)]
    active = list(range(n_folds + 1))
    for round_ in range(p.rounds):
        grown, found = _grow(blocks, recent, active, round_, missing, n_folds, p)
        for m, (loss, total) in found.items():
            losses[m].append(loss / total)
        stopped = [m for m in active if m < n_folds and p.patience and losses[m]
                   and len(losses[m]) - 1 - int(np.argmin(losses[m])) >= p.patience]
        active = [m for m in active if m not in stopped]
        for m in active:
            whole[m].append(grown[m])
            recent[m].append(grown[m])
        if not active or (p.patience and n_folds and active == [n_folds] and round_ + 1 >= _mean_rounds(losses)):
            break
        if (round_ + 1) % ADVANCE == 0:
            blocks, recent = _advanced(blocks, recent, missing), [[] for _ in range(n_folds + 1)]
    late = [m for m in active if m < n_folds]
    if p.patience and late:                          # what the last trees of those that never stopped are worth
        _, found = _pass(blocks, recent, {m: Tree() for m in late}, {m: [] for m in late}, p.rounds, missing, n_folds, p, with_loss=True)
        for m, (loss, total) in found.items():
            losses[m].append(loss / total)
    if p.patience and n_folds:
        whole = [t[:max(1, int(np.argmin(losses[m])))] if m < n_folds and losses[m] else t for m, t in enumerate(whole)]
        whole[-1] = whole[-1][:_mean_rounds(losses)]
    return Boosted(features, edges, whole, replace(p), losses)


def _mean_rounds(losses: list[list[float]]) -> int:
    return max(1, round(float(np.mean([max(1, int(np.argmin(x))) for x in losses if x] or [1]))))
