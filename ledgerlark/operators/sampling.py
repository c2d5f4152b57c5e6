"""Exact, deterministic samples, splits and folds.

Rows are ordered by ``(hash(id, seed), id, hash of the whole row)``. A quota is turned into the order's cut-off
row: bins of the order are counted map-side and narrowed until a few distinct keys are left, and the selection is a
row-wise comparison with literals. No row is shuffled to be sampled, and sizes are exact at any scale, also with
missing or repeated ids: rows that share an id are told apart by their content, and of rows that are equal in
every column the wanted number is made anew from one of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.functions.hashing import HASH_BITS, order_hash

BIN_BITS = 14
MERGERS = 16             # tasks that merge the parts' first rows
FETCH = 5_000            # distinct keys read from the bins that hold a cut-off
_HASH, _ID, _ROW = "_order_hash", "_order_id", "_order_row"


@dataclass(frozen=True)
class CutOff:
    """The row at 1-based ``rank`` of a stratum: its key, and which of the ``tied`` rows with that key it is."""

    stratum: object
    rank: int
    hash: int
    row_id: object
    row: int
    taken: int = 1
    tied: int = 1


@dataclass(frozen=True)
class HashOrder:
    """The order rows are drawn in. Without the id column, rows are drawn by their content."""

    row_id: str = "transaction_id"
    seed: int = 42
    method: str = "xxhash64"

    def hash(self) -> Column:
        return order_hash(F.col(self.row_id), self.seed, self.method)

    def keyed(self, df: DataFrame) -> DataFrame:
        """``df`` with the key as columns, computed once however often it is compared."""
        content = F.xxhash64(*[F.col(f"`{f.name}`") for f in sorted(df.schema, key=lambda f: f.name)
                               if "map<" not in f.dataType.simpleString()])
        if self.row_id not in df.columns:
            return df.withColumn(_ROW, content).withColumns(
                {_HASH: order_hash(F.col(_ROW), self.seed, self.method), _ID: F.lit(None).cast("long")})
        return df.withColumns({_HASH: self.hash(), _ID: F.col(self.row_id), _ROW: content})

    def after(self, cut: CutOff) -> Column:
        """True for rows of a keyed frame later than the cut-off's key; rows without id come last."""
        same_hash = F.col(_HASH) == cut.hash
        same_id = F.col(_ID).eqNullSafe(F.lit(cut.row_id))
        later_id = F.lit(False) if cut.row_id is None else F.coalesce(F.col(_ID) > F.lit(cut.row_id), F.lit(True))
        return (F.col(_HASH) > cut.hash) | (same_hash & (later_id | (same_id & (F.col(_ROW) > cut.row))))

    def at(self, cut: CutOff) -> Column:
        """True for the rows with the cut-off's key."""
        return (F.col(_HASH) == cut.hash) & F.col(_ID).eqNullSafe(F.lit(cut.row_id)) & (F.col(_ROW) == cut.row)


def stratum_sizes(df: DataFrame, stratum: str | None) -> dict[object, int]:
    key = F.col(stratum) if stratum else F.lit(0)
    return {r["s"]: r["count"] for r in df.groupBy(key.alias("s")).count().collect()}


@dataclass
class _Search:
    stratum: object
    rank: int
    left: int              # rank among the rows that are still inside
    size: int
    digits: tuple = ()


def _digits(bin_bits: int) -> list[Column]:
    """The key as digits of few values each, most significant first."""
    low = HASH_BITS - bin_bits
    half = (low + 1) // 2
    row = F.col(_ROW)
    return [F.shiftright(_HASH, low), F.shiftright(_HASH, low - half).bitwiseAND((1 << half) - 1),
            F.col(_HASH).bitwiseAND((1 << (low - half)) - 1), F.col(_ID), F.shiftright(row, 51),
            *[F.shiftright(row, n).bitwiseAND((1 << 13) - 1) for n in (38, 25, 12)], row.bitwiseAND((1 << 12) - 1)]


def _position(found: list[tuple[object, int]], left: int) -> tuple[object, int, int]:
    """The digit that holds the row ``left``, its rank there, and the digit's rows."""
    for digit, n in sorted(found, key=lambda f: (f[0] is None, f[0] if f[0] is not None else 0)):
        if left <= n:
            return digit, left, n
        left -= n
    raise ValueError("the rows changed between two reads; write the table before sampling from it")


def cut_offs(df: DataFrame, order: HashOrder, stratum: str | None,
             ranks: Callable[[dict[object, int]], dict[object, list[int]]],
             bin_bits: int = BIN_BITS, fetch: int = FETCH) -> list[CutOff]:
    """Find the rows at the given ranks of each stratum (a label column of few values; missing labels are one).

    ``ranks`` maps the stratum sizes to the 1-based ranks wanted; out-of-range ranks are skipped.
    """
    keyed = order.keyed(df).select((F.col(stratum) if stratum else F.lit(0)).alias("s"), _HASH, _ID, _ROW)
    digits = _digits(bin_bits)
    bins: dict[object, list[tuple[int, int]]] = {}
    for r in keyed.groupBy("s", digits[0].alias("b")).count().collect():
        bins.setdefault(r["s"], []).append((r["b"], r["count"]))
    sizes = {s: sum(n for _, n in found) for s, found in bins.items()}
    searches = []
    for s, targets in ranks(sizes).items():
        for rank in sorted(t for t in set(targets) if 1 <= t <= sizes.get(s, 0)):
            digit, left, size = _position(bins[s], rank)
            searches.append(_Search(s, rank, left, size, (digit,)))

    def inside(prefix: tuple) -> Column:
        test = F.col("s").eqNullSafe(F.lit(prefix[0]))
        for column, digit in zip(digits, prefix[1]):
            test = test & column.eqNullSafe(F.lit(digit))
        return test

    def prefixes(some: list[_Search]) -> list[tuple]:
        return list(dict.fromkeys((x.stratum, x.digits) for x in some))

    def tagged(some: list[tuple]) -> DataFrame:
        number = F.coalesce(*[F.when(inside(p), n) for n, p in enumerate(some)])
        return keyed.withColumn("p", number).filter(F.col("p").isNotNull())

    depth, going, cuts = 1, searches, []
    while going:
        small = [p for p in prefixes(going) if next(x.size for x in going if (x.stratum, x.digits) == p) <= fetch or depth == len(digits)]
        if small:
            rows = tagged(small).groupBy("p", _HASH, _ID, _ROW).count().orderBy("p", _HASH, F.col(_ID).asc_nulls_last(), _ROW).collect()
            for x in [x for x in going if (x.stratum, x.digits) in small]:
                left = x.left
                for r in (r for r in rows if small[r["p"]] == (x.stratum, x.digits)):
                    if left <= r["count"]:
                        cuts.append(CutOff(x.stratum, x.rank, r[_HASH], r[_ID], r[_ROW], left, r["count"]))
                        break
                    left -= r["count"]
                else:
                    raise ValueError("the rows changed between two reads; write the table before sampling from it")
        going = [x for x in going if (x.stratum, x.digits) not in small]
        if going:
            wanted = prefixes(going)
            found: dict[tuple, list] = {}
            for r in tagged(wanted).groupBy("p", digits[depth].alias("b")).count().collect():
                found.setdefault(wanted[r["p"]], []).append((r["b"], r["count"]))
            for x in going:
                digit, x.left, x.size = _position(found[x.stratum, x.digits], x.left)
                x.digits = (*x.digits, digit)
            depth += 1
    return sorted(cuts, key=lambda c: (str(c.stratum), c.rank))


def _numbered(rows: DataFrame, order: HashOrder, cuts: list[CutOff], label: str | None, name: str) -> DataFrame:
    """``rows`` with the number of their stratum's cut-offs that they lie behind.

    The rows with a split key are equal in all columns; one of them is repeated as often as it was there.
    """
    def mine(cut: CutOff) -> Column:
        return F.col(label).eqNullSafe(F.lit(cut.stratum)) if label else F.lit(True)

    keyed = order.keyed(rows)
    passed = sum(((mine(c) & order.after(c)).cast("int") for c in cuts), F.lit(0))
    split: dict[tuple, list[CutOff]] = {}
    for c in cuts:
        if c.taken < c.tied:
            split.setdefault((c.stratum, c.hash, c.row_id, c.row), []).append(c)
    plain = keyed
    for own in split.values():
        plain = plain.filter(~(mine(own[0]) & order.at(own[0])))
    out = plain.withColumn(name, passed)
    for own in split.values():
        first = own[0]
        one = keyed.filter(mine(first) & order.at(first)).limit(1).withColumn("_one", F.lit(1))
        # Cut-offs whose key is smaller, or equal and wholly before, are passed by every one of these rows.
        behind = [c for c in cuts if c.stratum == first.stratum and c.rank < min(o.rank for o in own)]
        numbers = rows.sparkSession.range(first.tied).select(F.lit(1).alias("_one"), (F.col("id") + 1).alias("_nth"))
        again = numbers.join(F.broadcast(one), "_one").withColumn(                  # a single row
            name, F.lit(len(behind)) + sum(((F.col("_nth") > c.taken).cast("int") for c in own), F.lit(0)))
        out = out.unionByName(again.drop("_one", "_nth"))
    return out.drop(_HASH, _ID, _ROW)


def take(df: DataFrame, n: int, order: HashOrder = HashOrder()) -> DataFrame:
    """A uniform sample of exactly ``n`` rows without replacement (all rows when there are fewer)."""
    cuts = cut_offs(df, order, None, lambda sizes: {0: [n]}) if n > 0 else []
    if cuts:
        return _numbered(df, order, cuts, None, "_passed").filter("_passed = 0").drop("_passed")
    return df if n > 0 else df.limit(0)


def take_once(df: DataFrame, n: int, order: HashOrder = HashOrder()) -> DataFrame:
    """The rows of ``take`` from one pass over ``df``, whose size need not be known.

    A task keeps the first ``n`` rows of the order that it has met, at most twice as many for a while; these are merged in ``MERGERS`` tasks and
    then in one. Samples can be merged again: the sample of a sample and further rows is the sample of all, see ``SampleStream``.
    """
    keyed = order.keyed(df)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        waiting, size = [], 0

        def cut() -> pa.Table:
            table = pa.Table.from_batches(waiting)
            table = pa.concat_tables([held, table]) if held is not None else table
            places = pc.sort_indices(table.select([_HASH, _ID, _ROW]), [(c, "ascending") for c in (_HASH, _ID, _ROW)], null_placement="at_end")
            return table.take(places[:n]).combine_chunks()

        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= max(n, 1):
                held, waiting, size = cut(), [], 0
        if waiting:
            held = cut()
        if held is not None:
            yield from held.to_batches(10_000)

    if n <= 0:
        return df.limit(0)
    parts = keyed.mapInArrow(first, kinds)
    merged = parts.repartition(MERGERS, F.xxhash64(_HASH, _ROW)).mapInArrow(first, kinds)
    return merged.repartition(1).mapInArrow(first, kinds).drop(_HASH, _ID, _ROW)


@dataclass
class SampleStream:
    """A uniform sample of ``n`` of all rows that a stream has had so far, one table per batch below ``path``."""

    path: str
    n: int
    order: HashOrder = HashOrder()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            batch = batch.unionByName(batch.sparkSession.read.schema(batch.schema).parquet(f"{self.path}/{batch_id - 1}"))
        take_once(batch, self.n, self.order).write.mode("overwrite").parquet(f"{self.path}/{batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()


def allocate(sizes: dict[object, int], total: int) -> dict[object, int]:
    """Share ``total`` over strata in proportion, leftovers to the largest remainders."""
    n = sum(sizes.values())
    exact = {s: total * c / n for s, c in sizes.items()}
    quota = {s: math.floor(x) for s, x in exact.items()}
    left = total - sum(quota.values())
    for s in sorted(sizes, key=lambda s: (quota[s] - exact[s], str(s)))[:left]:
        quota[s] += 1
    return quota


def mark_split(df: DataFrame, fraction: float, label: str = "is_fraud", order: HashOrder = HashOrder(),
               name: str = "is_test") -> DataFrame:
    """Flag ``fraction`` of the rows, stratified by label: the hold-out of a train/test split.

    The flagged total is ``ceil(n * fraction)``; each label keeps its share of the other part. Rows without a
    label are a stratum of their own.
    """
    quota: dict[object, int] = {}

    def kept(sizes):
        quota.update(allocate(sizes, sum(sizes.values()) - math.ceil(sum(sizes.values()) * fraction)) if sizes else {})
        return {s: [k] for s, k in quota.items()}

    cuts = cut_offs(df, order, label, kept)
    empty = F.lit(False)       # strata of which nothing is kept have no cut-off
    for s in (s for s, k in quota.items() if k == 0):
        empty = empty | F.col(label).eqNullSafe(F.lit(s))
    marked = _numbered(df, order, cuts, label, "_passed")
    return marked.withColumn(name, (F.col("_passed") > 0) | empty).drop("_passed")


def stratified_split(df: DataFrame, fraction: float, label: str = "is_fraud",
                     order: HashOrder = HashOrder()) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, fraction, label, order, "_held_out")
    return (marked.filter(~F.col("_held_out")).drop("_held_out"),
            marked.filter("_held_out").drop("_held_out"))


def mark_folds(df: DataFrame, k: int, label: str = "is_fraud", order: HashOrder = HashOrder(),
               name: str = "fold") -> DataFrame:
    """Stratified K folds numbered from 0: per label, fold sizes differ by at most one.

    A label of fewer rows than folds fills the first folds. Rows without a label are a stratum of their own.
    """
    def ends(sizes):
        out = {}
        for s, n in sizes.items():
            size, extra = divmod(n, k)
            out[s] = [(i + 1) * size + min(i + 1, extra) for i in range(k - 1)]
        return out

    return _numbered(df, order, cut_offs(df, order, label, ends), label, name)


def downsample_negatives(df: DataFrame, ratio: float, label: str = "is_fraud",
                         order: HashOrder = HashOrder()) -> DataFrame:
    """Keep all positives and ``min(neg, int(max(neg * ratio, pos)))`` negatives.

    A ratio outside (0, 1), or no negatives, changes nothing.
    """
    if not 0 < ratio < 1:
        return df

    def quota(sizes):
        negatives, positives = sizes.get(0, 0), sizes.get(1, 0)
        return {0: [min(negatives, int(max(negatives * ratio, positives)))]}

    labelled = df.filter(F.col(label).isin(0, 1))
    cuts = cut_offs(labelled, order, label, quota)
    if not cuts:
        return df
    return _numbered(labelled, order, cuts, label, "_passed").filter("_passed = 0").drop("_passed")


def shuffled(df: DataFrame, order: HashOrder = HashOrder()) -> DataFrame:
    """Random row order, spread evenly: a range sort by the hash."""
    return order.keyed(df).orderBy(_HASH, _ID, _ROW).drop(_HASH, _ID, _ROW)


def most_recent(df: DataFrame, n: int, column: str = "transaction_time",
                order: HashOrder = HashOrder(), small: int | None = None) -> DataFrame:
    """The ``n`` latest rows, unsorted. Ties at the oldest kept time are drawn in hash order.

    The oldest kept time is found as an order statistic, so no task holds the ``n`` rows.
    """
    from ledgerlark.operators.orderstats import SMALL, order_statistics

    micros = F.unix_micros(F.col(column))
    timed = df.filter(F.col(column).isNotNull())
    keyed = timed.select(micros.alias("t"))
    total = keyed.count()
    if total <= n:
        return timed
    oldest = order_statistics(keyed, {"t": [total - n]}, small or SMALL, counts={"t": total})["t"][total - n]
    edge = F.timestamp_micros(F.lit(oldest))
    later, tied = timed.filter(F.col(column) > edge), timed.filter(F.col(column) == edge)
    counted = keyed.agg(F.count_if(F.col("t") > oldest).alias("later"),
                        F.count_if(F.col("t") == oldest).alias("tied")).first()
    if counted["later"] + counted["tied"] == n:
        return timed.filter(F.col(column) >= edge)
    return later.unionByName(take(tied, n - counted["later"], order))


# --- imbalance weights ----------------------------------------------------------------------

def class_weights(form: str, negatives: int, positives: int, configured: float = 1.0) -> dict[int, float]:
    """Weights by label: ``scale_pos`` (at least the configured value), ``ratio_floor`` (at least 1),
    ``ratio``, ``balanced``."""
    ratio = negatives / positives if positives else 1.0
    if form == "scale_pos":
        return {0: 1.0, 1: max(configured, ratio) if positives else configured}
    if form == "ratio_floor":
        return {0: 1.0, 1: max(1.0, ratio)}
    if form == "ratio":
        return {0: 1.0, 1: ratio}
    if form == "balanced":
        total = negatives + positives
        return {0: total / (2 * negatives) if negatives else 1.0,
                1: total / (2 * positives) if positives else 1.0}
    if form == "none":
        return {0: 1.0, 1: 1.0}
    raise ValueError(f"unknown weight form: {form}")


def add_class_weight(df: DataFrame, weights: dict[int, float], label: str = "is_fraud",
                     name: str = "class_weight") -> DataFrame:
    column = F.lit(1.0)
    for value, weight in weights.items():
        column = F.when(F.col(label) == value, F.lit(float(weight))).otherwise(column)
    return df.withColumn(name, column)
