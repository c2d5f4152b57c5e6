"""Trie of conversation prefixes in minimal-perfect-hash node tables (operator 13).

1. A turn becomes a 128-bit digest of role and text; from here on no text moves. Turns get their positions by a range sort on
   (conversation, turn); a conversation that spans several ranges takes its offset from a table of at most one row per range.
2. The digest of a prefix is the sum, in two 64-bit lanes, of hashes of (position, turn). Sums are made per segment of
   ``SEGMENT`` turns and shifted by those of earlier segments, so a conversation of any length is split.
3. A first pass over the rows builds node tables: a shard of bounded size enumerates its distinct digests, gives each a slot by a minimal
   perfect hash, verified against the stored digests, and scatters its members into flat arrays (members, smallest member, whether one goes on).
   Shards are merged by digest, so a node that a third of all conversations share is combined before it is shuffled.
4. What a node adds to its ancestors is attached to one row, that of its smallest member. A second pass takes whole segments of conversations into
   shards with slots for all their prefixes and accumulates through parent slots, deepest nodes first. Partial sums are added by digest.
5. The ids that end in a node are range-sorted; nodes inside a range are hashed there, those at the edges of ranges
   from pieces of text. SHA-256 is sequential by definition: one task streams the pieces of a node, with bounded memory.

Defined cases. Turns are ordered with null first; equal ones by digest. A null role or text is empty. Rows without a conversation
id belong to no conversation. Repeated rows are turns of their own. Texts of any length count by their UTF-8 bytes. An empty table has no conversation,
hence no node, not even the root. Only the four named columns are read, so further ones cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.session import materialise

from .batches import record, slices
from .wordhash import mix

SEGMENT = 1 << 16          # turns of a conversation that stay together
SHARD_ROWS = 1 << 20       # rows of a node table; a single segment may hold more
PIECE = 1 << 16            # ids of an end list held at once
HEAD_TURNS = 8             # the most turns that a rebuilt conversation takes from another one

_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


class NodeTable:
    """A minimal perfect hash of distinct 128-bit digests: n of them have the slots 0 to n-1.

    Level by level, digests that meet no other one at their place stay there, the rest go on to the next level; the
    slot is the rank of the place among all taken ones. ``slots`` compares with the stored digest, so an unknown digest has slot -1.
    """

    LEVELS = 64

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.before: list[int] = []
        self.first, self.second = np.empty_like(first), np.empty_like(second)
        rest, taken = np.arange(len(first)), 0
        while len(rest):
            if len(self.levels) == self.LEVELS:
                raise ValueError("digests of a node table are not distinct")
            size = 2 * len(rest)
            places = self._places(first[rest], second[rest], len(self.levels), size)
            alone = np.bincount(places, minlength=size) == 1
            ranks = np.where(alone, np.cumsum(alone) - 1, -1)
            stay = alone[places]
            own = taken + ranks[places[stay]]
            self.first[own], self.second[own] = first[rest[stay]], second[rest[stay]]
            self.levels.append(ranks)
            self.before.append(taken)
            taken, rest = taken + int(stay.sum()), rest[~stay]

    @staticmethod
    def _places(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1)
        return (mix(first ^ mix(second + seed)) % np.uint64(size)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.first)

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found = np.full(len(first), -1, dtype=np.int64)
        rest = np.arange(len(first))
        for level, (ranks, before) in enumerate(zip(self.levels, self.before)):
            if not len(rest):
                break
            at = ranks[self._places(first[rest], second[rest], level, len(ranks))]
            held = at >= 0
            found[rest[held]] = at[held] + before
            rest = rest[~held]
        known = np.flatnonzero(found >= 0)
        wrong = (self.first[found[known]] != first[known]) | (self.second[found[known]] != second[known])
        found[known[wrong]] = -1
        return found

    @classmethod
    def enumerate(cls, first: np.ndarray, second: np.ndarray) -> tuple["NodeTable", np.ndarray]:
        """The table of the distinct ones among the digests, and the slot of each."""
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, dtype=bool)
        table = cls(a[new], b[new])
        return table, table.slots(first, second)


def turn_digests(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, t1, t2, size): digest and bytes of the text of every turn of a conversation."""
    rows = df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target = pa.schema([("conv", pa.int64()), batch.schema.field("turn"), ("t1", pa.int64()), ("t2", pa.int64()), ("size", pa.int64())])
            for part in slices(batch, "text"):
                digests, sizes = [], []
                for who, what in zip(part.column("role").to_pylist(), part.column("text").to_pylist()):
                    who, what = (who or "").encode(), (what or "").encode()
                    digests.append(hashlib.blake2b(len(who).to_bytes(8, "little") + who + what, digest_size=16).digest())
                    sizes.append(len(what))
                halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                yield record(target, part.column("conv"), part.column("turn"), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), sizes)

    return rows.mapInArrow(work, f"conv long, turn {rows.schema['turn'].dataType.simpleString()}, t1 long, t2 long, size long")


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where rows begin whose keys differ from those before; the first one included."""
    differs = np.zeros(max(0, len(keys[0]) - 1), dtype=bool)
    for key in keys:
        differs |= key[1:] != key[:-1]
    return np.concatenate(([0], np.flatnonzero(differs) + 1))


def positions(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, t1, t2, size) of each turn, positions from 1, and (conv, n) of each conversation."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    ranged = materialise(turns, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = pa.schema([("conv", pa.int64()), ("range", pa.int32()), ("at", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("size", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            starts = _runs(conv)
            at = np.arange(1, len(conv) + 1) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if conv[0] == last:
                at[:starts[1] if len(starts) > 1 else len(at)] += count
            last, count = conv[-1], int(at[-1])
            yield record(schema, batch.column("conv"), pa.array(np.full(len(conv), number, dtype=np.int32)), pa.array(at),
                         batch.column("t1"), batch.column("t2"), batch.column("size"))

    ranges = materialise(ranged.mapInArrow(work, "conv long, range int, at long, t1 long, t2 long, size long"), "turn-ranges")
    spans = materialise(ranges.groupBy("conv", "range").agg(F.max("at").alias("n")), "turn-spans")
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a range can have begun in an earlier one: at most a row per range.
    offsets = spans.select("conv", "range", F.sum("n").over(before).alias("offset")).filter("offset > 0")
    placed = ranges.join(F.broadcast(offsets), ["conv", "range"], "left").select(
        "conv", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("pos"), "t1", "t2", "size")
    return placed, spans.groupBy("conv").agg(F.sum("n").alias("n"))


def _with_roots(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return rows.unionAll(lengths.select("conv", "len", zero.alias("pos"), zero.alias("t1"), zero.alias("t2"), zero.alias("size")))


def plain_rows(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, len, pos, t1, t2, size) of conversations as they are, with a row of position 0 for each."""
    lengths = convs.withColumnRenamed("n", "len")
    return _with_roots(placed.join(lengths.hint("merge"), "conv").select("conv", "len", "pos", "t1", "t2", "size"), lengths)


def rebuilt_rows(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """The same of conversations whose first h turns come from conversation c - c % 5, h = crc32(c) % 9."""
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = convs.withColumns({"base": F.col("conv") - F.col("conv") % 5, "h": F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % (HEAD_TURNS + 1)})
    plan = plan.join(base.hint("merge"), "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = materialise(plan.withColumn("len", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt-plan")
    heads = placed.filter(F.col("pos") <= HEAD_TURNS).withColumnRenamed("conv", "base").join(
        plan.select("base", "conv", "h", "len").hint("merge"), "base").filter("pos <= h")       # at most five to a base
    own = placed.join(plan.select("conv", "h", "head", "len").hint("merge"), "conv").filter("pos > h").withColumn(
        "pos", F.col("pos") - F.col("h") + F.col("head"))
    columns = ["conv", "len", "pos", "t1", "t2", "size"]
    return _with_roots(heads.select(columns).unionAll(own.select(columns)), plan.select("conv", "len"))


def _wrapped(value: Column) -> Column:
    """A whole decimal modulo 2^64 as a signed integer."""
    half, whole = F.lit(str(1 << 63)).cast("decimal(20,0)"), F.lit(str(1 << 64)).cast("decimal(20,0)")
    return (F.pmod(value + half, whole) - half).cast("long")


def prefix_rows(rows: DataFrame) -> DataFrame:
    """(conv, len, pos, seg, d1, d2, p1, p2, size): digests of each prefix and of the one before."""
    schema = pa.schema([(c, pa.int64()) for c in ("conv", "len", "pos", "seg", "d1", "d2", "p1", "p2", "size")])
    keyed = rows.withColumn("seg", F.floor(F.col("pos") / SEGMENT))
    dealt = keyed.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, np.zeros(2, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, seg, pos, t1, t2 = (batch.column(c).to_numpy() for c in ("conv", "seg", "pos", "t1", "t2"))
            place, a, b = pos.astype(np.uint64), t1.view(np.uint64), t2.view(np.uint64)
            hashes = np.stack([mix(mix(a + place * _LANES[0]) + b), mix(mix(b + place * _LANES[1]) ^ a)])
            hashes[:, pos == 0] = 0
            sums = np.cumsum(hashes, axis=1, dtype=np.uint64)
            starts = _runs(conv, seg)
            sizes = np.diff(np.append(starts, len(conv)))
            sums -= np.repeat(sums[:, starts] - hashes[:, starts], sizes, axis=1)
            if (conv[0], seg[0]) == last:
                sums[:, :sizes[0]] += carried[:, None]
            last, carried = (conv[-1], seg[-1]), sums[:, -1].copy()
            parents = sums - hashes
            yield record(schema, *(batch.column(c) for c in ("conv", "len", "pos", "seg")),
                         *(pa.array(x.view(np.int64)) for x in (*sums, *parents)), batch.column("size"))

    found = materialise(dealt.mapInArrow(work, ", ".join(f"{f.name} long" for f in schema)), "prefixes")
    # Later segments of long conversations: their sums go on from those of the segments before.
    ends = found.filter(F.col("len") >= SEGMENT).groupBy("conv", "seg").agg(F.max(F.struct("pos", "d1", "d2")).alias("end"))
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    offsets = ends.select("conv", "seg", *(F.sum(F.col(f"end.{d}").cast("decimal(20,0)")).over(before).alias(o) for d, o in (("d1", "o1"), ("d2", "o2"))))
    later = found.filter("seg > 0").join(offsets.hint("merge"), ["conv", "seg"])
    shifted = {c: _wrapped(F.col(c).cast(wide) + F.col(f"o{c[1]}").cast(wide)) for c in ("d1", "d2", "p1", "p2")}
    return found.filter("seg = 0").unionAll(later.withColumns(shifted).select(found.columns))


def _columns(parts: list[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    return [np.concatenate([p.column(n).to_numpy(zero_copy_only=False) for p in parts]) for n in names]


def _merged_nodes(prefixes: DataFrame) -> DataFrame:
    """(d1, d2, p1, p2, depth, size, n, rep, inner): the nodes with their members, smallest member, and whether one goes on."""
    schema = pa.schema([*((c, pa.int64()) for c in ("d1", "d2", "p1", "p2", "depth", "size", "n", "rep")), ("inner", pa.bool_())])

    def shard(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        conv, length, pos, d1, d2, p1, p2, size = _columns(parts, "conv", "len", "pos", "d1", "d2", "p1", "p2", "size")
        table, slot = NodeTable.enumerate(d1.view(np.uint64), d2.view(np.uint64))
        n = np.bincount(slot, minlength=len(table))
        rep = np.full(len(table), np.iinfo(np.int64).max)
        np.minimum.at(rep, slot, conv)
        inner = np.bincount(slot, weights=pos < length, minlength=len(table)) > 0
        flat = []
        for values in (p1, p2, pos, size):
            array = np.zeros(len(table), dtype=np.int64)
            array[slot] = values
            flat.append(array)
        return record(schema, *map(pa.array, (table.first.view(np.int64), table.second.view(np.int64), *flat, n, rep, inner)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            parts.append(batch)
            held += batch.num_rows
            if held >= SHARD_ROWS:
                yield shard(parts)
                parts, held = [], 0
        if held:
            yield shard(parts)

    partial = prefixes.select("conv", "len", "pos", "d1", "d2", "p1", "p2", "size").mapInArrow(
        work, ", ".join(f"{f.name} {'boolean' if f.name == 'inner' else 'long'}" for f in schema))
    same = ("p1", "p2", "depth", "size")
    merged = partial.groupBy("d1", "d2").agg(
        *(F.min(c).alias(c) for c in same), *(F.max(c).alias(f"{c}_") for c in same),
        F.sum("n").alias("n"), F.min("rep").alias("rep"), F.max("inner").alias("inner"))
    differs = F.concat_ws(" ", *same) != F.concat_ws(" ", *(f"{c}_" for c in same))
    depth = F.when(differs, F.raise_error(F.lit("two prefixes have the same digest")).cast("long")).otherwise(F.col("depth"))
    return merged.select("d1", "d2", "p1", "p2", depth.alias("depth"), "size", "n", "rep", "inner")


def _subtree_sums(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(d1, d2, saved, leaves): parts of the sums over the subtree of each node."""
    own = nodes.select(F.col("rep").alias("conv"), F.col("depth").alias("pos"), ((F.col("n") - 1) * F.col("size")).alias("saved"),
                       F.when(F.col("inner"), 0).otherwise(1).cast("long").alias("leaves"))
    rows = prefixes.select("conv", "len", "pos", "seg", "d1", "d2", "p1", "p2").join(own.hint("merge"), ["conv", "pos"], "left")
    rows = materialise(rows.fillna(0, ["saved", "leaves"]), "trie-rows")
    # What later segments of a long conversation add is handed to the last row of a segment.
    totals = rows.filter(F.col("len") >= SEGMENT).groupBy("conv", "seg").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    after = Window.partitionBy("conv").orderBy(F.col("seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv", "seg", *(F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"more_{c}") for c in ("saved", "leaves")))
    last = F.col("pos") % SEGMENT == SEGMENT - 1
    edges = rows.filter(last).join(carried.hint("merge"), ["conv", "seg"], "left")
    edges = edges.withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("saved", "leaves")}).select(rows.columns)
    dealt = rows.filter(~last).unionAll(edges).repartition("conv", "seg").sortWithinPartitions("conv", "seg")
    schema = pa.schema([(c, pa.int64()) for c in ("d1", "d2", "saved", "leaves")])

    def shard(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        pos, d1, d2, p1, p2, *values = _columns(parts, "pos", "d1", "d2", "p1", "p2", "saved", "leaves")
        table, slot = NodeTable.enumerate(d1.view(np.uint64), d2.view(np.uint64))
        depth, parent = np.zeros(len(table), dtype=np.int64), np.full(len(table), -1)
        depth[slot] = pos
        # A segment's first node hands its sum on through the carried totals, not through a slot.
        parent[slot] = np.where(pos % SEGMENT > 0, table.slots(p1.view(np.uint64), p2.view(np.uint64)), -1)
        sums = np.zeros((2, len(table)), dtype=np.int64)
        for total, value in zip(sums, values):
            np.add.at(total, slot, value)
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, _runs(depth[order])[1:]):
            level = level[parent[level] >= 0]
            for total in sums:
                np.add.at(total, parent[level], total[level])
        some = np.flatnonzero(sums.any(axis=0))
        return record(schema, *map(pa.array, (table.first[some].view(np.int64), table.second[some].view(np.int64), sums[0][some], sums[1][some])))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if held + batch.num_rows > SHARD_ROWS and held:
                # A shard ends where a segment does.
                conv, seg = batch.column("conv").to_numpy(), batch.column("seg").to_numpy()
                same = (conv == parts[-1].column("conv")[-1].as_py()) & (seg == parts[-1].column("seg")[-1].as_py())
                cut = len(same) if same.all() else int(np.argmin(same))
                parts.append(batch.slice(0, cut))
                if cut == len(same):
                    held += cut
                    continue
                yield shard(parts)
                parts, held, batch = [], 0, batch.slice(cut)
            if batch.num_rows:
                parts.append(batch)
                held += batch.num_rows
        if held:
            yield shard(parts)

    return dealt.select("conv", "seg", "pos", "d1", "d2", "p1", "p2", "saved", "leaves").mapInArrow(
        work, "d1 long, d2 long, saved long, leaves long")


def _end_digests(prefixes: DataFrame) -> DataFrame:
    """(d1, d2, ends): SHA-256 of the ids that end in a node, for nodes where one does."""
    ranged = prefixes.filter("pos = len").select("d1", "d2", "conv").repartitionByRange("d1", "d2", "conv").sortWithinPartitions("d1", "d2", "conv")
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int64()), ("ids", pa.string()), ("ends", pa.string())])
    plain = "d1 long, d2 long, first long, ids string, ends string"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, whole, out = None, [], False, []     # whole: neither the range's first node nor in pieces already

        def close(last: bool) -> None:
            text = ",".join(map(str, ids))
            if whole and not last:
                out.append((*key, None, None, hashlib.sha256(text.encode()).hexdigest()))
            elif ids:
                out.append((*key, ids[0], text, None))

        for batch in batches:
            if not batch.num_rows:
                continue
            d1, d2, conv = (batch.column(c).to_numpy() for c in ("d1", "d2", "conv"))
            starts = _runs(d1, d2).tolist()
            for a, b in zip(starts, [*starts[1:], len(conv)]):
                found = (int(d1[a]), int(d2[a]))
                if found != key:
                    if key is not None:
                        close(last=False)
                    whole, key, ids = key is not None, found, []
                ids += conv[a:b].tolist()
                while len(ids) >= PIECE:
                    out.append((*key, ids[0], ",".join(map(str, ids[:PIECE])), None))
                    ids, whole = ids[PIECE:], False
            if out:
                yield record(schema, *map(list, zip(*out)))
                out.clear()
        if key is not None:
            close(last=True)
        if out:
            yield record(schema, *map(list, zip(*out)))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        target = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("ends", pa.string())])
        for batch in batches:
            out = []
            for d1, d2, text in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
                if (d1, d2) == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (d1, d2), hashlib.sha256(text.encode())
            if out:
                yield record(target, *map(list, zip(*out)))
        if key is not None:
            yield record(target, *([k] for k in key), [state.hexdigest()])

    found = materialise(ranged.mapInArrow(pieces, plain), "trie-ends")
    cut = found.filter("ends IS NULL").select("d1", "d2", "first", "ids").repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first")
    return found.filter("ends IS NOT NULL").select("d1", "d2", "ends").unionAll(cut.mapInArrow(joined, "d1 long, d2 long, ends string"))


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv, len, pos, t1, t2, size), with a row of position 0 for each conversation:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prefixes = materialise(prefix_rows(rows), "trie-prefixes")
    nodes = materialise(_merged_nodes(prefixes), "trie-nodes")
    facts = {"p1": "long", "p2": "long", "depth": "long", "n": "long", "rep": "long", "children": "long", "saved": "long", "leaves": "long", "ends": "string"}

    def padded(df: DataFrame, d1: str = "d1", d2: str = "d2", **values: Column) -> DataFrame:
        return df.select(F.col(d1).alias("k1"), F.col(d2).alias("k2"), *(
            values.get(c, F.col(c) if c in df.columns and not values else F.lit(None)).cast(kind).alias(c) for c, kind in facts.items()))

    parts = padded(nodes.select("d1", "d2", "p1", "p2", "depth", "n", "rep"))
    for more in (padded(_subtree_sums(prefixes, nodes)), padded(_end_digests(prefixes)),
                 padded(nodes.filter("depth > 0"), "p1", "p2", children=F.lit(1))):
        parts = parts.unionAll(more)
    whole = parts.groupBy("k1", "k2").agg(
        *(F.max(c).alias(c) for c in ("p1", "p2", "depth", "n", "rep", "ends")), *(F.sum(c).alias(c) for c in ("children", "saved", "leaves")))
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("rep").alias("parent"))
    whole = whole.join(parents.hint("merge"), ["p1", "p2"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return whole.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("children", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends", F.lit(none)).alias("ends_sha256"))


def prefix_trie(df: DataFrame, rebuild: bool = False, **columns: str) -> DataFrame:
    """The trie of the conversations in ``df``, as they are or rebuilt from each other's first turns.

    ``columns`` names conv_id, turn, role and text where they differ. ``conv_id`` is an integer.
    """
    placed, convs = positions(turn_digests(df, **columns))
    return trie((rebuilt_rows if rebuild else plain_rows)(placed, convs))


def node_rows(df: DataFrame) -> DataFrame:
    """Per node of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return prefix_trie(df, rebuild=True)


SQL = r"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
codes AS (
    SELECT conv_id, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                   lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc
    FROM (SELECT DISTINCT conv_id FROM turns)),
plan AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(crc, 4294967295) % 9 AS h FROM codes),
parts AS (
    SELECT p.conv_id, 0 AS part, t.pos, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.h
    UNION ALL
    SELECT p.conv_id, 1, t.pos, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h),
convs AS (
    SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (WHERE part IS NOT NULL), []) AS turns
    FROM plan LEFT JOIN parts USING (conv_id) GROUP BY conv_id),
members AS (SELECT conv_id, d, turns[1:d] AS prefix, d = len(turns) AS ends
            FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM convs)),
nodes AS (
    SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
           (count(*) - 1) * CASE WHEN d > 0 THEN strlen(prefix[d].text) ELSE 0 END AS own
    FROM members GROUP BY prefix, d),
children AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n_children, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.d = p.d + 1 AND n.prefix[1:n.d - 1] = p.prefix LEFT JOIN children c ON c.prefix = n.prefix),
sums AS (
    SELECT prefix, sum(leaf)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
    FROM (SELECT prefix[1:unnest(range(0, d + 1))] AS prefix, (n_children = 0)::INT AS leaf, own FROM whole) GROUP BY prefix)
SELECT w.conv_id, w.d AS depth, w.parent_conv_id, w.n AS n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.prefix = w.prefix
"""
