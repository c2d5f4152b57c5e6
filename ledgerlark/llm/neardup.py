"""Near-duplicate groups by SuperMinHash banding, exact verification and union-find (operator 3).

1. Every text becomes its set of word shingles, a digest of the set, and the band keys of its signature.
   Equal sets form a class with the smallest id as representative; only representatives go on.
2. Representatives that share a band key form a bucket. Buckets with the same members count once.
3. A first wave looks at the first bands. Buckets are dealt into blocks of bounded size; a task holds the full
   sets of one block, compares members whose sketches agree, and joins them with a union-find, so it reports
   at most one verified link per member.
4. The second wave takes the buckets of all bands that still span several components. In each, all members
   outside its largest component are compared with all members, block by block, unless a union-find knows
   them to be connected already. So every pair in a bucket is either compared or known to be connected.
5. Components are found on tables; nothing about all documents comes to the driver.

The values in a band and the sketch limit follow from the threshold: a pair at it is in no common bucket with a
probability of at most 3e-5 (0.85: 40 bands of 8 values, 3e-6; 0.8: 45 of 7, 2.5e-5), and the sketch comparison, 7.5
deviations below it, loses it with less than 1e-11. Below 4 percent even bands of one value miss more than that.

Defined cases. Null, empty and blank texts have no shingles and stay alone. A row without id is not linked and
gets the component null. Each row is linked by its own text; texts whose smallest id is the same count as linked. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.session import materialise, scratch_scope

from .batches import fresh, record, slices
from .components import connected
from .superminhash import REGISTERS, signatures
from .wordhash import mix, shingles

SHINGLE = 5
PERCENT = 85               # links need 100 * intersection >= PERCENT * union
MISS = 3e-5                # most probability that a pair at the threshold shares no band
FIRST_WAVE = 8             # bands of the first wave, of REGISTERS / band_rows
SKETCH_DEVIATIONS = 7.5    # equal sketch bytes, in deviations below the threshold, from which on sets are compared
BLOCK_SHINGLES = 1 << 20   # shingles held by a task at once
BLOCK_MEMBERS = 1024

_BAND_PLACES = np.random.default_rng(8).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)


def band_rows(percent: int) -> int:
    """Signature values in a band: the most with which a pair at the threshold is missed with at most MISS."""
    return max((r for r in range(2, REGISTERS + 1) if (1 - (percent / 100) ** r) ** (REGISTERS // r) <= MISS), default=1)


def sketch_limit(percent: int) -> int:
    """Equal sketch bytes below which sets are not compared."""
    share = percent / 100
    return max(0, int(REGISTERS * share - SKETCH_DEVIATIONS * (REGISTERS * share * (1 - share)) ** 0.5))


def _digest(values: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(values.tobytes())


def shingle_features(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc, n, digest, bands, sketch) of rows (doc, text); without shingles the last three are null.
    Further columns are kept."""
    rows = band_rows(percent)
    count = REGISTERS // rows
    more = [c for c in df.columns if c not in ("doc", "text")]
    schema = f"doc {df.schema['doc'].dataType.simpleString()}, n long, digest binary, bands array<long>, sketch binary"
    schema += "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in more)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target = pa.schema([batch.schema.field("doc"), ("n", pa.int64()), ("digest", pa.binary()),
                                ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()),
                                *(batch.schema.field(c) for c in more)])
            for part in slices(batch, "text"):
                sets = shingles([(t or "").encode().lower() for t in part.column("text").to_pylist()], size)
                signed = signatures(sets)
                bands = np.zeros((len(sets), count), dtype=np.uint64)
                for k in range(rows):
                    bands += mix(signed[:, k:count * rows:rows]) * _BAND_PLACES[k]
                bands = mix(bands + np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                sketches = signed.astype(np.uint8)
                yield record(target, part.column("doc"), [len(s) for s in sets],
                             [_digest(s) if len(s) else None for s in sets],
                             [b if len(s) else None for s, b in zip(sets, bands)],
                             [k.tobytes() if len(s) else None for s, k in zip(sets, sketches)],
                             *(part.column(c) for c in more))

    return df.mapInArrow(work, schema)


def _full_sets(df: DataFrame, size: int) -> DataFrame:
    """(rep, sketch, shingles) of rows (rep, digest, sketch, text) whose text has the digest."""
    schema = f"rep {df.schema['rep'].dataType.simpleString()}, sketch binary, shingles binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target = pa.schema([batch.schema.field("rep"), ("sketch", pa.binary()), ("shingles", pa.binary())])
            for part in slices(batch, "text"):
                sets = shingles([(t or "").encode().lower() for t in part.column("text").to_pylist()], size)
                same = [n for n, (s, d) in enumerate(zip(sets, part.column("digest").to_pylist())) if _digest(s) == d]
                own = pa.array(same, pa.int64())
                yield record(target, part.column("rep").take(own), part.column("sketch").take(own),
                             [sets[n].tobytes() for n in same])

    return df.mapInArrow(work, schema)


class _Group:
    """Members of one block; ``probe`` members are compared with all others."""

    def __init__(self):
        self.reps, self.parts, self.probe, self.sketches, self.sets = [], [], [], [], []

    def links(self, percent: int, everyone: bool) -> list[tuple]:
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        sketches = np.frombuffer(b"".join(self.sketches), dtype=np.uint8).reshape(len(self.reps), -1)
        sizes = np.array([len(s) // 8 for s in self.sets])
        enough = sketch_limit(percent)
        for x in range(len(self.reps)):
            if not (everyone or self.probe[x]):
                continue
            rest = slice(x + 1, None) if everyone else slice(None)
            if sketches[rest].shape[0] == 0:
                continue
            alike = (sketches[rest] == sketches[x]).sum(axis=1)
            near = np.flatnonzero((alike >= enough) & (100 * sizes[rest] >= percent * sizes[x])
                                  & (percent * sizes[rest] <= 100 * sizes[x]))
            own = None
            for y in (near[np.argsort(-alike[near], kind="stable")] + (x + 1 if everyone else 0)).tolist():
                if find(self.parts[x]) == find(self.parts[y]):
                    continue
                own = np.frombuffer(self.sets[x], dtype=np.uint64) if own is None else own
                other = np.frombuffer(self.sets[y], dtype=np.uint64)
                places = np.minimum(np.searchsorted(other, own), len(other) - 1)
                shared = int((other[places] == own).sum())
                if 100 * shared >= percent * (len(own) + len(other) - shared):
                    parent[find(self.parts[x])] = find(self.parts[y])
                    out.append((self.reps[x], self.reps[y]))
        return out


def _verified(rows: DataFrame, percent: int, everyone: bool) -> DataFrame:
    """Links (a, b) within the groups (key, i, j) of rows (key, i, j, rep, part, probe, sketch, shingles)."""
    kind = rows.schema["rep"].dataType.simpleString()
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, target = None, _Group(), None
        for batch in batches:
            out = []
            target = target or pa.schema([("a", batch.schema.field("rep").type), ("b", batch.schema.field("rep").type)])
            columns = [batch.column(c).to_pylist() for c in ("key", "i", "j", "rep", "part", "probe", "sketch", "shingles")]
            for key, i, j, *member in zip(*columns):
                if (key, i, j) != now:
                    out += group.links(percent, everyone) if len(group.reps) > 1 else []
                    now, group = (key, i, j), _Group()
                for values, value in zip((group.reps, group.parts, group.probe, group.sketches, group.sets), member):
                    values.append(value)
            if out:
                yield record(target, *map(list, zip(*out)))
        out = group.links(percent, everyone) if len(group.reps) > 1 else []
        if out:
            yield record(target, *map(list, zip(*out)))

    return dealt.mapInArrow(work, f"a {kind}, b {kind}")


def _blocks(n: Column, total: Column) -> Column:
    return F.greatest(F.ceil(total / BLOCK_SHINGLES), F.ceil(n / BLOCK_MEMBERS)).cast("int")


def _merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the corpus: never a broadcast, the same plan at every size; large
    partitions of a frequent key are split by adaptive execution."""
    return left.join(right.hint("merge"), on, how)


def _buckets(members: DataFrame) -> DataFrame:
    """Keys of buckets that span several parts, one of those with equal members, with their sizes."""
    buckets = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("total"), F.min("rep").alias("least"),
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"),
        F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high")
    return buckets.groupBy("members", "total", "least", "x", "y").agg(F.min("key").alias("key"))


def _first_wave(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    keys = materialise(_buckets(members).select("key", _blocks(F.col("members"), F.col("total")).alias("blocks")), "buckets")
    rows = _merged(members, keys, "key").select(
        "key", F.pmod(F.xxhash64("rep", "key"), F.col("blocks")).cast("int").alias("i"), F.lit(0).alias("j"),
        "rep", "part", F.lit(True).alias("probe"))
    return _verified(_merged(rows, sets, "rep").select(
        "key", "i", "j", "rep", "part", "probe", "sketch", "shingles"), percent, everyone=True)


def _second_wave(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    keys = materialise(_buckets(members).select("key", "members", "total"), "buckets")
    inside = materialise(_merged(members, keys.select("key"), "key"), "bucket-members")
    parts = inside.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("sum"))
    largest = _merged(parts.groupBy("key").agg(F.max(F.struct("size", "sum", "part")).alias("top")), keys, "key")
    largest = materialise(largest.select(
        "key", F.col("top.part").alias("main"), _blocks(F.col("members"), F.col("total")).alias("across"),
        F.greatest(F.lit(1), _blocks(F.col("members") - F.col("top.size"), F.col("total") - F.col("top.sum"))).alias("down")), "bucket-parts")
    rows = _merged(inside, largest, "key")
    place = F.xxhash64("rep", "key")
    everyone = rows.select("key", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("i"),
                           F.pmod(place, F.col("across")).cast("int").alias("j"), "rep", "part", F.lit(False).alias("probe"))
    probes = rows.filter(F.col("part") != F.col("main")).select(
        "key", F.pmod(place, F.col("down")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("j"), "rep", "part", F.lit(True).alias("probe"))
    return _verified(_merged(everyone.unionAll(probes), sets, "rep").select(
        "key", "i", "j", "rep", "part", "probe", "sketch", "shingles"), percent, everyone=False)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT,
                    size: int = SHINGLE) -> DataFrame:
    """(doc, n, component) for each row of ``df``: its number of shingles and the smallest id it is linked to,
    directly or through others; itself included."""
    return _linked(df.select(F.col(id_col).alias("doc"), F.col(text).alias("text")), percent, size)


def _linked(source: DataFrame, percent: int, size: int = SHINGLE) -> DataFrame:
    """(doc, n, further columns, component) for each row of ``source`` (doc, text, further columns)."""
    more = [c for c in source.columns if c not in ("doc", "text")]
    features = materialise(shingle_features(source, size, percent), "shingle-features")
    classes = materialise(
        features.filter(F.col("digest").isNotNull() & F.col("doc").isNotNull()).groupBy("digest").agg(
            F.min("doc").alias("rep"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "shingle-classes")

    banded = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high").select("key")
    pairs = materialise(_merged(banded, shared, "key"), "candidates")
    wanted = _merged(classes.select("rep", "digest", "n", "sketch"), pairs.select("rep").distinct(), "rep")
    wanted = materialise(wanted, "candidate-documents")
    texts = _merged(source, wanted, F.col("doc") == F.col("rep")).select("rep", "digest", "sketch", "text")
    sets = materialise(_full_sets(texts, size), "candidate-sets")
    members = wanted.groupBy("rep").agg(F.max("n").alias("n"))      # one row, but for an id with several texts
    candidates = materialise(_merged(pairs, members, "rep").withColumn("part", F.col("rep")), "candidates")

    first = connected(_first_wave(candidates.filter(F.col("band") < FIRST_WAVE), sets, percent))
    heads = first.select(F.col("high").alias("rep"), F.col("low").alias("head"))
    labelled = _merged(candidates, heads, "rep", "left").withColumn("part", F.coalesce("head", "rep")).drop("head")
    links = materialise(_second_wave(labelled, sets, percent), "second-links")
    final = connected(first.select(F.col("high").alias("a"), F.col("low").alias("b")).unionAll(links.select("a", "b")))

    groups = _merged(classes.select("digest", "rep", "copies"), final.select(F.col("high").alias("rep"), "low"), "rep", "left")
    groups = groups.filter("copies > 1 OR low IS NOT NULL").select("digest", F.coalesce("low", "rep").alias("component"))
    found = _merged(features.select("doc", "n", *more, "digest"), groups, "digest", "left")
    return found.select("doc", "n", *more, F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that are the smallest document of their group, with the columns of ``df``; rows without id stay."""
    gone, own = fresh(df, "copy_doc", "copy_text")
    mark = F.unhex(F.md5(F.col(text)))               # a row goes for its own text, whatever else stands under its id
    with scratch_scope(df.sparkSession):             # features, sets and links go before the texts move
        found = _linked(df.select(F.col(id_col).alias("doc"), F.col(text).alias("text"), mark.alias("mark")), percent)
        copies = materialise(found.filter(F.col("doc") != F.col("component")).select(
            F.col("doc").alias(gone), F.col("mark").alias(own)).distinct(), "copies", keep=True)
    return df.join(copies.hint("merge"), (F.col(id_col) == F.col(gone)) & (mark == F.col(own)), "left_anti")


def group_rows(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    found = near_duplicates(df)
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"))


SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS sh
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
    WHERE 100 * k >= 85 * (a.n + b.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, e.y FROM reach r JOIN both_ways e ON r.y = e.x),
least_one AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_one LEFT JOIN n USING (doc_id)
"""
