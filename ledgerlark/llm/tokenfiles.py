"""Token files: ids of a corpus in document order, range-coded in independent blocks (operator 5).

``write_token_files`` range-partitions the documents by id, tokenizes them once into an intermediate table of
blocks of whole documents, counts the tokens, and codes every block with one shared frequency table. A folder holds

- ``blocks``  (shard, block, first, docs, lengths, payload): a row per block; ``first`` counts the shard's ids before it,
- ``table``   (precision, token, slots): the shared frequency table, at most a row per vocabulary entry,
- ``shards``  (shard, first): ids before the shard, a row per range partition.

Blocks, and with their checkpoints parts of blocks, can be decoded in any order and place (see ``rans``).

Defined cases. Null and empty texts have only the end id. Rows of the same id follow each other, ordered by a hash
of the text; rows without id come first. An empty table gives empty files and an empty result.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlark.session import scratch_path

from . import rans
from .batches import record, slices

BLOCK_TOKENS = 1 << 17
CHUNK_CACHE = 700_000
JOINED = 64                # new units handed to the library as one text
SLICE_BYTES = 8 << 20      # text whose units are looked up together: more of it has fewer distinct ones to the byte

#: A space before a character that is no white space always begins a new unit of the splitting pattern.
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")


class _Units:
    """Ids of text units in one growing array, with the place of each unit's ids; what was not used lately is forgotten."""

    def __init__(self, kind: str, size: int):
        self.kind, self.size = kind, size
        self.old: "_Units | None" = None
        self.numbers: dict[str, int] = {}
        self.begins = np.zeros(1 << 10, dtype=np.int64)
        self.counts = np.zeros(1 << 10, dtype=np.int64)
        self.ids = np.zeros(1 << 12, dtype=kind)
        self.used = 0

    def aged(self) -> "_Units":
        """Itself, or if it is full an empty one with this one behind it."""
        if len(self.numbers) <= self.size:
            return self
        fresh, self.old = _Units(self.kind, self.size), None
        fresh.old = self
        return fresh

    def add(self, units: list[str], counts: np.ndarray, ids: np.ndarray) -> None:
        first, need = len(self.numbers), self.used + len(ids)
        if first + len(units) > len(self.begins):
            self.begins, self.counts = (np.resize(x, 2 * (first + len(units))) for x in (self.begins, self.counts))
        if need > len(self.ids):
            self.ids = np.resize(self.ids, 2 * need)
        self.begins[first:first + len(units)] = self.used + np.cumsum(counts) - counts
        self.counts[first:first + len(units)] = counts
        self.ids[self.used:need] = ids
        self.used = need
        self.numbers.update(zip(units, range(first, first + len(units))))

    def look_up(self, units: list[str], learn) -> np.ndarray:
        """Numbers of distinct ``units``; ``learn`` gives counts and ids of unknown ones."""
        found = list(map(self.numbers.get, units))
        missing = [n for n, number in enumerate(found) if number is None]
        if missing:
            unknown = [units[n] for n in missing]
            if self.old:
                before = [self.old.numbers.get(u) for u in unknown]
                at = np.array([n for n in before if n is not None], dtype=np.int64)
                self.add([u for u, n in zip(unknown, before) if n is not None], self.old.counts[at], self.old.gather(at))
                unknown = [u for u, n in zip(unknown, before) if n is None]
            if unknown:
                self.add(unknown, *learn(unknown))
            for n in missing:
                found[n] = self.numbers[units[n]]
        return np.array(found, dtype=np.int64)

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the units of these numbers, one after the other."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        return self.ids[np.repeat(self.begins[numbers] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]


class ByteBpe:
    """Byte-level BPE through the tokenizers library, with units between spaces remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        if not isinstance(self.library.pre_tokenizer, ByteLevel) or self.library.normalizer is not None:
            raise ValueError("needs a byte-level tokenizer without normalisation")
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        added = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or " " in t.content for t in added.values()):
            raise ValueError("special tokens must not reach over spaces")
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.lengths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.lengths[number] = len(added[number].content.encode()) if number in added else len(token)
        self.units = _Units(self.kind, CHUNK_CACHE)    # what follows a space, with the space's part of its ids
        self.begins = _Units(self.kind, CHUNK_CACHE)   # what stands before the first space

    def _library_ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(coded.ids, dtype=self.kind) for coded in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_begins(self, begins: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._library_ids(begins)
        return np.array([len(i) for i in ids], dtype=np.int64), np.concatenate(ids)

    def _learn_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids and ids of new units; many of them are handed to the library as one text."""
        texts = [" " + " ".join(units[a:a + JOINED]) for a in range(0, len(units), JOINED)]
        ids = np.concatenate(self._library_ids(texts))
        sizes = pc.binary_length(pa.array(units, pa.string())).to_numpy() + 1
        # Every unit ends where a token does: after as many bytes as it and those before it have.
        ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes)) + 1
        return np.diff(ends, prepend=0), ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of type ``kind``."""
        if not texts:
            return []
        self.units, self.begins = self.units.aged(), self.begins.aged()
        odd = [n for n, t in enumerate(texts) if _ODD.search(t)]
        split = pc.split_pattern(pa.array(["" if n else t for n, t in zip(_flags(odd, len(texts)), texts)], pa.string()), " ")
        flat, sizes = split.flatten(), np.diff(split.offsets.to_numpy()).astype(np.int64)
        order = None
        if odd:
            # These stand behind the others, with an empty unit where they belong.
            cut = [_CUT.split(texts[n]) for n in odd]
            flat = pa.concat_arrays([flat, pa.array([u for c in cut for u in c], pa.string())])
            first = np.cumsum(sizes) - sizes
            places = len(split.values) + np.cumsum([0] + [len(c) for c in cut])
            parts = [np.arange(a, a + n) for a, n in zip(first.tolist(), sizes.tolist())]
            for n, a, b in zip(odd, places, places[1:]):
                parts[n] = np.arange(a, b)
                sizes[n] = b - a
            order = np.concatenate(parts)
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy() if order is None else coded.indices.to_numpy()[order]
        starts = np.cumsum(sizes) - sizes
        follows = np.ones(len(codes), dtype=bool)
        follows[starts] = False
        wanted = np.flatnonzero(np.bincount(codes[follows], minlength=len(distinct)))
        number = np.zeros(len(distinct), dtype=np.int64)
        number[wanted] = self.units.look_up([distinct[n] for n in wanted.tolist()], self._learn_units)
        opening, which = np.unique(codes[starts], return_inverse=True)
        heads = self.begins.look_up([distinct[n] for n in opening.tolist()], self._learn_begins)[which]
        counts = np.empty(len(codes), dtype=np.int64)
        counts[follows], counts[starts] = self.units.counts[number[codes[follows]]], self.begins.counts[heads]
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), dtype=self.kind)
        begin = np.repeat(~follows, counts)
        out[~begin], out[begin] = self.units.gather(number[codes[follows]]), self.begins.gather(heads)
        raw, width = out.tobytes(), np.dtype(self.kind).itemsize
        edges = np.append(ends[starts] - counts[starts], ends[-1]) * width
        return [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _flags(places: list[int], size: int) -> list[bool]:
    out = [False] * size
    for n in places:
        out[n] = True
    return out


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _tokenized_blocks(df: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(shard, block, first, docs, lengths, width, ids) from rows (doc, text) in their order."""
    kind = df.schema["doc"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = byte_bpe(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=own.kind).tobytes()
        target, first, block = None, 0, 0
        docs, lengths, parts, size = [], [], [], 0

        def flush():
            return record(target, [shard], [block], [first], [docs], [lengths], [len(end)], [b"".join(parts)])

        for batch in batches:
            target = target or pa.schema([
                ("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("docs", pa.list_(batch.schema.field("doc").type)),
                ("lengths", pa.list_(pa.int64())), ("width", pa.int32()), ("ids", pa.binary())])
            for part in slices(batch, "text", SLICE_BYTES):
                ids = own.encode([t or "" for t in part.column("text").to_pylist()])
                for doc, coded in zip(part.column("doc").to_pylist(), ids):
                    n = len(coded) // len(end) + 1
                    docs.append(doc)
                    lengths.append(n)
                    parts.append(coded + end)
                    size += n
                    if size >= BLOCK_TOKENS:
                        yield flush()
                        first, block = first + size, block + 1
                        docs, lengths, parts, size = [], [], [], 0
        if docs:
            yield flush()

    return df.mapInArrow(work, f"shard int, block long, first long, docs array<{kind}>, lengths array<long>, width int, ids binary")


def _token_counts(blocks: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for width, raw in zip(batch.column("width").to_pylist(), batch.column("ids").to_pylist()):
                found = np.bincount(np.frombuffer(raw, dtype=f"<u{width}"), minlength=len(counts))
                found[:len(counts)] += counts
                counts = found
        tokens = np.flatnonzero(counts)
        yield record(pa.schema([("token", pa.int64()), ("n", pa.int64())]), pa.array(tokens), pa.array(counts[tokens]))

    return blocks.select("width", "ids").mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _coded_blocks(blocks: DataFrame, table: tuple[np.ndarray, np.ndarray, int]) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema if f.name not in ("width", "ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rans.Table(*table)
        for batch in batches:
            coded = [rans.encode(np.frombuffer(raw, dtype=f"<u{width}").astype(np.int64), own)
                     for width, raw in zip(batch.column("width").to_pylist(), batch.column("ids").to_pylist())]
            rest = batch.drop_columns(["width", "ids"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(coded, pa.binary())],
                                             schema=rest.schema.append(pa.field("payload", pa.binary())))

    return blocks.mapInArrow(work, schema + ", payload binary")


def write_token_files(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                      end_id: int = 2) -> None:
    """Write the ids of all rows of ``df``, each followed by ``end_id``, in ascending order of ``id_col`` to ``path``."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("doc"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc", tie).sortWithinPartitions("doc", tie)
    raw = scratch_path(spark, "token-blocks")
    _tokenized_blocks(ordered, tokenizer, end_id).write.option("compression", "zstd").parquet(raw)
    blocks = spark.read.parquet(raw)
    counts = _token_counts(blocks).collect()       # at most one row per vocabulary entry
    table = rans.Table.from_counts(np.array([r["token"] for r in counts], dtype=np.int64),
                                   np.array([r["n"] for r in counts], dtype=np.int64))
    plain = (table.tokens.astype(np.int64), table.slots.astype(np.int64), table.precision)
    _coded_blocks(blocks, plain).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    entries = [(table.precision, int(t), int(s)) for t, s in zip(table.tokens, table.slots)]
    spark.createDataFrame(entries, "precision int, token long, slots long").coalesce(1).write.parquet(f"{path}/table")
    sizes = blocks.select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    sizes = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)    # one row per range partition
    sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")).write.parquet(f"{path}/shards")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc, start, n_tokens, ids) of every document: ids before it, its ids as little-endian unsigned 32-bit integers."""
    entries = spark.read.parquet(f"{path}/table").orderBy("token").collect()       # at most one row per vocabulary entry
    plain = (np.array([r["token"] for r in entries], dtype=np.int64), np.array([r["slots"] for r in entries], dtype=np.int64),
             entries[0]["precision"] if entries else 17)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["docs"].dataType.elementType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rans.Table(*plain)
        for batch in batches:
            target = pa.schema([("shard", pa.int32()), ("doc", batch.schema.field("docs").type.value_type), ("start", pa.int64()),
                                ("n_tokens", pa.int64()), ("ids", pa.binary())])
            for at in range(batch.num_rows):
                shard, first, docs, lengths, payload = (batch.column(c)[at].as_py() for c in ("shard", "first", "docs", "lengths", "payload"))
                ids = rans.decode(payload, own).astype("<u4")
                ends = np.cumsum(lengths)
                if ends[-1] != len(ids):
                    raise ValueError("a block does not hold the ids of its documents")
                raw, begins = ids.tobytes(), ends - lengths
                yield record(target, [shard] * len(docs), docs, pa.array(begins + first), lengths,
                             [raw[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist())])

    found = blocks.select("shard", "first", "docs", "lengths", "payload").mapInArrow(
        work, f"shard int, doc {kind}, start long, n_tokens long, ids binary")
    shards = F.broadcast(spark.read.parquet(f"{path}/shards"))      # one row per range partition of the writer
    return found.join(shards, "shard").select("doc", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids")


def token_file_digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """Per document, from files written and read again: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(df.sparkSession, "token-files")
    write_token_files(df, path, tokenizer)
    return read_token_files(df.sparkSession, path).select(
        F.col("doc").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
