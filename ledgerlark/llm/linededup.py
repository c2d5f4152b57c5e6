"""Removal of lines that many documents share, as compressed keep bitmaps (operator 4).

Lines are reduced to 128-bit hashes of their keys. The hashes are range-partitioned and sorted by (hash,
document descending), so a task streams over each hash's documents in order and needs no memory for them: the
first document is the one that keeps its lines. A very frequent hash spreads over several ranges; what its
parts know (number of documents, first document) meets in a table of at most two rows per task. The result
is a bitmap of kept lines per changed document; texts are only touched when a bitmap is applied.

Defined cases. Null or empty text is one empty line. Rows with the same id count as one document; if their
texts differ, each has its own bitmap. A null id counts as one document below all others. An empty table
gives an empty result. Other columns are carried along untouched; those named like a count are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.session import materialise

from .batches import fresh, record, slices

MIN_CHARS = 40
MIN_DOCS = 5
BLANK = b" \t\n\x0b\x0c\r"
_DROP, _OPEN, _PART = 0, 1, 2     # rows of the streamed pass: a decided drop, an undecided line, what a range knows


def line_hashes(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document and long line key: hash (h1, h2), doc, digest of the text, positions of the line."""
    rows = df.select("doc", "digest", "text").filter(F.length("text") >= min_chars)
    schema = f"h1 long, h2 long, doc {rows.schema['doc'].dataType.simpleString()}, digest long, positions array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            doc_type = batch.schema.field("doc").type
            target = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", doc_type), ("digest", pa.int64()),
                                ("positions", pa.list_(pa.int32()))])
            for part in slices(batch, "text"):
                hashes, owners, positions = [], [], []
                for owner, text in enumerate(part.column("text").to_pylist()):
                    found: dict[bytes, list[int]] = {}
                    for at, line in enumerate(text.encode().lower().split(b"\n")):
                        if len(line) >= min_chars:
                            key = line.strip(BLANK)
                            if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                                found.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                    hashes.extend(found)
                    owners.extend([owner] * len(found))
                    positions.extend(found.values())
                halves = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
                own = pa.array(owners, pa.int64())
                yield record(target, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                             part.column("doc").take(own), part.column("digest").take(own), positions)

    return rows.mapInArrow(work, schema)


class _Run:
    """The rows of one hash within a range, met in order."""

    def __init__(self, key: tuple[int, int], leading: bool):
        self.key, self.leading = key, leading     # a leading run may go on from the range before
        self.docs, self.first, self.last = 0, None, object()
        self.waiting: list[tuple] = []             # rows seen before the run has enough documents

    def add(self, rows: list[dict], min_docs: int, out: list[tuple]) -> None:
        for row in rows:
            doc = row["doc"]
            if doc != self.last or not self.docs:
                self.docs += 1
                self.last = doc
                if self.docs == 1:
                    self.first = doc
                if self.docs == min_docs and not self.leading:
                    out.extend((_DROP, *self.key, *w, None) for w in self.waiting if w[0] != self.first)
                    self.waiting = []
            line = (doc, row["digest"], row["positions"])
            if self.leading:
                out.append((_OPEN, *self.key, *line, None))
            elif self.docs >= min_docs:
                out.append((_DROP, *self.key, *line, None))
            else:
                self.waiting.append(line)

    def close(self, out: list[tuple], trailing: bool) -> None:
        if self.leading or trailing:
            out.extend((_OPEN, *self.key, *w, None) for w in self.waiting)
            out.append((_PART, *self.key, self.first, None, None, self.docs))


def _stream(hashes: DataFrame, min_docs: int) -> DataFrame:
    kind = hashes.schema["doc"].dataType.simpleString()
    schema = f"kind int, h1 long, h2 long, doc {kind}, digest long, positions array<int>, docs long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, target = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            target = target or pa.schema([
                ("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc", batch.schema.field("doc").type),
                ("digest", pa.int64()), ("positions", pa.list_(pa.int32())), ("docs", pa.int64())])
            out: list[tuple] = []
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            edges = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
            starts = np.concatenate(([0], edges))
            ends = np.concatenate((edges, [len(h1)]))
            # A hash that is alone inside the batch is no repeated line; only longer runs and the batch's ends matter.
            wanted = np.flatnonzero(ends - starts > 1).tolist()
            for n in sorted({0, len(starts) - 1, *wanted}):
                a, b = int(starts[n]), int(ends[n])
                key = (int(h1[a]), int(h2[a]))
                if run is None or run.key != key:
                    if run is not None:
                        run.close(out, trailing=False)
                    run = _Run(key, leading=run is None)
                run.add(batch.slice(a, b - a).select(["doc", "digest", "positions"]).to_pylist(), min_docs, out)
            if out:
                yield record(target, *map(list, zip(*out)))
        if run is not None:
            out = []
            run.close(out, trailing=True)
            if out:
                yield record(target, *map(list, zip(*out)))

    return hashes.mapInArrow(work, schema)


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, digest, positions) of the lines to drop, from rows (doc, digest, text)."""
    hashes = materialise(line_hashes(docs, min_chars), "line-hashes")
    ranges = hashes.repartitionByRange("h1", "h2", F.col("doc").desc()).sortWithinPartitions(
        "h1", "h2", F.col("doc").desc())
    seen = materialise(_stream(ranges, min_docs), "line-runs")
    # At most two rows per range: those of its first and of its last hash.
    shared = (seen.filter(F.col("kind") == _PART).groupBy("h1", "h2")
              .agg(F.sum("docs").alias("n"), F.max("doc").alias("keeper")).filter(F.col("n") >= min_docs))
    lines = seen.filter(F.col("kind") == _OPEN).join(F.broadcast(shared), ["h1", "h2"])
    lines = lines.filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    columns = ["doc", "digest", "positions"]
    return seen.filter(F.col("kind") == _DROP).select(columns).unionAll(lines.select(columns))


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, digest, keep) for each changed document: ``keep`` is a zlib-compressed bitmap with one bit per line,
    the first line in the highest bit; lines beyond its end are kept."""
    lines = dropped_lines(docs, min_docs, min_chars)
    grouped = lines.groupBy("doc", "digest").agg(F.flatten(F.collect_list("positions")).alias("positions"))
    kind = docs.schema["doc"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = []
            for positions in batch.column("positions"):
                dropped = positions.values.to_numpy()
                bits = np.ones(int(dropped.max()) + 1, dtype=bool)
                bits[dropped] = False
                bitmaps.append(zlib.compress(np.packbits(np.pad(bits, (0, -len(bits) % 8), constant_values=True)).tobytes()))
            target = pa.schema([batch.schema.field("doc"), batch.schema.field("digest"), ("keep", pa.binary())])
            yield record(target, batch.column("doc"), batch.column("digest"), bitmaps)

    return grouped.mapInArrow(work, f"doc {kind}, digest long, keep binary")


def _applied(df: DataFrame, text: str, keep: str, n_lines: str, n_dropped: str) -> DataFrame:
    """Replace ``text`` by its kept lines, drop ``keep``, add the two counts."""
    fields = [f for f in df.schema if f.name != keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts, lines, dropped = part.column(text).to_pylist(), [], []
                for n, (whole, packed) in enumerate(zip(texts, part.column(keep).to_pylist())):
                    total = (whole or "").count("\n") + 1
                    lines.append(total)
                    if packed is None:
                        dropped.append(0)
                        continue
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8)).tolist()
                    kept = [x for at, x in enumerate(whole.split("\n")) if at >= len(bits) or bits[at]]
                    dropped.append(total - len(kept))
                    texts[n] = "\n".join(kept)
                rest = part.drop_columns([keep])
                rest = rest.set_column(rest.schema.get_field_index(text), text, pa.array(texts, pa.string()))
                columns = [*rest.columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                    [*rest.schema, pa.field(n_lines, pa.int64()), pa.field(n_dropped, pa.int64())]))

    return df.mapInArrow(work, f"{schema}, `{n_lines}` long, `{n_dropped}` long")


def drop_shared_lines(df: DataFrame, id_col: str | Column = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                      min_chars: int = MIN_CHARS, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """All rows of ``df`` with shared lines taken out of ``text``, and the line counts before and dropped.

    A line key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents stay only in the largest document.
    """
    df = df.drop(*[c for c in (n_lines, n_dropped) if c in df.columns])
    doc, digest, keep, other_doc, other_digest = fresh(df, "dedup_doc", "dedup_digest", "dedup_keep", "map_doc", "map_digest")
    ident = F.col(id_col) if isinstance(id_col, str) else id_col
    marked = df.withColumns({doc: ident, digest: F.xxhash64(F.col(text))})
    bitmaps = materialise(keep_bitmaps(marked.select(F.col(doc).alias("doc"), F.col(digest).alias("digest"),
                                                     F.col(text).alias("text")), min_docs, min_chars), "line-bitmaps")
    bitmaps = bitmaps.select(F.col("doc").alias(other_doc), F.col("digest").alias(other_digest), F.col("keep").alias(keep))
    # Both sides grow with the corpus: never a broadcast, the same plan at every size.
    joined = marked.join(bitmaps.hint("merge"), F.col(doc).eqNullSafe(F.col(other_doc)) & (F.col(digest) == F.col(other_digest)), "left")
    return _applied(joined.drop(doc, digest, other_doc, other_digest), text, keep, n_lines, n_dropped)


def clean_lines(df: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows of ``df`` without shared lines, with the columns of ``df``; ``n_chars``, if there, follows the text."""
    n_lines, n_dropped = fresh(df, "n_lines", "n_dropped")
    done = drop_shared_lines(df, text=text, n_lines=n_lines, n_dropped=n_dropped)
    if n_chars in df.columns:
        kind = df.schema[n_chars].dataType
        done = done.withColumn(n_chars, F.when(F.col(n_dropped) > 0, F.char_length(text).cast(kind)).otherwise(F.col(n_chars)))
    return done.select([F.col(f"`{c}`") for c in df.columns])


def line_digests(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    done = drop_shared_lines(df.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
    SELECT doc_id, i AS pos, parts[i] AS line,
           translate(regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT l.*, s.key IS NOT NULL AND l.doc_id <> s.keeper AS dropped
    FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
