"""Ranked lexical search by the best position algorithm over impact lists (operator 12).

1. A first scan counts documents, terms and, for the terms of the items, document frequencies: a few numbers per term.
2. A second scan ranks. A task collects the postings of its documents in chunks of bounded size. A chunk has for each term
   an impact list, ordered by falling impact, and direct access from a document to its position in the list. All lists of an item are
   read in parallel, some positions at a time; each document met is scored at once by direct accesses, which mark its
   positions as seen in every list. The best position of a list ends its unbroken run of seen positions; no unseen document can
   score above the weighted sum of the impacts there. Reading stops when that sum is strictly below the k-th score, so equal scores are never lost.
   The k-th score goes on from chunk to chunk.
3. Each task returns at most k rows an item; two rounds of ranking, the first one salted, leave k.

Items come to the driver in blocks of ``BLOCK_CHARS`` characters, each of which takes its own two scans. Nothing else
about items or documents is collected or broadcast, and no text is shuffled or written.

Defined cases. Null or empty texts, and those of separators alone, have no term: they do not count and are never found. Items without terms have no
rows. Every row of the documents is a document, every row of the items an item, also if ids repeat; documents without id come last among equal scores.
Very long texts are read whole. Empty tables give an empty result. Only the named columns are read, so further ones cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.session import materialise

from .batches import record, slices

K = 20
BLOCK_CHARS = 1_000_000
CHUNK_POSTINGS = 1 << 21   # postings of a chunk; a single document may hold more
STEP = 64                  # positions of each list in the first round; each round reads twice as many
DENSE = 8                  # lists of at least one in so many documents answer direct accesses from an array
SALTS = 64

#: Letters, digits and all beyond ASCII stay, A-Z become small, the rest separates.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(texts: pa.Array) -> pa.ListArray:
    """The terms of each text in order, with empty strings between separators."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return pa.array([], pa.list_(pa.string()))
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = memoryview(data)[places[0]:places[-1]].tobytes() if data else b""
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(places - places[0]), pa.py_buffer(raw.translate(_TERM_BYTES)))
    return pc.split_pattern(plain, " ")


def postings(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text; and text, term number and occurrences of each posting, in this order."""
    split = terms(texts)
    owner = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    flat = split.flatten()
    lengths = np.bincount(owner[pc.not_equal(flat, "").to_numpy(zero_copy_only=False)], minlength=len(texts))
    codes = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy()
    known = codes >= 0
    keys, counts = np.unique(owner[known] * max(1, len(vocabulary)) + codes[known], return_counts=True)
    return lengths, keys // max(1, len(vocabulary)), keys % max(1, len(vocabulary)), counts


def _statistics(df: DataFrame, vocabulary: tuple[str, ...]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, documents that hold each term of ``vocabulary``."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(vocabulary, pa.string())
        counts = np.zeros(len(words) + 2, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                lengths, _, codes, _ = postings(part.column("text"), words)
                counts[:-2] += np.bincount(codes, minlength=len(words))
                counts[-2:] += (np.count_nonzero(lengths), lengths.sum())
        held = np.flatnonzero(counts)
        yield record(schema, pa.array(held), pa.array(counts[held]))

    total = np.zeros(len(vocabulary) + 2, dtype=np.int64)
    found = df.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in found.collect():                    # a row per term of the block of items, and two more
        total[row["term"]] = row["n"]
    return int(total[-2]), int(total[-1]), total[:-2]


class _List:
    """An impact list: documents of a chunk by falling impact, with direct access."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        self.docs, self.impacts = docs, impacts
        if len(docs) * DENSE >= n_docs:
            self.places = np.full(n_docs, -1, dtype=np.int32)
            self.places[docs] = np.arange(len(docs), dtype=np.int32)
        else:
            self.places = None
            self.order = np.argsort(docs)
            self.sorted = docs[self.order]

    def positions(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``docs`` the list holds (their places in ``docs``), and at which positions."""
        if self.places is not None:
            at = self.places[docs]
            held = np.flatnonzero(at >= 0)
            return held, at[held]
        at = np.minimum(np.searchsorted(self.sorted, docs), len(self.sorted) - 1)
        held = np.flatnonzero(self.sorted[at] == docs)
        return held, self.order[at[held]]


class Top:
    """The best k (score, id) pairs of an item so far."""

    def __init__(self, k: int):
        self.k, self.pairs = k, []

    @property
    def kth(self) -> int:
        """The k-th score, 0 while there are fewer."""
        return self.pairs[-1][0] if len(self.pairs) == self.k else 0

    def add(self, scores: np.ndarray, docs: np.ndarray, chunk: "Chunk") -> None:
        good = np.flatnonzero((scores > 0) & (scores >= self.kth))
        if len(good):
            good = good[np.lexsort((chunk.ranks[docs[good]], -scores[good]))[:self.k]]
            self.pairs += zip(scores[good].tolist(), chunk.ids.take(pa.array(docs[good])).to_pylist())
            self.pairs.sort(key=lambda p: (-p[0], p[1] is None, 0 if p[1] is None else p[1]))
            del self.pairs[self.k:]


class Chunk:
    """Impact lists of some documents."""

    def __init__(self, ids: pa.Array, lengths: np.ndarray, docs: np.ndarray, codes: np.ndarray, counts: np.ndarray,
                 n_docs: int, n_terms: int):
        self.ids = ids
        self.ranks = np.empty(len(ids), dtype=np.int64)
        self.ranks[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))      # nulls at the end
        m = 75 + (25 * lengths * n_docs) // n_terms
        impacts = (1_000_000_000 * counts) // (1000 * counts + 12 * m[docs])
        order = np.lexsort((docs, -impacts, codes))
        self.codes, self.docs, self.impacts = codes[order], docs[order], impacts[order]
        self.lists: dict[int, _List | None] = {}

    def list_of(self, code: int) -> _List | None:
        if code not in self.lists:
            a, b = np.searchsorted(self.codes, [code, code + 1])
            self.lists[code] = _List(self.docs[a:b], self.impacts[a:b], len(self.ids)) if b > a else None
        return self.lists[code]

    def search(self, query: list[tuple[int, int]], top: Top) -> int:
        """Bring ``top`` up to the documents of this chunk; ``query`` has (term, weight). Returns the documents scored."""
        lists = [(found, weight) for code, weight in query if weight > 0 and (found := self.list_of(code)) is not None]
        seen = [np.zeros(len(found.docs), dtype=bool) for found, _ in lists]
        best = [0] * len(lists)                    # length of the unbroken run of seen positions
        scored = np.zeros(len(self.ids), dtype=bool)
        depth, step, n_scored = 0, STEP, 0
        while any(b < len(s) for b, s in zip(best, seen)):
            docs = np.concatenate([found.docs[depth:depth + step] for found, _ in lists])
            docs = np.unique(docs[~scored[docs]])
            scored[docs] = True
            n_scored += len(docs)
            scores = np.zeros(len(docs), dtype=np.int64)
            for (found, weight), marks in zip(lists, seen):
                held, at = found.positions(docs)
                scores[held] += weight * found.impacts[at]
                marks[at] = True
            top.add(scores, docs, self)
            limit = 0
            for n, ((found, weight), marks) in enumerate(zip(lists, seen)):
                if best[n] < len(marks):
                    gap = int(np.argmin(marks[best[n]:]))
                    best[n] = len(marks) if marks[best[n] + gap] else best[n] + gap
                    if best[n] < len(marks):
                        limit += weight * int(found.impacts[best[n] - 1])
            if limit < top.kth:
                break
            depth, step = depth + step, 2 * step
        return n_scored


def _ranked(df: DataFrame, vocabulary: tuple[str, ...], queries: list[tuple[int, list[tuple[int, int]]]], n_docs: int, n_terms: int,
            k: int) -> DataFrame:
    """(item, doc, score): at most k rows of each item from every task."""
    kind = df.schema["doc"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(vocabulary, pa.string())
        tops = {item: Top(k) for item, _ in queries}
        parts: list[tuple] = []
        held = docs = 0
        doc_type = None

        def flush() -> None:
            ids, lengths, owners, codes, counts = (list(c) for c in zip(*parts))
            chunk = Chunk(pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(owners), np.concatenate(codes),
                          np.concatenate(counts), n_docs, n_terms)
            for item, query in queries:
                chunk.search(query, tops[item])
            parts.clear()

        for batch in batches:
            doc_type = batch.schema.field("doc").type
            for part in slices(batch, "text"):
                lengths, owners, codes, counts = postings(part.column("text"), words)
                if len(owners):
                    used, places = np.unique(owners, return_inverse=True)
                    parts.append((part.column("doc").take(pa.array(used)), lengths[used], places + docs, codes, counts))
                    held, docs = held + len(owners), docs + len(used)
                if held >= CHUNK_POSTINGS:
                    flush()
                    held = docs = 0
        if parts:
            flush()
        rows = [(item, doc, score) for item, top in tops.items() for score, doc in top.pairs]
        if rows:
            yield record(pa.schema([("item", pa.int64()), ("doc", doc_type), ("score", pa.int64())]), *map(list, zip(*rows)))

    return df.mapInArrow(work, f"item long, doc {kind}, score long")


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list]:
    """Rows (item_id, words) of ``items`` that have text, in blocks of about ``block_chars`` characters."""
    source = items.filter(F.length("words") > 0)
    total = source.agg(F.sum(F.length("words")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_chars)
    for block in range(blocks):
        part = source.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block) if blocks > 1 else source
        yield sorted(part.collect(), key=repr)


def search(documents: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of each item with the highest scores above 0, all if fewer.

    The weight of a term is floor(1000 ln((2N+2)/(2df+1))); its impact in a document of n terms is 10^9 tf div (1000 tf +
    12 m) with m = 75 + 25 n N div L; a score is the sum of weight times impact over the terms of the item, repeats included.
    """
    df = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("words"))
    kind = wanted.schema["item_id"].dataType.simpleString()
    spark, found = documents.sparkSession, None
    for rows in _blocks(wanted, block_chars):
        lists = [[w for w in split if w] for split in terms(pa.array([r["words"] for r in rows], pa.string())).to_pylist()]
        vocabulary = tuple(sorted({w for words in lists for w in words}))
        n_docs, n_terms, held = _statistics(df, vocabulary)
        if not n_docs:
            continue
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)
        number = {w: n for n, w in enumerate(vocabulary)}
        queries = [(n, [(number[w], int(weights[number[w]]) * times) for w, times in sorted(Counter(words).items())])
                   for n, words in enumerate(lists) if words]
        ranked = _ranked(df, vocabulary, queries, n_docs, n_terms, k)
        salted = ranked.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
        best = _first(_first(salted, ["item", "salt"], k).drop("rank"), ["item"], k)
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(rows)], f"item long, item_id {kind}")
        part = best.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
        if found is not None:
            found = materialise(found, "ranked")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {df.schema['doc'].dataType.simpleString()}, score long")
    return found


def search_rows(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per item and rank: item_id, rank, doc_id, score."""
    return search(documents, items)


SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM sizes),
wanted AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), whole
    GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
