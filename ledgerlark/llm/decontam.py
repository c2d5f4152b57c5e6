"""Benchmark decontamination with one Aho-Corasick automaton over test-item windows (operator 9).

Items and documents become sequences of normalised words. All windows of all items form one automaton over
word numbers; each document is scanned once, and the words inside any match are mapped back to character
offsets of the original text. Items reach the tasks in blocks of bounded size; a benchmark beyond one block
is scanned block after block, with the documents written in between, so no item is left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.session import materialise

from .batches import fresh, slices

WINDOW = 10
BLOCK_CHARS = 8_000_000    # characters of items in one automaton

#: Bytes to lower-cased word bytes: digits, letters and all bytes of non-ASCII characters; others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Windows:
    """An automaton over the word windows of (item, text) pairs."""

    def __init__(self, items: tuple[tuple[str | None, str | None], ...], window: int):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            sequence = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            for at in range(max(1, len(sequence) - window + 1) if sequence else 0):
                owners.setdefault(tuple(sequence[at:at + window]), set()).add(item)
        self.shortest = min(map(len, owners), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for sequence, found in owners.items():
            self.automaton.add_word(sequence, (len(sequence), frozenset(found)))
        if owners:
            self.automaton.make_automaton()

    def scan(self, sequence: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs of hit words as (first, last), and the items met."""
        if not self.shortest or len(sequence) < self.shortest:
            return [], set()
        get = self.numbers.get
        numbers = tuple([get(w, 0) for w in sequence])
        runs: list[tuple[int, int]] = []
        items: set = set()
        for end, (length, owners) in self.automaton.iter(numbers):
            items |= owners
            first = end - length + 1
            while runs and runs[-1][0] >= first:       # a longer window that ends later covers earlier runs
                runs.pop()
            if runs and first <= runs[-1][1] + 1:
                first = runs.pop()[0]
            runs.append((first, end))
        return runs, items


@functools.lru_cache(maxsize=1)
def _windows(items: tuple, window: int) -> Windows:
    return Windows(items, window)


def _offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets [begin, end) in ``text`` of runs of words."""
    raw = text.encode()
    inside = np.frombuffer(raw.translate(WORD_BYTES), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    return [(int(chars[edges[2 * a]]), int(chars[edges[2 * b + 1]])) for a, b in runs]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


_SPAN = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])


def _scan(df: DataFrame, items: tuple, window: int, text: str, names: tuple[str, str, str], more: bool) -> DataFrame:
    n_words, spans, hit = names
    fields = [f for f in df.schema if f.name not in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += f", `{n_words}` long, `{spans}` array<struct<first_word:long,last_word:long,begin:long,end:long>>, `{hit}` array<string>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _windows(items, window)
        for batch in batches:
            for part in slices(batch, text):
                counts, all_spans, all_items = [], [], []
                before = part.select([spans, hit]).to_pylist() if more else None
                for n, whole in enumerate(part.column(text).to_pylist()):
                    sequence = words(whole)
                    runs, found = own.scan(sequence)
                    if before:
                        runs = _merged(runs + [(s["first_word"], s["last_word"]) for s in before[n][spans]])
                        found = found.union(before[n][hit])
                    counts.append(len(sequence))
                    all_items.append(sorted(i for i in found if i is not None))
                    all_spans.append([dict(zip(("first_word", "last_word", "begin", "end"), (*run, *at)))
                                      for run, at in zip(runs, _offsets(whole, runs) if runs else ())])
                rest = part.drop_columns([n for n in names if n in part.schema.names])
                added = [pa.array(counts, pa.int64()), pa.array(all_spans, pa.list_(_SPAN)), pa.array(all_items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*rest.columns, *added], schema=pa.schema(
                    [*rest.schema, *(pa.field(n, a.type) for n, a in zip(names, added))]))

    return df.mapInArrow(work, schema)


def find_leaks(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               n_words: str = "n_words", spans: str = "leak_spans", hit: str = "leak_items", window: int = WINDOW,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Add to each row its number of words, the leaked runs of words with character offsets, and the item ids met.

    A window is ``window`` consecutive words of an item, or a whole shorter item. Null or empty texts have no
    words and no hits; items without words match nothing; an item without id marks words and is not listed;
    repeated items count once. Without items nothing is hit; without documents the result is empty. Columns
    named like an output are replaced.
    """
    names = (n_words, spans, hit)
    df = df.drop(*[n for n in names if n in df.columns])
    source = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("words")).filter(
        F.length("words") > 0)
    total = source.agg(F.sum(F.length("words")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_chars))
    for block in range(blocks):
        part = source.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        rows = tuple(sorted(((r["item"], r["words"]) for r in part.distinct().collect()), key=repr))
        df = _scan(df, rows, window, text, names, more=block > 0)
        if block < blocks - 1:
            df = materialise(df, "leaks")
    return df


def clean_rows(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` without any leaked window, with the columns of ``df``."""
    n_words, spans, hit = fresh(df, "n_words", "leak_spans", "leak_items")
    found = find_leaks(df, items, text, n_words=n_words, spans=spans, hit=hit)
    return found.filter(F.size(spans) == 0).select([F.col(f"`{c}`") for c in df.columns])


def leak_digests(df: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_leaks(df.select("doc_id", "text"), items)
    n_hit = F.aggregate("leak_spans", F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("leak_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("leak_items", ","), 256).alias("items_sha256"),
                        (F.size("leak_spans") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
met AS (SELECT p.doc_id, p.n, p.i, v.item_id FROM places p JOIN windows v ON p.n = v.n AND p.win = v.win),
hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, n, i FROM met)) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
