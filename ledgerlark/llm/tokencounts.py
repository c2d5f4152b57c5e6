"""Token counts of fields and sections from one encoding of the whole text (operator 6).

A document is encoded once. The byte lengths of its tokens give their places, sections are intervals that tile the text,
and a sorted search joins the two. A token that reaches over the end of a section is counted once, by a rule:
``start`` gives it to the section of its first byte, ``end`` to that of its last, ``most`` to the one with most of
its bytes (the first of equals). So the counts of the sections always add up to the tokens of the document.

Defined cases. A null text counts as empty; an empty text is one empty section without tokens. Rows are handled one by one,
so repeated rows give repeated results. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import record, slices
from .tokenfiles import byte_bpe

RULES = ("start", "end", "most")


def attribute(begins: np.ndarray, ends: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and tokens over its end, from the tokens' [begin, end) and the ascending section starts."""
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, np.maximum(ends - 1, begins), side="right") - 1
    owner = last if rule == "end" else first
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        owner = owner.copy()
        limits = np.append(starts, ends[-1] if len(ends) else 0)
        for t in crossing.tolist():
            sections = np.arange(first[t], last[t] + 1)
            inside = np.minimum(limits[sections + 1], ends[t]) - np.maximum(limits[sections], begins[t])
            owner[t] = sections[np.argmax(inside)]
    return np.bincount(owner, minlength=len(starts)), np.bincount(first[crossing], minlength=len(starts))


def _counted(rows: DataFrame, tokenizer: str, rule: str, separator: str | None) -> DataFrame:
    """(doc, section, n_chars, n_tokens, n_crossing) of rows (doc, text, sizes); sections are cut after each separator,
    or have the byte lengths in ``sizes``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    kind = rows.schema["doc"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_bpe(tokenizer)
        for batch in batches:
            target = pa.schema([("doc", batch.schema.field("doc").type), ("section", pa.int64()), ("n_chars", pa.int64()),
                                ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                given = part.column("sizes").to_pylist() if separator is None else [None] * len(texts)
                owners, sections, chars, tokens, crossing = [], [], [], [], []
                for n, (text, coded, sizes) in enumerate(zip(texts, own.encode(texts), given)):
                    if separator is None:
                        raw, at, pieces = text.encode(), 0, []
                        for size in sizes:
                            pieces.append(raw[at:at + size].decode())
                            at += size
                    else:
                        pieces = [p + separator for p in text.split(separator)]
                        pieces[-1] = pieces[-1][:len(pieces[-1]) - len(separator)]
                        sizes = [len(p.encode()) for p in pieces]
                    ends = np.cumsum(own.lengths[np.frombuffer(coded, dtype=own.kind)])
                    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                    starts = np.cumsum([0, *sizes[:-1]]) if sizes else np.zeros(1, dtype=np.int64)
                    found, over = attribute(begins, ends, starts, rule)
                    owners.append(np.full(len(found), n))
                    sections.append(np.arange(len(found)))
                    chars.extend(map(len, pieces) if pieces else [0])
                    tokens.append(found)
                    crossing.append(over)
                if owners:
                    yield record(target, part.column("doc").take(pa.array(np.concatenate(owners))), pa.array(np.concatenate(sections)),
                                 chars, pa.array(np.concatenate(tokens)), pa.array(np.concatenate(crossing)))

    return rows.mapInArrow(work, f"doc {kind}, section long, n_chars long, n_tokens long, n_crossing long")


def count_sections(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", separator: str = "\n",
                   rule: str = "start") -> DataFrame:
    """(doc, section, n_chars, n_tokens, n_crossing) for each part of ``text`` up to and with a separator, from 0."""
    rows = df.select(F.col(id_col).alias("doc"), F.col(text).alias("text"))
    return _counted(rows, tokenizer, rule, separator)


def count_fields(df: DataFrame, tokenizer: str, fields: list[str], id_col: str | Column = "doc_id", joint: str = "\n",
                 rule: str = "start") -> DataFrame:
    """The same for columns that are encoded as one text, each followed by ``joint`` but the last; a null field is empty."""
    ident = F.col(id_col) if isinstance(id_col, str) else id_col
    filled = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    sizes = [F.octet_length(c) + (len(joint.encode()) if n < len(fields) - 1 else 0) for n, c in enumerate(filled)]
    rows = df.select(ident.alias("doc"), F.concat_ws(joint, *filled).alias("text"), F.array(*sizes).alias("sizes"))
    return _counted(rows, tokenizer, rule, None)


def section_rows(df: DataFrame, tokenizer: str) -> DataFrame:
    """Per document and line: doc_id, section, n_chars, n_tokens, n_crossing."""
    return count_sections(df, tokenizer).withColumnRenamed("doc", "doc_id")
