"""Licence wording by template markup compiled to token automata (operator 8).

A template is running text with optional regions ``<<optional>> ... <<end>>`` and replaceable regions ``<<any 12>>`` (up
to twelve words) or ``<<one of|words|here>>``; empty lines part its paragraphs. It becomes an automaton over words. Texts
are searched for the first words of the longest fixed run of each paragraph; around every place of them the automaton
runs to both ends, and the template is accepted only if all mandatory words of all paragraphs stand there exactly and
in order. Licences are written to their end, disclaimer included; names of holders and list marks may be replaced.

Defined cases. Null and empty texts have no words, no labels and score 0. Rows are handled one by one, so repeated
rows and ties change nothing; columns named like an output are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import fresh, slices
from .decontam import _SPAN, _offsets, words

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence wording, with markup for what may be missing or replaced.
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
    that the following conditions are met: <<any 1>> Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer. <<any 1>> Redistributions in binary form must reproduce
    the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<any 12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any 12>> BE
    LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
    PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
    ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
    ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES = {
    "apache-2.0-notice": "<<optional>>Licensed under<<end>> the Apache License, Version 2.0",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at <<any 8>> Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "bsd-2-clause": f"{_BSD_CONDITIONS}\n\n{_BSD_DISCLAIMER}",
    "bsd-3-clause": f"""{_BSD_CONDITIONS}

        <<any 1>> Neither the name of <<any 12>> nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission.

        {_BSD_DISCLAIMER}""",
    "cc-by-4.0-notice": "<<one of|licensed|released|available>> under <<optional>>a Creative Commons<<end>> CC BY 4.0",
    "cc-by-nc-4.0-notice": "<<one of|licensed|released|available>> under CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "<<one of|licensed|released|available>> under CC BY-SA 4.0",
    "gpl-3.0-notice": """<<optional>>This <<one of|work|program|file|software>> is<<end>> licensed under the GNU General Public
        License, version 3""",
    "gpl-header": """This program is free software<<optional>>:<<end>> you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either version <<any 1>> of the
        License, or <<optional>>(at your option)<<end>> any later version.

        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

        You should have received a copy of the GNU General Public License along with this program""",
    "isc": """Permission to use, copy, modify, and<<optional>>/or<<end>> distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

        THE SOFTWARE IS PROVIDED "AS IS" AND <<any 12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<any 12>> BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    "mit-notice": "<<one of|released|licensed|distributed|available>> under the <<optional>>terms of the<<end>> MIT License",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice <<optional>>(including the next paragraph)<<end>> shall be included in all copies or
        substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any 12>> BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}

ANCHOR_WORDS = 6           # fixed words that a place must show before an automaton is run there

_MARK = re.compile(r"<<(.*?)>>", re.S)


def _paragraphs(part: str) -> Iterator[bytes | None]:
    """Words, and None for each empty line."""
    for n, paragraph in enumerate(re.split(r"\n[ \t]*\n", part)):
        if n:
            yield None
        yield from words(paragraph)


class Template:
    """States 0..n in a row; from a state, edges (word or None for any word, next state) and free moves."""

    def __init__(self, label: str, markup: str):
        self.label = label
        self.edges: list[list[tuple[bytes | None, int, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        self.mandatory = 0
        open_at: list[int] = []
        # Per paragraph, its fixed runs: (state before, word) outside all regions.
        runs: list[list[list[tuple[int, bytes]]]] = [[[]]]
        met = [0]                                    # mandatory words before each paragraph
        for n, part in enumerate(_MARK.split(markup)):
            if n % 2 == 0:
                for word in _paragraphs(part):
                    if word is None:
                        runs.append([[]])
                        met.append(self.mandatory)
                        continue
                    if not open_at:
                        runs[-1][-1].append((len(self.edges) - 1, word))
                    self._word([word], not open_at)
                continue
            runs[-1].append([])
            kind, *rest = part.split("|")
            if kind == "optional":
                open_at.append(len(self.edges) - 1)
            elif kind == "end":
                self.free[open_at.pop()].append(len(self.edges) - 1)
            elif kind == "one of":
                self._word([w for x in rest for w in words(x)], not open_at)
            elif re.fullmatch(r"any \d+", kind):
                first = len(self.edges) - 1
                for _ in range(int(kind[4:])):
                    self._word([None], False)
                for state in range(first, len(self.edges) - 1):
                    self.free[state].append(len(self.edges) - 1)
            else:
                raise ValueError(f"unknown markup {part!r} in {label}")
        if open_at:
            raise ValueError(f"an optional region of {label} has no end")
        #: Per paragraph with fixed words: its anchor, the state before it, the anchor's words, and the paragraph's mandatory words.
        self.anchors: list[tuple[bytes, int, int, int]] = []
        for own, size in zip(runs, (b - a for a, b in zip(met, [*met[1:], self.mandatory]))):
            anchor = max(own, key=len)[:ANCHOR_WORDS]
            if anchor:
                self.anchors.append((b" " + b" ".join(w for _, w in anchor) + b" ", anchor[0][0], len(anchor), size))
        if not self.anchors:
            raise ValueError(f"{label} has no fixed words")
        self.anchor = self.anchors[0][0]
        self.back_edges: list[list[tuple[bytes | None, int, int]]] = [[] for _ in self.edges]
        self.back_free: list[list[int]] = [[] for _ in self.edges]
        for state, edges in enumerate(self.edges):
            for word, after, counted in edges:
                self.back_edges[after].append((word, state, counted))
            for after in self.free[state]:
                self.back_free[after].append(state)

    def _word(self, choices: list[bytes | None], mandatory: bool) -> None:
        state = len(self.edges)
        self.edges.append([])
        self.free.append([])
        self.edges[state - 1].extend((word, state, int(mandatory)) for word in choices)
        self.mandatory += mandatory

    def _run(self, sequence, state: int, goal: int, edges, free) -> tuple[int | None, int]:
        """Words used to reach ``goal`` from ``state`` (the most possible), None if it cannot be; most mandatory words met."""
        def closed(states: dict[int, int]) -> dict[int, int]:
            todo = list(states)
            while todo:
                at = todo.pop()
                for after in free[at]:
                    if states.get(after, -1) < states[at]:
                        states[after] = states[at]
                        todo.append(after)
            return states

        now = closed({state: 0})
        reached, most = (0 if goal in now else None), 0
        for used, word in enumerate(sequence, 1):
            following: dict[int, int] = {}
            for at, met in now.items():
                for expected, after, counted in edges[at]:
                    if expected is None or expected == word:
                        following[after] = max(following.get(after, -1), met + counted)
            if not following:
                break
            now = closed(following)
            most = max(most, *now.values())
            if goal in now:
                reached = used
        return reached, most

    def match(self, sequence: list[bytes], at: int, paragraph: int = 0) -> tuple[tuple[int, int] | None, float]:
        """(first, last) word of an accepted text around the paragraph's anchor at word ``at``, and the mandatory words met
        in order as a share of the paragraph's."""
        _, begin, length, mandatory = self.anchors[paragraph]
        end = len(self.edges) - 1
        behind = (sequence[n] for n in range(at - 1, -1, -1))
        ahead = (sequence[n] for n in range(at + length, len(sequence)))
        before, met_before = self._run(behind, begin, 0, self.back_edges, self.back_free)
        after, met_after = self._run(ahead, begin + length, end, self.edges, self.free)
        if before is not None and after is not None:
            return (at - before, at + length + after - 1), 1.0
        return None, min((length + met_before + met_after) / mandatory, 0.99)


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which ``phrase`` stands in ``joined``; both have single spaces around every word."""
    at, number, seen = joined.find(phrase), 0, 0
    while at >= 0:
        number += joined.count(b" ", seen, at)
        seen = at
        yield number
        at = joined.find(phrase, at + 1)


@functools.lru_cache(maxsize=2)
def compiled(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    return [Template(label, markup) for label, markup in templates]


def scan(text: str | None, templates: list[Template], phrases: dict[str, str]) -> tuple[int, list[tuple[str, bool, int, int]], float]:
    """Number of words; findings (label, whether of a phrase, first word, last word); score."""
    sequence = words(text)
    joined = b" " + b" ".join(sequence) + b" "
    found: set[tuple[str, bool, int, int]] = set()
    score = 0.0
    for phrase, label in phrases.items():
        expected = words(phrase)
        for at in _places(joined, b" " + b" ".join(expected) + b" "):
            found.add((label, True, at, at + len(expected) - 1))
            score = max(score, 0.5)
    for template in templates:
        for paragraph, (anchor, *_) in enumerate(template.anchors):
            for at in _places(joined, anchor):
                span, share = template.match(sequence, at, paragraph)
                score = max(score, share)
                if span:
                    found.add((template.label, False, *span))
    return len(sequence), sorted(found, key=lambda f: (f[2], f[3], f[0])), score


_FOUND = pa.struct([("label", pa.string()), ("base", pa.bool_()), *((f.name, f.type) for f in _SPAN)])


def find_licenses(df: DataFrame, text: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
                  n_words: str = "n_words", licenses: str = "licenses", score: str = "score") -> DataFrame:
    """Add the number of words, the findings with word and character places, and the score to each row.

    The score is 1 for an accepted template, else the largest share (at most 0.99) of a paragraph's mandatory words met in
    order around its fixed words, and at least 0.5 where a phrase stands.
    """
    names = (n_words, licenses, score)
    wording, phrases = tuple((TEMPLATES if templates is None else templates).items()), PHRASES if phrases is None else phrases
    rest = df.drop(*[n for n in names if n != text])
    (source,) = fresh(rest, "license_text")
    rows = rest.withColumn(source, F.col(text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != source)
    schema += (f", `{n_words}` long, `{licenses}` array<struct<label:string,base:boolean,first_word:long,last_word:long,"
               f"begin:long,end:long>>, `{score}` double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compiled(wording)
        for batch in batches:
            for part in slices(batch, source):
                counts, findings, scores = [], [], []
                for whole in part.column(source).to_pylist():
                    n, found, value = scan(whole, own, phrases)
                    places = _offsets(whole, [f[2:] for f in found]) if found else []
                    counts.append(n)
                    scores.append(value)
                    findings.append([dict(zip(_FOUND.names, (*f, *p))) for f, p in zip(found, places)])
                kept = part.drop_columns([source])
                added = [pa.array(counts, pa.int64()), pa.array(findings, pa.list_(_FOUND)), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*kept.columns, *added], schema=pa.schema(
                    [*kept.schema, *(pa.field(n, a.type) for n, a in zip(names, added))]))

    return rows.mapInArrow(work, schema)


def license_rows(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = find_licenses(df.select("doc_id", "text"))
    base = F.filter("licenses", lambda f: f["base"])
    listed = lambda f: F.array_join(F.array_sort(F.array_distinct(F.transform(f, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda f: f["first_word"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), listed(base).alias("base_labels"),
                        listed(F.col("licenses")).alias("labels"), "score")
