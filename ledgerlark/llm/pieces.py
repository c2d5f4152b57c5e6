"""SentencePiece BPE encoding by backtracking over Aho-Corasick matches, and decoding (operator 7).

A BPE encoding is the only sequence of pieces whose neighbours all stay apart when the two texts are joined
and merged anew. So instead of merging a text from its characters, the encoder walks over it with the longest
matching piece, accepts a piece only if it is compatible with the one before, and otherwise tries the next
shorter match or takes the last piece back. Positions from which no way leads on are marked in a bitfield
and never tried again, so the work is linear in the text.

No piece holds the space mark after another character, hence text falls into independent chunks (a word with
the space marks before it). Chunks are remembered per Python worker in a cache of bounded size.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import RecentCache, fresh, slices

CHUNK_CACHE = 400_000     # chunks per generation of a worker's cache
PAIR_CACHE = 1_000_000    # remembered compatibility checks
MATCH_BLOCK = 4096        # characters whose matches are held at once
SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6   # piece types of the model format


class _Matches:
    """For each position, the pieces that begin there, shortest first; computed in blocks, the last two are kept."""

    def __init__(self, text: str, automaton, longest: int):
        self.text, self.automaton, self.longest = text, automaton, longest
        self.blocks: dict[int, list] = {}

    def __getitem__(self, position: int) -> list:
        number, inside = divmod(position, MATCH_BLOCK)
        block = self.blocks.get(number)
        if block is None:
            start = number * MATCH_BLOCK
            part = self.text[start:start + MATCH_BLOCK + self.longest - 1]
            block = self.blocks[number] = _by_start(part, self.automaton)[:MATCH_BLOCK]
            while len(self.blocks) > 2:
                del self.blocks[min(self.blocks, key=lambda n: -abs(n - number))]
        return block[inside]


def _by_start(text: str, automaton) -> list[list[tuple[int, int]]]:
    found: list[list[tuple[int, int]]] = [[] for _ in text]
    for end, match in automaton.iter(text):
        found[end - match[1] + 1].append(match)
    return found


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(model_path, "rb") as file:
            content = file.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(content)
        self.library = SentencePieceProcessor(model_proto=content)
        self.pieces = [p.piece for p in model.pieces]
        self.scores = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self._check(model)
        self.code = "H" if len(self.pieces) <= 1 << 16 else "I"
        self.longest = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            self.automaton.add_word(piece, (number, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.chunks = RecentCache(CHUNK_CACHE)

    def _check(self, model) -> None:
        """Refuse models for which splitting into chunks or backtracking would not be exact."""
        n = model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or len(self.bytes) != 256 or n.precompiled_charsmap or not n.add_dummy_prefix
                or n.remove_extra_whitespaces or not n.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
                or any(p.type not in (_NORMAL, _UNKNOWN, _CONTROL, _BYTE) for p in model.pieces)):
            raise ValueError("needs a BPE model with byte fallback, a space prefix and no text normalisation")
        if any(SPACE in p.lstrip(SPACE) or any(c not in self.ids for c in p) for p in self.ids):
            raise ValueError("a piece crosses a word start or holds a character that is no piece")

    def merge(self, text: str) -> list[int]:
        """Pieces of a short text by merging the best-scored neighbours, the leftmost of equals first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart when their joined text is merged anew."""
        if left < 0 or right < 0:        # a character outside the vocabulary merges with nothing
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.pieces[left] + self.pieces[right]) == [left, right]
        return known

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of a text in which spaces are space marks already."""
        end = len(text)
        matches = (_by_start(text, self.automaton) if end <= MATCH_BLOCK
                   else _Matches(text, self.automaton, self.longest))
        open_positions = bytearray(b"\xff") * (end // 8 + 1)
        taken: list[tuple[int, int, int]] = []       # piece, where it begins, which of the matches there
        position, left = 0, -1
        options = matches[0] if end else []
        choice = len(options) - 1
        while position < end:
            if not options:                          # unknown character
                options, choice = [(-1 - ord(text[position]), 1)], 0
            while choice >= 0:
                piece, length = options[choice]
                after = position + length
                if open_positions[after >> 3] >> (after & 7) & 1 and self.compatible(left, piece):
                    break
                choice -= 1
            if choice >= 0:
                taken.append((piece, position, choice))
                position, left = after, piece
                if position < end:
                    options = matches[position]
                    choice = len(options) - 1
            else:
                open_positions[position >> 3] &= ~(1 << (position & 7)) & 0xFF
                _, position, choice = taken.pop()
                left = taken[-1][0] if taken else -1
                options = matches[position]
                choice -= 1
        out = []
        for piece, _, _ in taken:
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in chr(-1 - piece).encode())
        return out

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; nothing for null or empty text."""
        if not text:
            return array(self.code)
        marked = text.replace(" ", SPACE)
        if SPACE + SPACE in marked or marked[-1] == SPACE or marked[0] == SPACE:
            keys = [c[1:] for c in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + marked)]
        else:
            keys = marked.split(SPACE)
        self.chunks.age()
        for key in self.chunks.missing(keys):
            self.chunks.new[key] = array(self.code, self.encode_chunk(SPACE + key)).tobytes()
        return array(self.code, b"".join(map(self.chunks.new.__getitem__, keys)))

    def decode(self, ids) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    """One codec per Python worker and model."""
    return PieceCodec(model_path)


def encode_pieces(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids",
                  decoded: str | None = "decoded") -> DataFrame:
    """Add ``ids`` array<int> and, unless its name is None, the ``decoded`` text to the rows of ``df``.

    Ids are those of the sentencepiece library without begin and end ids; the decoded text is what its
    ``decode`` makes of them. Null and empty texts have no ids and decode to the empty text. Rows are handled
    one by one, so repeated rows, ties and extra columns change nothing; columns of ``df`` named like an
    output are replaced. An empty table gives an empty table.
    """
    names = [ids] + ([decoded] if decoded else [])
    kept = df.drop(*[n for n in names if n != text]) if text not in names else df
    (source,) = fresh(kept, "piece_text")
    rows = kept.withColumn(source, F.col(text))
    rows = rows.drop(text) if text in names else rows
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != source)
    schema += f", `{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            for part in slices(batch, source):
                texts = part.column(part.schema.get_field_index(source)).to_pylist()
                encoded = [own.encode(t).tolist() for t in texts]
                rest = part.drop_columns([source])
                columns, fields = list(rest.columns), list(rest.schema)
                columns.append(pa.array(encoded, pa.list_(pa.int32())))
                fields.append(pa.field(ids, pa.list_(pa.int32())))
                if decoded:
                    columns.append(pa.array([own.decode(i) if i else "" for i in encoded], pa.string()))
                    fields.append(pa.field(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return rows.mapInArrow(work, schema)


def piece_digests(df: DataFrame, model_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = encode_pieces(df.select("doc_id", "text"), model_path, ids="ids", decoded="decoded").drop("text")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
