"""Static range asymmetric numeral coding of token ids with interleaved lanes, in numpy.

A block is coded by up to 1,024 lanes at once: token t belongs to lane t mod lanes, and every step codes one token per
lane. Lanes have 64-bit states and share one stream of 32-bit words. Checkpoints hold the states and the place
in the stream at regular steps, so parts of a block can be decoded side by side; each part has a checksum.

Block layout, little-endian: magic "LRAN", u32 precision, lanes, tokens, steps per part, parts, words;
per part u32 first word, u32 crc32 of its ids (as unsigned 32-bit); u32 crc32 of all that follows;
per part the u64 states of all lanes; the u32 words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LRAN"
LANES = 1024
TOKENS_PER_LANE = 64       # fewer lanes in blocks with fewer tokens
PART_STEPS = 64
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4s6I")


class Table:
    """Token frequencies scaled to ``1 << precision``; every token with a count keeps at least one slot."""

    def __init__(self, tokens: np.ndarray, slots: np.ndarray, precision: int):
        self.tokens, self.slots, self.precision = tokens.astype(np.uint32), slots.astype(np.uint64), precision
        self.starts = np.concatenate(([0], np.cumsum(slots)[:-1])).astype(np.uint64)
        self.place = np.zeros(int(tokens.max()) + 1 if len(tokens) else 1, dtype=np.int32)
        self.place[tokens] = np.arange(len(tokens))
        # By slot, for decoding: the token's number, its slots, and the place of the slot among them.
        self.of_slot = np.repeat(np.arange(len(tokens), dtype=np.int32), slots)
        self.share = np.asarray(slots, dtype=np.int32)[self.of_slot]
        self.within = np.arange(len(self.of_slot), dtype=np.int32) - self.starts.astype(np.int32)[self.of_slot]

    @classmethod
    def from_counts(cls, tokens: np.ndarray, counts: np.ndarray, precision: int = 17) -> Table:
        order = np.argsort(tokens)
        tokens, counts = np.asarray(tokens)[order], np.asarray(counts, dtype=np.float64)[order]
        while len(tokens) > 1 << (precision - 2):
            precision += 1
        if precision > 30:
            raise ValueError("too many different tokens for one table")
        if not len(tokens):
            return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), precision)
        free = (1 << precision) - len(tokens)
        share = counts / counts.sum() * free
        slots = 1 + np.floor(share).astype(np.int64)
        left = (1 << precision) - int(slots.sum())
        slots[np.argsort(np.floor(share) - share, kind="stable")[:left]] += 1
        return cls(tokens, slots, precision)


def encode(ids: np.ndarray, table: Table) -> bytes:
    """A block from ids, all of which the table must know."""
    n = len(ids)
    lanes = min(LANES, max(1, n // TOKENS_PER_LANE))
    steps = -(-n // lanes)
    places = table.place[ids]
    slots, starts = table.slots[places], table.starts[places]
    shift = np.uint64(table.precision)
    limit = slots << np.uint64(63 - table.precision)
    state = np.full(lanes, _LOW, dtype=np.uint64)
    words: list[np.ndarray] = [np.zeros(0, np.uint32)] * steps
    marks: list[np.ndarray] = []
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        x = state[:at.stop - at.start]
        full = np.flatnonzero(x >= limit[at])
        spilled = x[full]
        words[step] = spilled.astype(np.uint32)
        x[full] = spilled >> np.uint64(32)
        f = slots[at]
        whole = x // f
        x[:] = (whole << shift) + (x - whole * f) + starts[at]
        if step % PART_STEPS == 0:
            marks.append(state.copy())
    marks.reverse()
    firsts = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.uint32)
    parts = [struct.pack("<II", firsts[p * PART_STEPS], zlib.crc32(
        ids[p * PART_STEPS * lanes:(p + 1) * PART_STEPS * lanes].astype("<u4").tobytes())) for p in range(len(marks))]
    body = b"".join(m.astype("<u8").tobytes() for m in marks) + b"".join(w.astype("<u4").tobytes() for w in words)
    head = _HEAD.pack(MAGIC, table.precision, lanes, n, PART_STEPS, len(marks), int(firsts[-1]))
    return head + b"".join(parts) + struct.pack("<I", zlib.crc32(body)) + body


def parts_of(block: bytes) -> int:
    return _HEAD.unpack_from(block)[5]


def decode(block: bytes, table: Table, first: int = 0, count: int | None = None) -> np.ndarray:
    """The ids of ``count`` parts from part ``first`` on; of the whole block by default. Raises on damage."""
    magic, precision, lanes, n, part_steps, parts, n_words = _HEAD.unpack_from(block)
    if magic != MAGIC or precision != table.precision:
        raise ValueError("not a block of this table")
    at = _HEAD.size
    index = np.frombuffer(block, "<u4", 2 * parts, at).reshape(-1, 2)
    at += 8 * parts
    body = memoryview(block)[at + 4:]
    if struct.unpack_from("<I", block, at)[0] != zlib.crc32(body):
        raise ValueError("damaged block")
    # States stay below 2**63, so signed integers do, and they need no conversion to be places in the table.
    states = np.frombuffer(body, "<i8", parts * lanes).reshape(-1, lanes) if parts else np.zeros((0, lanes), np.int64)
    words = np.frombuffer(body, "<u4", n_words, 8 * parts * lanes).astype(np.int64)
    last = parts if count is None else min(parts, first + count)
    base = first * part_steps * lanes
    out = np.zeros(max(0, min(n, last * part_steps * lanes) - base), dtype=np.int32)
    mask, floor = (1 << precision) - 1, int(_LOW)
    for part in range(first, last):
        state, word = states[part].astype(np.int64), int(index[part, 0])
        for step in range(part * part_steps, min((part + 1) * part_steps, -(-n // lanes))):
            begin, end = step * lanes, min(n, (step + 1) * lanes)
            x = state[:end - begin]
            low = x & mask
            out[begin - base:end - base] = table.of_slot[low]
            x >>= precision
            x *= table.share[low]
            x += table.within[low]
            short = np.flatnonzero(x < floor)
            x[short] = x[short] << 32 | words[word:word + len(short)]
            word += len(short)
    ids = table.tokens[out] if len(out) else np.zeros(0, np.uint32)
    for part in range(first, last):
        piece = ids[part * part_steps * lanes - base:(part + 1) * part_steps * lanes - base]
        if zlib.crc32(piece.astype("<u4").tobytes()) != index[part, 1]:
            raise ValueError("damaged part")
    return ids
