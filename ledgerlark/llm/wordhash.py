"""64-bit hashes of words and word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20            # bytes hashed at once; a longer word makes its segment longer
_STEP = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_PLACE = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_REST = np.array([(1 << 8 * n) - 1 for n in range(1, 9)], dtype=np.uint64)      # the first n bytes of eight
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hash_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes' places of the words in ``raw``.

    Each eight bytes of a word go through a bijection that depends on their place before they are added: no
    algebra of the bytes survives, as it does in a polynomial modulo a power of two (Thue-Morse words).
    """
    data = np.frombuffer(raw, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(~_BLANK[data], prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    overlapping = np.ndarray(len(raw), dtype="<u8", buffer=raw + bytes(8), strides=(1,))
    parts = (sizes + 7) >> 3
    first = np.cumsum(parts) - parts
    number = np.arange(int(parts.sum())) - np.repeat(first, parts)
    eights = overlapping[np.repeat(starts, parts) + 8 * number]
    last = first + parts - 1
    eights[last] &= _REST[(sizes - 1) & 7]
    mixed = mix(eights ^ mix((number + 1).astype(np.uint64) * _STEP))
    return mix(np.add.reduceat(mixed, first) + mix(sizes.astype(np.uint64))), starts


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text."""
    hashes, counts = [], np.zeros(len(texts), dtype=np.int64)
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) + 1 <= SEGMENT):
            size += len(texts[stop]) + 1
            stop += 1
        if stop == at + 1 and size > SEGMENT:
            for piece in _cut(texts[at]):
                found, _ = _hash_segment(piece)
                hashes.append(found)
                counts[at] += len(found)
        else:
            found, starts = _hash_segment(b"\n".join(texts[at:stop]))
            begins = np.cumsum([0] + [len(t) + 1 for t in texts[at:stop - 1]])
            counts[at:stop] = np.diff(np.searchsorted(starts, np.append(begins, size)))
            hashes.append(found)
        at = stop
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), counts


def _cut(text: bytes):
    """Parts of a long text, cut at blanks."""
    start = 0
    while start < len(text):
        end = start + SEGMENT
        if end < len(text):
            while end < len(text) and not _BLANK[text[end]]:
                end += 1
        yield text[start:end]
        start = end


def shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each text; of a shorter text, its whole sequence."""
    hashes, counts = hash_words(texts)
    rolled = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled += hashes[k:k + len(rolled)] * _PLACE[k]
    rolled = mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(rolled[at:at + n - size + 1]))
        elif n:
            out.append(mix((hashes[at:at + n] * _PLACE[:n]).sum(keepdims=True) + _PLACE[-1:] * np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out
