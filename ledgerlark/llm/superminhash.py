"""SuperMinHash signatures of many sets at once.

Every element deals its ranks 0, 1, 2, ... to the registers in a random order of its own (a Fisher-Yates
shuffle); with rank j it offers a value in [j, j + 1) to one register, which keeps the smallest. A set is done
as soon as all its registers are below the next rank, so large sets need one or two rounds. Rounds run over
all elements of the sets that are not done yet.
"""

from __future__ import annotations

import numpy as np

from .wordhash import mix

REGISTERS = 320
ELEMENTS = 1 << 13           # elements whose shuffles are held at once (of more than one set)
_FRACTION = np.uint64((1 << 48) - 1)
_STEP = np.uint64(0xD1342543DE82EF95)


def signatures(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """One row of ``registers`` values per set; value >> 48 is the rank. Empty sets keep the largest value."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")          # sets of like size are done after like numbers of rounds
    out = np.full((len(sets), registers), np.iinfo(np.uint64).max, dtype=np.uint64)
    at = int(np.searchsorted(sizes[order], 1))
    while at < len(order):
        ends = np.cumsum(sizes[order[at:]])
        stop = at + max(1, int(np.searchsorted(ends, ELEMENTS, side="right")))
        part = np.full((stop - at, registers), np.iinfo(np.uint64).max, dtype=np.uint64)
        _fill(part, [sets[n] for n in order[at:stop]], registers)
        out[order[at:stop]] = part
        at = stop
    return out


def _draw(elements: np.ndarray, rank: int, registers: int) -> tuple[np.ndarray, np.ndarray]:
    """Per element: the place swapped to ``rank`` in its shuffle, and its value."""
    random = mix(elements + np.uint64(rank * int(_STEP) + 1 & 0xFFFFFFFFFFFFFFFF))
    left = np.uint64(registers - rank)
    place = ((random >> np.uint64(40)) * left >> np.uint64(24)).astype(np.int64) + rank
    value = (mix(random) & _FRACTION) | np.uint64(rank << 48)
    return place, value


def _fill(out: np.ndarray, sets: list[np.ndarray], registers: int) -> None:
    if len(sets) == 1 and len(sets[0]) > ELEMENTS:      # a very large set, in parts; rank 0 mostly settles it
        parts = [sets[0][a:a + ELEMENTS] for a in range(0, len(sets[0]), ELEMENTS)]
        for part in parts:
            place, value = _draw(part, 0, registers)
            np.minimum.at(out[0], place, value)
        if out.max() >> np.uint64(48):
            for part in parts:
                _rounds(out, part, np.zeros(len(part), dtype=np.int64), registers)
        return
    _rounds(out, np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), registers)


def _rounds(out: np.ndarray, elements: np.ndarray, owners: np.ndarray, registers: int) -> None:
    """All ranks of ``elements``, until the sets they belong to are done."""
    flat = out.reshape(-1)
    place, value = _draw(elements, 0, registers)
    np.minimum.at(flat, owners * registers + place, value)
    going, order = np.ones(len(out), dtype=bool), None
    for rank in range(1, registers):
        going[going] = out[going].max(axis=1) >> np.uint64(48) >= rank
        left = going[owners]
        n = int(left.sum())
        if not n:
            return
        if order is None or n < 0.7 * len(elements):    # ranks of a set that is done change nothing
            elements, owners = elements[left], owners[left]
            if order is None:
                place, rows = place[left], np.arange(n)
                order = np.tile(np.arange(registers, dtype=np.int16), (n, 1))
                order[rows, place] = 0
                order[rows, 0] = place
            else:
                order, rows = order[left], rows[:n]
        place, value = _draw(elements, rank, registers)
        target = order[rows, place].astype(np.int64)
        order[rows, place] = order[rows, rank]
        np.minimum.at(flat, owners * registers + target, value)
