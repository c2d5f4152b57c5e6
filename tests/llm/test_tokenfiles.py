import random
import zlib

import numpy as np
import pytest
from conftest_llm import SCHEMA, UNTIDY, prose
from hypothesis import given, settings, strategies as st

from ledgerlark.llm import rans, tokenfiles
from ledgerlark.llm.registry import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
BPE = tokenfiles.ByteBpe(PATH)


def ids_of(raw):
    return np.frombuffer(raw, BPE.kind).tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="  \n\tabcé'st1.\x1c  \U0001F600<|>", max_size=40), max_size=4))
def test_ids_equal_the_librarys(texts):
    wanted = [e.ids for e in BPE.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(r) for r in BPE.encode(texts)] == wanted


def test_special_strings_stay_what_the_library_makes_of_them():
    text = "a <|endoftext|> b<|endoftext|>"
    assert ids_of(BPE.encode([text])[0]) == BPE.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 4097, 200_000])
def test_blocks_decode_whole_and_in_parts(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(max=50_000).astype(np.int64)
    table = rans.Table.from_counts(*np.unique(np.append(ids, 3), return_counts=True))
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    parts = [rans.decode(block, table, p, 1) for p in range(rans.parts_of(block))]
    assert (np.concatenate(parts) == ids).all() if parts else n == 0


def test_one_token_and_many_tokens():
    one = rans.Table.from_counts(np.array([7]), np.array([10]))
    assert (rans.decode(rans.encode(np.full(999, 7), one), one) == 7).all()
    wide = rans.Table.from_counts(np.arange(400_000), np.ones(400_000))
    assert wide.precision > 17 and wide.slots.min() >= 1 and int(wide.slots.sum()) == 1 << wide.precision


def test_damage_is_found():
    ids = np.arange(5000) % 17
    table = rans.Table.from_counts(*np.unique(ids, return_counts=True))
    block = bytearray(rans.encode(ids, table))
    block[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(bytes(block), table)


def test_files_round_trip(make, rng, monkeypatch):
    texts = UNTIDY + [prose(rng, rng.randint(0, 300)) for _ in range(60)]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = tokenfiles.token_file_digests(make([(d * 3, texts[d], "s") for d in order], parts=5), PATH).collect()
    start, wanted = 0, []
    for n, text in enumerate(texts):
        ids = [*BPE.library.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((n * 3, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows)) == wanted


def test_repeated_and_missing_ids(make):
    rows = tokenfiles.token_file_digests(make([(None, "no id", "s"), (4, "b", "s"), (4, "b", "s"), (1, "a", "s")]), PATH).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 4, 4]
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows[:-1]]))


def test_empty_table(spark):
    assert tokenfiles.token_file_digests(spark.createDataFrame([], SCHEMA), PATH).count() == 0
