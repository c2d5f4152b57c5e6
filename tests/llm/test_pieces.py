import hashlib

import pytest
from conftest_llm import SCHEMA, UNTIDY, prose
from hypothesis import given, settings, strategies as st

from ledgerlark.llm import pieces
from ledgerlark.llm.registry import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
CODEC = pieces.PieceCodec(MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n▁abcdeéßthing.,019中\U0001F600'<>", max_size=60))
def test_ids_equal_the_librarys(text):
    assert list(CODEC.encode(text)) == CODEC.library.encode(text)


@pytest.mark.parametrize("text", [" " * 50 + "x", "x" * 9000, "thequickbrown" * 900, "▁" * 5000 + "a", "中" * 5000, "</s><0x0A>"])
def test_long_and_odd_texts(text):
    assert list(CODEC.encode(text)) == CODEC.library.encode(text)


def test_compatibility_is_what_merging_says():
    the, re = CODEC.ids["▁the"], CODEC.ids["re"]
    assert CODEC.compatible(the, re) == (CODEC.merge("▁there") == [the, re])
    assert CODEC.compatible(-5, the) and CODEC.compatible(the, -5)


def test_small_caches_change_nothing(rng, monkeypatch):
    monkeypatch.setattr(pieces, "PAIR_CACHE", 5)
    own = pieces.PieceCodec(MODEL)
    own.chunks.size = 3
    for _ in range(20):
        text = prose(rng, 50)
        assert list(own.encode(text)) == own.library.encode(text)


def test_digests(spark, make, rng):
    texts = UNTIDY + [prose(rng, 200)] * 3
    got = {r["doc_id"]: r for r in pieces.piece_digests(make(texts), MODEL).collect()}
    assert len(got) == len(texts)
    for n, text in enumerate(texts):
        ids = CODEC.library.encode(text or "")
        assert got[n]["n_tokens"] == len(ids)
        assert got[n]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[n]["decoded_sha256"] == hashlib.sha256((CODEC.library.decode(ids) if ids else "").encode()).hexdigest()


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "old", 5)], "doc_id long, text string, ids string, piece_text int")
    row = pieces.encode_pieces(df, MODEL).first()
    assert row["ids"] == CODEC.library.encode("a b") and row["decoded"] == "a b" and row["piece_text"] == 5
    assert pieces.piece_digests(spark.createDataFrame([], SCHEMA), MODEL).count() == 0
