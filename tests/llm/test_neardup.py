import random
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import SCHEMA, UNTIDY, prose

from ledgerlark.llm import neardup, superminhash, wordhash
from ledgerlark.llm.components import connected

BLANK = " \t\n\x0b\x0c\r"


def word_list(text):
    out, now = [], ""
    for c in (text or "").translate({c: c + 32 for c in range(65, 91)}):
        if c in BLANK:
            out, now = (out + [now] if now else out), ""
        else:
            now += c
    return out + [now] if now else out


def shingle_set(text):
    w = word_list(text) if len(text or "") < 5000 else (text.lower().split())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, percent=85):
    sets = [(i, shingle_set(t)) for i, t, _ in rows]
    links = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1:]
             if x and 100 * len(x & y) >= percent * len(x | y)]
    found = groups(links, [i for i, _ in sets])
    return sorted((i, len(s), found[i], found[i] == i) for i, s in sets)


def near_copies(rng, base, n, share):
    out = []
    for _ in range(n):
        words = base.split(" ")
        for _ in range(max(1, int(share * len(words)))):
            words[rng.randrange(len(words))] = prose(rng, 1)
        out.append(" ".join(words))
    return out


@pytest.fixture
def rows(rng):
    texts = list(UNTIDY) + ["A b c d", "a  B\tc d", "b a c d"]
    for _ in range(6):
        base = prose(rng, rng.randint(30, 250))
        texts += [base, base, base.upper().replace("É", "é").replace("SS", "ß")] + near_copies(rng, base, 6, 0.01) + near_copies(rng, base, 4, 0.03)
    chain = prose(rng, 200)
    for _ in range(12):                      # neighbours are alike, the ends are not
        texts.append(chain)
        chain = near_copies(rng, chain, 1, 0.012)[0]
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 12)} {passage} {prose(rng, 12)}" for _ in range(20)]
    star = prose(rng, 110)
    texts += [star] + near_copies(rng, star, 40, 0.012)
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(n, texts[k], "s") for n, k in enumerate(order)]


@pytest.mark.parametrize("members", [1024, 4])
def test_equals_brute_force(make, rows, members, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", members)
    got = neardup.group_rows(make(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_repeated_rows_missing_ids_and_columns(spark, make, rng):
    text = prose(rng, 40)
    rows = [(3, text, "s"), (3, text, "s"), (5, text, "s"), (None, text, "s"), (7, prose(rng, 40), "s"), (8, "", "s"), (9, "", "s")]
    got = sorted(map(tuple, neardup.group_rows(make(rows)).collect()), key=repr)
    n = len(shingle_set(text))
    assert [g for g in got if g[1] == n and g[0] != 7] == [(3, n, 3, True), (3, n, 3, True), (5, n, 3, False), (None, n, None, True)]
    assert (8, 0, 8, True) in got and (9, 0, 9, True) in got
    df = make(rows).withColumnRenamed("lang", "copy_doc")
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [3, 3, 7, 8, 9, None]
    assert neardup.group_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shingles_equal_sets(rng):
    texts = UNTIDY + [prose(rng, rng.randint(0, 400)) for _ in range(50)]
    raw = [(t or "").encode().lower() for t in texts]
    sets = wordhash.shingles(raw, 5)
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    one_by_one = [wordhash.shingles([r], 5)[0] for r in raw]
    assert all((a == b).all() for a, b in zip(sets, one_by_one))


def test_long_texts_are_cut_at_words(rng, monkeypatch):
    raw = prose(rng, 3000).encode().lower()
    whole = wordhash.shingles([raw, b"a b"], 5)
    monkeypatch.setattr(wordhash, "SEGMENT", 100)
    cut = wordhash.shingles([raw, b"a b"], 5)
    assert all((a == b).all() for a, b in zip(whole, cut))


@pytest.mark.parametrize("share", [0.5, 0.85, 0.95])
def test_signatures_estimate_similarity_with_less_variance(share):
    rng, found = np.random.default_rng(1), []
    for _ in range(150):
        n = 300
        both = round(2 * n * share / (1 + share))
        pool = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        a, b = superminhash.signatures([pool[:n], pool[n - both:]])
        found.append((a == b).mean())
    assert abs(np.mean(found) - share) < 0.01
    assert np.std(found) < (share * (1 - share) / superminhash.REGISTERS) ** 0.5


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 3, 0, 500, 9000, 30000, 2)]
    together = superminhash.signatures(sets)
    for s, row in zip(sets, together):
        assert (superminhash.signatures([s])[0] == row).all()
    ranks = superminhash.signatures([sets[0]])[0] >> np.uint64(48)
    assert sorted(ranks.tolist()) == list(range(superminhash.REGISTERS))      # one element deals every rank once


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(n, n + 1) for n in range(400, 440)] + [(5, 5)]
    got = {r["high"]: r["low"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = {i: g for i, g in groups(links, {x for pair in links for x in pair}).items() if i != g}
    assert got == wanted
    assert connected(spark.createDataFrame([(1, None), (2, 2)], "a long, b long")).count() == 0


def pair_at(rng, shared, own):
    """Two texts of shared + own words each: the ends differ, so own shingles on each side are not shared, nor with another pair."""
    base, pair = prose(rng, shared), rng.getrandbits(64)
    return [f"{base} {' '.join(f'{side}{n}of{pair}' for n in range(own))}" for side in ("left", "right")]


def thue_morse(letters, size):
    word = letters
    while len(word) < size:
        word += word.translate(str.maketrans(letters, letters[::-1]))
    return word


@pytest.mark.parametrize("size", [8, 16, 512, 1024, 4096])
def test_words_that_collide_modulo_powers_of_two_are_told_apart(make, size):
    words = [thue_morse(pair, size) for pair in ("ab", "ba", "xy", "yx")]
    hashes, _ = wordhash.hash_words([w.encode() for w in words])
    assert len(set(hashes.tolist())) == 4
    rows = neardup.group_rows(make(words + words[:1])).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}


def test_words_hash_alike_wherever_they_stand():
    words = ["a", "abcdefgh", "abcdefghi", "x" * 15, "x" * 16, "x" * 17, "\x00", "\x00\x00", "é" * 40]
    alone = [int(wordhash.hash_words([w.encode()])[0][0]) for w in words]
    assert len(set(alone)) == len(words)
    together, counts = wordhash.hash_words([("  " + " \t".join(words)).encode(), b"", " ".join(words[::-1]).encode()])
    assert together.tolist() == alone + alone[::-1] and counts.tolist() == [9, 0, 9]


@pytest.mark.parametrize("percent,shared,own", [(80, 94, 10), (70, 94, 18), (50, 64, 30), (30, 64, 65)])
def test_pairs_just_above_any_threshold_are_found(make, rng, percent, shared, own):
    texts = [t for _ in range(40) for t in pair_at(rng, shared, own)]
    a, b = map(shingle_set, texts[:2])
    assert percent <= 100 * len(a & b) / len(a | b) < min(85, percent + 5)
    found = {r["doc"]: r["component"] for r in neardup.near_duplicates(make(texts), percent=percent).collect()}
    assert found == {n: n - n % 2 for n in range(80)}
    assert sorted(r["doc_id"] for r in neardup.keep_one(make(texts), percent=percent).collect()) == list(range(0, 80, 2))


def test_bands_and_sketches_follow_the_threshold():
    assert (neardup.band_rows(85), neardup.sketch_limit(85)) == (8, 224)
    for percent in range(5, 101):
        r = neardup.band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (superminhash.REGISTERS // r) <= neardup.MISS
        assert neardup.sketch_limit(percent) <= superminhash.REGISTERS * percent / 100


def test_keep_one_drops_the_copy_and_keeps_the_other_text_of_its_id(make, rng):
    a, b = prose(rng, 40), prose(rng, 40)
    kept = neardup.keep_one(make([(2, a, "s"), (5, a, "s"), (5, b, "s"), (5, None, "s"), (7, b, "s")])).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted([(2, a), (5, b), (5, None)], key=repr)
