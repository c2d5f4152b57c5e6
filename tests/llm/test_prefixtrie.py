import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import SF, prose

from ledgerlark.llm import prefixtrie
from ledgerlark.llm.registry import QUERIES

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, rebuild=True):
    """All prefixes of all conversations in one dictionary."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        whole[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(whole):
        path = tuple(whole[c])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, found in members.items():
        value = (len(found) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += not children[node]
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items())


def run(df, **more):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in NODE) for r in prefixtrie.prefix_trie(df, **more).collect())


@pytest.fixture
def rows(rng):
    texts = [prose(rng, rng.randint(0, 6)) for _ in range(6)] + [None, "", "é中\U0001F600", "long " * 20_000]
    out = []
    for conv in [*range(0, 60), 103, 104, 999, 10**12 + 7]:
        if conv % 10 == 5:
            continue                                          # its followers have no conversation to start from
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            out.append((conv, turn if turn or conv % 3 else None, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    out += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    first = [(t, r, x) for c, t, r, x in out if c == 20]
    out += [(c, t, r, x) for c in range(200, 290) for t, r, x in first]          # many copies of one conversation
    rng.shuffle(out)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, conv int"


@pytest.mark.parametrize("rebuild", [True, False])
@pytest.mark.parametrize("segment,shard,piece", [(1 << 16, 1 << 20, 1 << 16), (3, 7, 4)])
def test_equals_brute_force(spark, rows, monkeypatch, rebuild, segment, shard, piece):
    for name, value in (("SEGMENT", segment), ("SHARD_ROWS", shard), ("PIECE", piece)):
        monkeypatch.setattr(prefixtrie, name, value)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    assert run(df, rebuild=rebuild) == brute(rows, rebuild)


def test_one_conversation_over_many_ranges_and_segments(spark, rng, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SEGMENT", 16)
    rows = [(5, t, "user", f"t{t}") for t in range(300)] + [(6, t, "user", f"t{t}" if t < 290 else "x") for t in range(300)]
    rows += [(c, t, "user", f"t{t}") for c in (10, 11) for t in range(40)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(6)
        for rebuild in (True, False):
            assert run(df, rebuild=rebuild) == brute(rows, rebuild)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert run(empty, rebuild=True) == run(spark.createDataFrame([(None, 1, "a", "b", 1)], SCHEMA)) == []
    # 4 takes up to h turns of 0, which is absent, and has none after them: it ends in the root.
    h = zlib.crc32(b"4") % 9
    rows = [(4, t, "user", "x") for t in range(h)]
    assert h and run(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), rebuild=True) == brute(rows)
    assert brute(rows)[0][:5] == (4, 0, -1, 1, 0)
    # Equal turn numbers have one order, whatever the rows' order is; repeated rows are turns.
    tied = [(0, 1, "user", "a"), (0, 1, "user", "b"), (0, 1, "user", "a"), (1, 0, "user", "b")]
    one, two = (run(spark.createDataFrame([(*r, 1) for r in part], SCHEMA).repartition(n)) for part, n in ((tied, 1), (tied[::-1], 3)))
    assert one == two and max(r[1] for r in one) == 3


@pytest.mark.parametrize("n", [0, 1, 2, 17, 5000, 200_000])
def test_node_table_is_a_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    first, second = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    first[: n // 2] = first[:1] if n else first               # one half agrees in one lane
    table = prefixtrie.NodeTable(first, second)
    slots = table.slots(first, second)
    assert sorted(slots.tolist()) == list(range(n)) and len(table) == n
    assert (table.slots(first, second + np.uint64(1)) == -1).all()
    again, at = prefixtrie.NodeTable.enumerate(np.tile(first, 3), np.tile(second, 3))
    assert len(again) == n and (again.first[at] == np.tile(first, 3)).all()


def test_equal_digests_are_refused():
    with pytest.raises(ValueError):
        prefixtrie.NodeTable(np.zeros(2, dtype=np.uint64), np.zeros(2, dtype=np.uint64))


def test_query_on_the_tables(spark):
    rows = list(map(tuple, spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    got = QUERIES["op13_prefix_trie"](spark, SF).collect()
    assert sorted(tuple(-1 if r[c] is None else r[c] for c in NODE) for r in got) == brute(rows)
