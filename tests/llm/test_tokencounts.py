import numpy as np
import pytest
from conftest_llm import SCHEMA, UNTIDY, prose

from ledgerlark.llm import tokencounts
from ledgerlark.llm.registry import TOKENIZERS
from ledgerlark.llm.tokenfiles import ByteBpe

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
BPE = ByteBpe(PATH)


def brute(text, rule="start", separator="\n"):
    """(section, n_chars, n_tokens, n_crossing) from the bytes of every single token."""
    pieces = (text or "").split(separator)
    pieces = [p + separator for p in pieces[:-1]] + [pieces[-1]]
    owner = [n for n, p in enumerate(pieces) for _ in p.encode()]
    tokens, crossing, at = [0] * len(pieces), [0] * len(pieces), 0
    for i in BPE.library.encode(text or "", add_special_tokens=False).ids:
        mine = owner[at:at + BPE.lengths[i]]
        at += len(mine)
        chosen = mine[0] if rule == "start" else mine[-1] if rule == "end" else max(sorted(set(mine)), key=mine.count)
        tokens[chosen] += 1
        crossing[mine[0]] += mine[0] != mine[-1]
    return [(n, len(p), tokens[n], crossing[n]) for n, p in enumerate(pieces)]


@pytest.mark.parametrize("rule,separator", [("start", "\n"), ("end", "th"), ("most", "th"), ("start", "e")])
def test_equals_brute_force(make, rng, rule, separator):
    texts = [t for t in UNTIDY if t is None or len(t) < 20000] + ["a\n\n\n  b\n", "\n"]
    texts += ["\n".join(prose(rng, rng.randint(0, 20)) for _ in range(rng.randint(1, 6))) for _ in range(20)]
    got = tokencounts.count_sections(make(texts), PATH, separator=separator, rule=rule).collect()
    wanted = [(n, *row) for n, t in enumerate(texts) for row in brute(t, rule, separator)]
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_tokens_add_up_and_crossing_ones_are_met():
    text = "there thereby other"
    total = len(BPE.library.encode(text, add_special_tokens=False).ids)
    for rule in tokencounts.RULES:
        rows = brute(text, rule, "th")
        assert sum(r[2] for r in rows) == total and sum(r[3] for r in rows) > 0


def test_most_takes_the_first_of_equals():
    begins, ends, starts = np.array([0, 3]), np.array([3, 7]), np.array([0, 5])
    for rule, wanted in (("start", [2, 0]), ("end", [1, 1]), ("most", [2, 0])):
        tokens, crossing = tokencounts.attribute(begins, ends, starts, rule)
        assert tokens.tolist() == wanted and crossing.tolist() == [1, 0]


def test_fields(spark):
    rows = [(1, "user", "Hello there"), (2, None, ""), (3, "é", None), (4, "a ", " b\n")]
    df = spark.createDataFrame(rows, "conv_id long, role string, said string")
    got = tokencounts.count_fields(df, PATH, ["role", "said"], "conv_id").collect()
    for ident, role, said in rows:
        parts = [r for r in got if r["doc"] == ident]
        whole = f"{role or ''}\n{said or ''}"
        assert sum(r["n_tokens"] for r in parts) == len(BPE.library.encode(whole, add_special_tokens=False).ids)
        assert [r["n_chars"] for r in sorted(parts, key=lambda r: r["section"])] == [len(role or "") + 1, len(said or "")]


def test_bad_rule_and_empty(spark, make):
    with pytest.raises(ValueError, match="rule"):
        tokencounts.count_sections(make(["a"]), PATH, rule="half")
    assert tokencounts.section_rows(spark.createDataFrame([], SCHEMA), PATH).count() == 0
