import re

import pytest
from conftest_llm import SCHEMA, UNTIDY, prose

from ledgerlark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ALL = licenses.compiled(tuple(licenses.TEMPLATES.items()))


def brute(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def labels(text):
    return {f[0] for f in licenses.scan(text, ALL, {})[1]}


def test_base_equals_brute_force(make, rng):
    texts = list(UNTIDY) + ["MIT License mit license MIT LICENSE.", "cc by cc by-nc, CC  BY", "the gnu General\nPublic licenses"]
    phrases = list(licenses.PHRASES)
    for _ in range(60):
        parts = [prose(rng, rng.randint(0, 6)) for _ in range(5)] + [rng.choice(phrases).title() for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        texts.append(rng.choice((" ", "-", "\n")).join(parts))
    got = {r["doc_id"]: r for r in licenses.license_rows(make(texts)).collect()}
    for n, text in enumerate(texts):
        row = got[n]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == brute(text), text
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] >= 0.5 or not row["n_base"])


@pytest.mark.parametrize("text,label", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0-notice"),
    ("licensed under the GNU General Public License, Version 3", "gpl-3.0-notice"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0-notice"),
    ("Released under the MIT License.", "mit-notice"),
    ("distributed under the terms of the MIT license", "mit-notice"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0-notice"),
])
def test_notices(text, label):
    for whole in (text, f"Some words before. {text} Some words after."):
        assert label in labels(whole)


@pytest.mark.parametrize("text", [
    "Released under an MIT License.", "sold under the MIT License", "under the terms of MIT License", "Licensed under CC BY-NC 3.0",
    "the GNU General Public License, version 2"])
def test_changed_mandatory_wording_is_refused(text):
    assert not labels(text)


def fill(markup, optional=True, words="some inserted words"):
    text = re.sub(r"<<optional>>(.*?)<<end>>", r"\1" if optional else "", markup, flags=re.S)
    return re.sub(r"<<one of\|([^|>]*).*?>>", r"\1", re.sub(r"<<any \d+>>", words.split()[0], text))


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
@pytest.mark.parametrize("optional", [True, False])
def test_every_template_accepts_its_texts_and_refuses_a_changed_word(label, optional):
    markup = licenses.TEMPLATES[label].replace("<<one of|work|program|file|software>>", "work")
    text = fill(markup, optional)
    assert label in labels(f"before {text} after")
    assert licenses.scan(text, ALL, {})[2] == 1.0
    template = next(t for t in ALL if t.label == label)
    fixed = template.anchor.decode().split()
    changed = text.lower().replace(fixed[0], "changedword", 1)
    assert label not in labels(changed)


def test_markup_by_brute_force(rng):
    """Against a regular expression over the same regions."""
    template = licenses.Template("t", "a <<optional>>b <<any 2>><<end>> c d <<one of|e|f>> <<any 3>> g")
    pattern = re.compile(r"a (?:b (?:\w+ ){0,2})?c d [ef] (?:\w+ ){0,3}g")
    for _ in range(4000):
        text = " ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 14)))
        words = licenses.words(text)
        found = {template.match(words, at)[0] for at in licenses._places(f" {text} ".encode(), template.anchor)} - {None}
        for first, last in found:
            assert pattern.fullmatch(" ".join(text.split()[first:last + 1]))
        assert bool(found) == bool(pattern.search(text)), text


def test_bad_markup_is_refused():
    for markup in ("<<optional>> a", "<<some>> a", "<<any 3>>"):
        with pytest.raises(ValueError):
            licenses.Template("t", markup)


def test_partial_score_places_and_empty(spark, make):
    part = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is granted"
    score = licenses.scan(part, ALL, {})[2]
    assert 0.3 < score < 1
    text = "Ünd — Released  under the MIT\nLicense!"
    row = licenses.find_licenses(make([text])).first()
    found = {f["label"]: text[f["begin"]:f["end"]] for f in row["licenses"]}
    assert found == {"mit": "MIT\nLicense", "mit-notice": "Released  under the MIT\nLicense"}
    assert licenses.license_rows(spark.createDataFrame([], SCHEMA)).count() == 0


FULL = ("mit-text", "isc", "bsd-2-clause", "bsd-3-clause", "gpl-header")


@pytest.mark.parametrize("label", FULL)
def test_changed_or_missing_ends_are_refused(label):
    text = fill(licenses.TEMPLATES[label])
    assert labels(text) == {label}
    for old, new in (("warranty", "promise"), ("WARRANTY", "promise"), ("WARRANTIES", "promises"), ("LIABLE", "thanked"),
                     ("PARTICULAR PURPOSE", "purpose")):
        if old in text:
            assert not labels(text.replace(old, new)), old
            assert licenses.scan(text.replace(old, new), ALL, {})[2] < 1
    assert not labels(" ".join(text.split()[:-1]))
    assert not labels(re.split(r"\n\s*\n", text)[0])


def test_bsd_3_is_not_bsd_2():
    three = fill(licenses.TEMPLATES["bsd-3-clause"])
    assert labels(three) == {"bsd-3-clause"}
    assert not labels(three.replace("endorse", "praise"))


def test_holders_and_list_marks_may_be_replaced():
    text = licenses.TEMPLATES["bsd-3-clause"]
    for mark, holder in (("*", "the copyright holders and contributors"), ("2.", "The Example Project and others")):
        assert labels(text.replace("<<any 1>>", mark).replace("<<any 12>>", holder)) == {"bsd-3-clause"}
