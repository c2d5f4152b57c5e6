"""Texts and tables for the corpus tests."""

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

UNTIDY = [None, "", " ", "\n\n", "a", "a b\tc", "É ß 中文 \U0001F600 x", "word " * 3000, "x" * 70000, "\x00\x1f odd\x7f", "▁ a  b "]


def prose(rng: random.Random, n: int) -> str:
    parts = ("the", "and", "on", "er", "tion", "re", "ha", "st", "ou", "é", "ß")
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))
