import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import SCHEMA  # noqa: E402



@pytest.fixture(scope="session")
def make(spark):
    """A documents table from texts or (doc_id, text, source) rows, dealt over a few partitions."""
    def build(rows, parts=3):
        rows = [r if isinstance(r, tuple) else (n, r, "s0") for n, r in enumerate(rows)]
        full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)
    return build


@pytest.fixture
def rng():
    return random.Random(7)
