"""Helpers of the operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 2 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, made from ``names`` by adding underscores."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` whose ``column`` holds at most ``budget`` bytes; one row may hold more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + budget, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch from arrays or lists, cast to ``schema``."""
    arrays = [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class RecentCache:
    """A dictionary of at most about ``2 * size`` entries that forgets what was not used lately."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def age(self) -> None:
        """To be called before a piece of work: a full generation becomes the old one."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}

    def missing(self, keys) -> list:
        """Distinct ``keys`` that are unknown; known ones are ready in ``new`` afterwards."""
        unknown = []
        for key in set(keys).difference(self.new):
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self.new[key] = value
        return unknown
