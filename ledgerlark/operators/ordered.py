"""Ordered target statistics: a category as the label's mean over the rows before, so that no row sees its own label.

The order is the hash order of the ids, cut into buckets of about ``BUCKET_ROWS`` rows. Counts by (column, value, bucket), combined in the map
tasks, give what each value has collected before a bucket; inside it one task adds up the rest for all columns. Buckets follow the hash and not
the category, so a value with a third of the rows is spread over all of them, and rows move once for any number of columns.

A row gets (labels before + weight * prior) / (rows before + weight). Rows without a label count nothing but are encoded; a missing category
gets the prior. Rows of the same id do not see each other; ids are expected to be nearly unique, as rows of one id share a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.functions.hashing import HASH_BITS, order_hash
from ledgerlark.operators.preprocess import code_name
from ledgerlark.operators.sampling import HashOrder

BUCKET_ROWS = 100_000
PRIOR = 0.5
_HASH, _STEP, _LABEL, _BUCKET, _FOLD = "__hash", "__step", "__label", "__bucket", "__part"


def smoothed(positives, n, prior: float, weight: float):
    return (positives + prior * weight) / (n + weight)


def _pairs(columns: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))


def target_statistics(df: DataFrame, columns: Sequence[str], label: str, prior: float = PRIOR, weight: float = 1.0) -> DataFrame:
    """(column, value, code): the statistic of all rows, for rows that were not trained on; see ``encode_by_join``."""
    y = F.col(f"`{label}`").cast("double")
    counts = (df.select(y.alias("y"), _pairs(columns).alias("p")).filter(F.col("p.value").isNotNull() & F.col("y").isNotNull())
              .groupBy("p.column", "p.value").agg(F.sum("y").alias("s"), F.count("*").alias("n")))
    return counts.select("column", "value", smoothed(F.col("s"), F.col("n"), prior, weight).alias("code"))


def _sums_before(codes: np.ndarray, steps: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per row the sum of ``values`` (of each column) of the same code over smaller steps; rows come in order of steps."""
    order = np.argsort(codes, kind="stable")
    c, s = codes[order], steps[order]
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values[order], axis=0)])
    at = np.arange(len(c))
    first = np.ones(len(c), dtype=bool)
    first[1:] = c[1:] != c[:-1]
    fresh = first.copy()
    fresh[1:] |= s[1:] != s[:-1]
    start, step = (np.maximum.accumulate(np.where(flag, at, 0)) for flag in (first, fresh))
    out = np.empty(values.shape)
    out[order] = total[step] - total[start]
    return out


def ordered_statistics(df: DataFrame, columns: Sequence[str], label: str, order: HashOrder = HashOrder(), prior: float = PRIOR,
                       weight: float = 1.0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``<column>_code`` for each of ``columns``, the statistic of the rows before in the order.

    ``df`` is read three times (count, sums, rows), so it should be a written table.
    """
    columns = list(columns)
    buckets = max(1, -(-df.count() // bucket_rows))
    kept = [f for f in df.schema if f.name not in {code_name(c) for c in columns}]
    row_id = F.col(f"`{order.row_id}`")
    place = F.coalesce(order_hash(row_id, order.seed, order.method), F.lit(0))
    placed = df.select(*[F.col(f"`{f.name}`") for f in kept], place.alias(_HASH),
                       F.coalesce(F.concat(F.lit("i"), row_id.cast("string")), F.lit("")).alias(_STEP),
                       F.col(f"`{label}`").cast("double").alias(_LABEL),
                       F.shiftright(place * buckets, HASH_BITS).cast("int").alias(_BUCKET))
    before = Window.partitionBy("column", "value").orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sums = (placed.select(_BUCKET, _LABEL, _pairs(columns).alias("p")).select(_BUCKET, _LABEL, "p.*").filter(F.col("value").isNotNull())
            .groupBy("column", "value", _BUCKET).agg(F.sum(_LABEL).alias("s"), F.count(_LABEL).alias("n")))
    earlier = sums.select(_BUCKET, "column", "value", F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("s"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).cast("double").alias("n"))

    def work(rows: pa.Table, sums: pa.Table) -> pa.Table:
        rows = rows.sort_by([(_HASH, "ascending"), (_STEP, "ascending")])
        steps = np.zeros(len(rows), dtype=np.int64)
        step = rows[_STEP].combine_chunks()
        if len(rows) > 1:
            steps[1:] = np.cumsum(pc.not_equal(step[1:], step[:-1]).to_numpy(zero_copy_only=False))
        y = rows[_LABEL].combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64)
        known = ~np.isnan(y)
        codes = []
        for c in columns:
            words = pc.cast(rows[c], pa.string()).combine_chunks().dictionary_encode()
            place = words.indices.fill_null(len(words.dictionary)).to_numpy(zero_copy_only=False)
            own = sums.filter(pc.equal(sums["column"], c))
            base = np.zeros((2, len(words.dictionary) + 1))
            at = pc.index_in(own["value"].combine_chunks(), value_set=words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
            base[0, at], base[1, at] = own["s"].to_numpy(), own["n"].to_numpy()
            s, n = (base[i, place] + _sums_before(place, steps, v) for i, v in enumerate((np.where(known, y, 0.0), known.astype(np.float64))))
            codes.append(pa.array(np.where(place == len(words.dictionary), prior, smoothed(s, n, prior, weight))))
        plain = rows.select([f.name for f in kept])
        return pa.Table.from_arrays([*plain.columns, *codes], names=[*plain.column_names, *[code_name(c) for c in columns]])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{code_name(c)}` double" for c in columns])
    return placed.groupBy(_BUCKET).cogroup(earlier.groupBy(_BUCKET)).applyInArrow(work, schema)


def fold_statistics(df: DataFrame, columns: Sequence[str], label: str, order: HashOrder, fold: str, models: int, prior: float = PRIOR,
                    weight: float = 1.0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``<column>_code<m>`` for each model m, the statistic of the rows before that are outside fold m, and ``<column>_held``, that of all
    rows outside the row's own fold, by which it is judged. The rows move once for all models.
    """
    columns = list(columns)
    buckets = max(1, -(-df.count() // bucket_rows))
    made = [name for c in columns for name in (*[f"{c}_code{m}" for m in range(models)], f"{c}_held")]
    kept = [f for f in df.schema if f.name not in made]
    row_id, part = F.col(f"`{order.row_id}`"), F.col(f"`{fold}`").cast("int")
    place = F.coalesce(order_hash(row_id, order.seed, order.method), F.lit(0))
    placed = df.select(*[F.col(f"`{f.name}`") for f in kept], place.alias(_HASH),
                       F.coalesce(F.concat(F.lit("i"), row_id.cast("string")), F.lit("")).alias(_STEP), F.col(f"`{label}`").cast("double").alias(_LABEL),
                       F.when(part.between(0, models - 1), part).otherwise(models).alias(_FOLD),
                       F.shiftright(place * buckets, HASH_BITS).cast("int").alias(_BUCKET))
    whole = Window.partitionBy("column", "value")
    before = whole.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    folds = range(models + 1)
    sums = (placed.select(_BUCKET, _LABEL, _FOLD, _pairs(columns).alias("p")).select(_BUCKET, _LABEL, _FOLD, "p.*").filter(F.col("value").isNotNull())
            .groupBy("column", "value", _BUCKET).agg(*[F.coalesce(F.sum(F.when(F.col(_FOLD) == m, F.col(_LABEL))), F.lit(0.0)).alias(f"s{m}") for m in folds],
                                                     *[F.count(F.when(F.col(_FOLD) == m, F.col(_LABEL))).cast("double").alias(f"n{m}") for m in folds]))
    names = [f"{a}{m}" for a in "sn" for m in folds]
    earlier = sums.select(_BUCKET, "column", "value", F.array(*[F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in names]).alias("before"),
                          F.array(*[F.sum(c).over(whole) for c in names]).alias("whole"))

    def taught(by_fold: np.ndarray) -> np.ndarray:
        """The statistic for each model from (rows, [sums by fold, counts by fold])."""
        s, n = by_fold[:, :models + 1], by_fold[:, models + 1:]
        return smoothed(s.sum(axis=1, keepdims=True) - s[:, :models], n.sum(axis=1, keepdims=True) - n[:, :models], prior, weight)

    def work(rows: pa.Table, sums: pa.Table) -> pa.Table:
        rows = rows.sort_by([(_HASH, "ascending"), (_STEP, "ascending")])
        steps = np.zeros(len(rows), dtype=np.int64)
        step = rows[_STEP].combine_chunks()
        if len(rows) > 1:
            steps[1:] = np.cumsum(pc.not_equal(step[1:], step[:-1]).to_numpy(zero_copy_only=False))
        y = rows[_LABEL].combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64)
        part = rows[_FOLD].combine_chunks().to_numpy(zero_copy_only=False)
        known, at = ~np.isnan(y), np.arange(len(y))
        values = np.zeros((len(y), 2 * (models + 1)))
        values[at, part], values[at, models + 1 + part] = np.where(known, y, 0.0), known
        codes = []
        for c in columns:
            words = pc.cast(rows[c], pa.string()).combine_chunks().dictionary_encode()
            none = len(words.dictionary)
            place = words.indices.fill_null(none).to_numpy(zero_copy_only=False)
            own = sums.filter(pc.equal(sums["column"], c))
            found = pc.index_in(own["value"].combine_chunks(), value_set=words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
            base, total = np.zeros((2, none + 1, 2 * (models + 1)))
            for out, name in ((base, "before"), (total, "whole")):
                out[found] = own[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * (models + 1))
            each, all_ = taught(base[place] + _sums_before(place, steps, values)), taught(total)
            held = np.where(part < models, all_[place, np.minimum(part, models - 1)], prior)
            for v in (*each.T, held):
                codes.append(pa.array(np.where(place == none, prior, v)))
        plain = rows.select([f.name for f in kept])
        return pa.Table.from_arrays([*plain.columns, *codes], names=[*plain.column_names, *made])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{name}` double" for name in made])
    return placed.groupBy(_BUCKET).cogroup(earlier.groupBy(_BUCKET)).applyInArrow(work, schema)
