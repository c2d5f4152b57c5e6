"""Per-entity history features: what the card did before this transaction.

A card with few rows is one window group. For a card with many, sliding frames would take rows x frame
steps in a single task, so its rows are cut into time slices, with the same result in linear time:

* row frames (last k rows): the group is (card, slice), with the k rows before the slice copied in.
* time frames (``[t - span, t)``): what entered in the row's own slice before it, plus the end of the slice in which the
  frame begins, plus the whole slices between. Nothing is ever subtracted, so an amount that has left the frame leaves
  no trace. Sums over whole slices are put together from two blocks as long as the frame, again by adding only.

Rows without a card or a time have no history and are in nobody's; they are spread over salts instead of forming
one group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.operators.hotkeys import HOT_ROWS, flag_hot, hot_keys
from ledgerlark.session import materialise

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
WEEK = 7 * DAY
NO_HISTORY_SALTS = 10_000
SLICE_ROWS = 5_000_000   # rows of one slice that one task may sort
SLICE_BLOCK = 1024       # slices whose last rows are passed on in one window
_HELPERS = ("_t", "_slice", "_hot")


@dataclass(frozen=True)
class Entity:
    """Column names of the history: who, when, which row, how much."""

    key: str = "card_number"
    time: str = "transaction_time"
    row_id: str = "transaction_id"
    amount: str = "amount"


def fitting_slice(hot_rows: DataFrame, e: Entity, slice_rows: int = SLICE_ROWS) -> int:
    """The longest of hour, minute and second whose fullest slice of a card is still small."""
    for size in (HOUR, MINUTE):
        fullest = (hot_rows.groupBy(e.key, F.floor(F.col("_t") / size)).count().agg(F.max("count")).first()[0] or 0)
        if fullest <= slice_rows:
            return size
    return SECOND


def _known(e: Entity) -> Column:
    return F.col(e.key).isNotNull() & F.col("_t").isNotNull()


# --- row frames -----------------------------------------------------------------------------

def _last(rows: Column, n: int) -> Column:
    """The last ``n`` of an array."""
    return F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), F.lit(n))


def _copies(rows: DataFrame, e: Entity, halo: int) -> DataFrame:
    """For every slice of a hot card, the ``halo`` rows before it, as rows of that slice.

    Only the last ``halo`` rows of each slice can be needed by a later one. They are passed on from slice to slice
    within blocks of slices, and from block to block of a card.
    """
    latest = Window.partitionBy(e.key, "_slice").orderBy(F.desc("_t"), F.desc(e.row_id))
    row = F.struct("_t", e.row_id, e.time, e.amount)
    tails = (rows.withColumn("_nth", F.row_number().over(latest)).filter(F.col("_nth") <= halo)
             .groupBy(e.key, "_slice").agg(F.sort_array(F.collect_list(row)).alias("_tail"))
             .withColumn("_block", F.floor(F.col("_slice") / SLICE_BLOCK)))
    # Every slice that is there holds a row, so the last ``halo`` slices hold enough.
    inside = Window.partitionBy(e.key, "_block").orderBy("_slice").rowsBetween(-halo, -1)
    near = tails.withColumn("_near", _last(F.flatten(F.collect_list("_tail").over(inside)), halo))
    end = Window.partitionBy(e.key, "_block").orderBy(F.desc("_slice"))
    ends = (tails.withColumn("_nth", F.row_number().over(end)).filter(F.col("_nth") <= halo)
            .groupBy(e.key, "_block").agg(_last(F.sort_array(F.flatten(F.collect_list("_tail"))), halo).alias("_end")))
    before = Window.partitionBy(e.key).orderBy("_block").rowsBetween(-halo, -1)
    carried = ends.select(e.key, "_block", _last(F.flatten(F.collect_list("_end").over(before)), halo).alias("_carried"))
    found = near.join(carried, [e.key, "_block"]).select(
        e.key, "_slice", F.explode(_last(F.concat("_carried", "_near"), halo)).alias("_row"))
    return found.select(e.key, "_slice", "_row.*")


def _add_row_frames(sliced: DataFrame, e: Entity, back: int, copies: DataFrame | None = None) -> DataFrame:
    rows = sliced
    if copies is not None:
        rows = (sliced.withColumn("_copy", F.lit(False))
                .unionByName(copies.withColumn("_copy", F.lit(True)), allowMissingColumns=True))
    in_order = Window.partitionBy(e.key, "_slice").orderBy("_t", e.row_id)
    rows = rows.withColumns({
        "recent_avg": F.when(_known(e), F.avg(e.amount).over(in_order.rowsBetween(1 - back, 0))),
        "previous_time": F.when(_known(e), F.lag(e.time).over(in_order)),
    })
    return rows if copies is None else rows.filter(~F.col("_copy")).drop("_copy")


# --- time frames ----------------------------------------------------------------------------

def _windowed_frames(rows: DataFrame, e: Entity, spans: dict[str, int]) -> DataFrame:
    by_time = Window.partitionBy(e.key, "_slice").orderBy("_t")
    out = {}
    for name, span in spans.items():
        frame = by_time.rangeBetween(-span, -1)
        out[f"{name}_count"] = F.when(_known(e), F.count(e.amount).over(frame)).otherwise(0)
        out[f"{name}_sum"] = F.when(_known(e), F.sum(e.amount).over(frame))
    return rows.withColumns(out) if out else rows


def _asked(totals: DataFrame, questions: DataFrame, group: list[str], at: str, from_the_end: bool) -> DataFrame:
    """For each question (group, at, owner), the sums of ``n`` and ``s`` of its group up to and with ``at``, or from it on."""
    rows = (totals.select(*group, at, "n", "s", F.lit(None).cast("long").alias("owner"))
            .unionByName(questions.select(*group, at, F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("s"), "owner")))
    order = Window.partitionBy(*group).orderBy(F.desc(at) if from_the_end else at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({"n": F.sum("n").over(order), "s": F.sum("s").over(order)}).filter(F.col("owner").isNotNull())


def _whole_slices(slices: DataFrame, e: Entity, width: int) -> DataFrame:
    """(card, _slice, n, s): the ``width - 1`` slices before each slice of ``slices``."""
    size = width - 1
    block = F.floor(F.col("_slice") / size)
    totals = slices.withColumn("_block", block)
    first = slices.select(e.key, F.col("_slice").alias("owner"), (F.col("_slice") - size).alias("_slice")).withColumn("_block", block)
    last = slices.select(e.key, F.col("_slice").alias("owner"), (F.col("_slice") - 1).alias("_slice")).withColumn("_block", block)
    last = last.filter(F.pmod(F.col("owner"), F.lit(size)) != 0)     # else the frame is one whole block
    parts = _asked(totals, first, [e.key, "_block"], "_slice", True).unionByName(_asked(totals, last, [e.key, "_block"], "_slice", False))
    return parts.groupBy(e.key, F.col("owner").alias("_slice")).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _slice_frames(rows: DataFrame, e: Entity, spans: dict[str, int], slice_size: int) -> DataFrame:
    """(card, _slice, _t, counts and sums) of hot cards."""
    moments = materialise(rows.groupBy(e.key, "_slice", "_t").agg(F.count(e.amount).alias("n"), F.sum(F.col(e.amount).cast("double")).alias("s")), "moments")
    slices = moments.groupBy(e.key, "_slice").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    before = Window.partitionBy(e.key, "_slice").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    frames = moments.select(e.key, "_slice", "_t", F.sum("n").over(before).alias("own_n"), F.sum("s").over(before).alias("own_s"))
    for name, span in spans.items():
        if span % slice_size:
            raise ValueError("the slice size must divide every span")
        width = span // slice_size
        edge = moments.select(e.key, (F.col("_slice") - width).alias("_slice"), (F.col("_t") - span).alias("_t"), F.col("_t").alias("owner"))
        edge = _asked(moments, edge, [e.key, "_slice"], "_t", True).select(
            e.key, (F.col("_slice") + width).alias("_slice"), F.col("owner").alias("_t"), F.col("n").alias("edge_n"), F.col("s").alias("edge_s"))
        frames = frames.join(edge, [e.key, "_slice", "_t"], "left")
        parts = ["own", "edge"]
        if width > 1:
            whole = _whole_slices(slices, e, width).select(e.key, "_slice", F.col("n").alias("whole_n"), F.col("s").alias("whole_s"))
            frames, parts = frames.join(whole, [e.key, "_slice"], "left"), [*parts, "whole"]
        n = sum((F.coalesce(f"{p}_n", F.lit(0)) for p in parts), F.lit(0)).cast("long")
        total = sum((F.coalesce(f"{p}_s", F.lit(0.0)) for p in parts), F.lit(0.0))
        frames = frames.withColumns({f"{name}_count": n, f"{name}_sum": F.when(n > 0, total)}).drop(
            *(f"{p}_{x}" for p in parts if p != "own" for x in "ns"))
    return frames.drop("own_n", "own_s")


# --- public frames --------------------------------------------------------------------------

def _frames(df: DataFrame, e: Entity, spans: dict[str, int], back: int | None, hot: list | None, hot_rows: int,
            slice_size: int | None) -> DataFrame:
    """Row frames (when ``back`` is given) and time frames, helper columns kept.

    The source is read to count the cards, to write the rows of hot cards, and for the others; each row is
    shuffled on one road only. ``hot`` names the hot cards instead of counting.
    """
    if hot is None:
        listed = hot_keys(df, e.key, hot_rows)
        listed = None if listed.isEmpty() else listed
    else:
        kind = df.schema[e.key].dataType.simpleString()
        listed = df.sparkSession.createDataFrame([(k,) for k in hot], f"`{e.key}` {kind}") if hot else None
    rows = flag_hot(df.withColumn("_t", F.unix_micros(F.col(e.time))), e.key, listed, "_hot")
    rows = rows.withColumn("_hot", F.col("_hot") & F.col("_t").isNotNull())
    salt = -1 - F.pmod(F.xxhash64(e.row_id), F.lit(NO_HISTORY_SALTS))
    cold = rows.filter(~F.col("_hot")) if listed is not None else rows
    cold = cold.withColumn("_slice", F.when(_known(e), 0).otherwise(salt).cast("bigint"))
    if back:
        cold = _add_row_frames(cold, e, back)
    cold = _windowed_frames(cold, e, spans)
    if listed is None:
        return cold
    large = materialise(rows.filter("_hot"), "hot-rows")
    slice_size = slice_size or fitting_slice(large, e)
    large = large.withColumn("_slice", F.floor(F.col("_t") / slice_size).cast("bigint"))
    narrow = large.select(e.key, e.time, e.row_id, e.amount, "_t", "_slice")
    framed = large
    if back:
        framed = _add_row_frames(large, e, back, materialise(_copies(narrow, e, max(back - 1, 1)), "copies"))
    if spans:
        framed = framed.join(_slice_frames(narrow, e, spans, slice_size), [e.key, "_slice", "_t"])
    return cold.unionByName(framed)


def add_time_frames(df: DataFrame, spans: dict[str, int], entity: Entity = Entity(), hot: list | None = None,
                    hot_rows: int = HOT_ROWS, slice_size: int | None = None) -> DataFrame:
    """``<name>_count`` and ``<name>_sum`` of the entity's amounts in ``[t - span, t)`` microseconds.

    The left edge is included, rows of the same instant are not. An empty frame counts 0 and sums NULL.
    """
    return _frames(df, entity, spans, None, hot, hot_rows, slice_size).drop(*_HELPERS)


def add_row_frames(df: DataFrame, entity: Entity = Entity(), back: int = 7, hot: list | None = None,
                   hot_rows: int = HOT_ROWS, slice_size: int | None = None) -> DataFrame:
    """``recent_avg`` over the last ``back`` rows including this one, and ``previous_time``."""
    return _frames(df, entity, {}, back, hot, hot_rows, slice_size).drop(*_HELPERS)


# --- named features -------------------------------------------------------------------------

def add_user_activity(df: DataFrame, entity: Entity = Entity(), **routing) -> DataFrame:
    """``user_activity_24h``: the entity's earlier transactions within 24 hours."""
    return (add_time_frames(df, {"_day": DAY}, entity, **routing)
            .withColumnRenamed("_day_count", "user_activity_24h").drop("_day_sum"))


def _ratio(e: Entity) -> Column:
    return F.coalesce(F.try_divide(F.col(e.amount), F.col("recent_avg")), F.lit(1.0))


def add_amount_ratio(df: DataFrame, entity: Entity = Entity(), back: int = 7, **routing) -> DataFrame:
    """``amount_to_avg_ratio``: amount over the mean of the last ``back`` rows, 1 when undefined."""
    return (add_row_frames(df, entity, back, **routing)
            .withColumn("amount_to_avg_ratio", _ratio(entity)).drop("recent_avg", "previous_time"))


def add_behaviour(df: DataFrame, entity: Entity = Entity(), hot: list | None = None,
                  hot_rows: int = HOT_ROWS, slice_size: int | None = None, back: int = 7) -> DataFrame:
    """All history features: activity in 24 h, mean of the past 7 days, seconds since the last
    transaction, amount ratio.

    All windows share one shuffle and one sort: row frames order by (time, id), time frames by its prefix.
    """
    e = entity
    rows = _frames(df, e, {"_day": DAY, "_week": WEEK}, back, hot, hot_rows, slice_size)
    return rows.withColumns({
        "user_activity_24h": F.col("_day_count"),
        "rolling_avg_7d": F.try_divide(F.col("_week_sum"), F.col("_week_count")),
        "time_since_last_txn": (F.col("_t") - F.unix_micros(F.col("previous_time"))) / 1e6,
        "amount_to_avg_ratio": _ratio(e),
    }).drop("_day_count", "_day_sum", "_week_count", "_week_sum", "recent_avg", "previous_time", *_HELPERS)


def user_profile(df: DataFrame, entity: Entity = Entity()) -> DataFrame:
    """Per-entity daily totals: the history table a stream joins against."""
    e = entity
    return (df.filter(F.col(e.key).isNotNull())
            .groupBy(e.key, F.to_date(e.time).alias("day"))
            .agg(F.count(e.amount).alias("txn_count"), F.sum(e.amount).alias("amount_sum"),
                 F.avg(e.amount).alias("amount_avg"), F.max(e.time).alias("last_time")))


def merge_profile(daily: DataFrame, entity: Entity = Entity()) -> DataFrame:
    """Daily totals to one row per entity."""
    return (daily.groupBy(entity.key)
            .agg(F.sum("txn_count").alias("txn_count"), F.sum("amount_sum").alias("amount_sum"),
                 F.max("last_time").alias("last_time"))
            .withColumn("amount_avg", F.try_divide("amount_sum", "txn_count")))
