"""Per-card history in keyed operator state, with event-time timers that end it.

``HistoryStream`` keeps the past in a store of files; here it lives in the state store of the stateful operator. The state is keyed
by (bucket of cards, time slice): a call of the operator serves all cards of a bucket with array operations, so rows and not cards make the
cost, and the rows of a card with a third of the traffic are not in one task. A row goes to its own slice, which emits its
features, and to the slices after it whose frames reach back to it. A key holds pieces that are only ever appended: rows (card, time, amount) of the
slices in which a frame can begin or end, and totals by card of those between. What has no rows of its own slice in a batch only appends.

A timer at the end of the slice drops the whole state of a key once the watermark is there; rows behind the watermark
are dropped by the operator. Rows of one micro-batch are ordered by (time, id); what arrives late but within the watermark is counted for later
rows, and what was emitted is not rewritten. So the result equals the batch features when batches come in order of time.
``time_since_last_txn`` sees back as far as the state does: to the begin of the slice in which the 7 days before the row's own slice begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ledgerlark.operators.history import DAY, WEEK, Entity

COLUMNS = {"user_activity_24h": "long", "txn_count_7d": "long", "amount_sum_7d": "double", "rolling_avg_7d": "double",
           "time_since_last_txn": "double"}
PIECE = 1 << 18            # rows in one entry of the state
MANY = 16                  # entries that are put together when they are read
_NEVER = -(1 << 62)
_ROWS = pa.schema([("card", pa.string()), ("t", pa.int64()), ("amount", pa.float64())])
_BEFORE = pa.schema([("card", pa.string()), ("n", pa.int64()), ("total", pa.float64()), ("last", pa.int64())])


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> list[tuple[bytes]]:
    """Entries of a list state."""
    out = []
    for start in range(0, len(frame), PIECE):
        part, sink = frame.iloc[start:start + PIECE], pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([pa.array(part[f.name].to_numpy(), f.type) for f in schema], schema=schema)
        with pa.ipc.new_stream(sink, schema) as writer:
            writer.write_batch(batch)
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _held(state, schema: pa.Schema) -> pd.DataFrame:
    pieces = [bytes(v[0]) for v in state.get()] if state.exists() else []
    batches = [b for raw in pieces for b in pa.ipc.open_stream(raw)]
    found = pa.Table.from_batches(batches, schema).to_pandas()
    if len(pieces) > MANY and len(found) < PIECE * len(pieces) // 2:
        state.put(_packed(found, schema))
    return found


class CardSlice(StatefulProcessor):
    """State and features of one (bucket, slice); input rows (card, id, t, amount, ahead), ``ahead`` slices before this one."""

    def __init__(self, slice_size: int):
        self.slice_size = slice_size
        self.reach = WEEK // slice_size

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "piece binary")
        self.before = handle.getListState("before", "piece binary")

    def _features(self, own: pd.DataFrame, rows: pd.DataFrame, before: pd.DataFrame, slice_: int) -> pd.DataFrame:
        """Features of ``own``, which are among ``rows``."""
        codes, cards = pd.factorize(pd.concat([rows["card"], before["card"]], ignore_index=True))
        row_codes, before_codes = codes[:len(rows)], codes[len(rows):]
        begin, span = (slice_ - self.reach) * self.slice_size, (self.reach + 1) * self.slice_size
        # One number orders (card, time); no frame reaches back behind ``begin``.
        at = row_codes * span + (rows["t"].to_numpy() - begin)
        order = np.argsort(at, kind="stable")
        at, amount = at[order], rows["amount"].to_numpy()[order]
        counts = np.concatenate(([0], np.cumsum(~np.isnan(amount))))
        # Sums run inside a card, so a huge amount leaves no trace in another one.
        sums = pd.Series(np.where(np.isnan(amount), 0.0, amount)).groupby(row_codes[order]).cumsum().to_numpy()

        own = own.assign(code=pd.Index(cards).get_indexer(own["card"])).sort_values(["code", "t", "id"])
        code, t = own["code"].to_numpy(), own["t"].to_numpy()
        here, first = code * span + (t - begin), np.searchsorted(at, code * span, side="left")
        right = np.searchsorted(at, here, side="left")

        def up_to(end: np.ndarray) -> np.ndarray:
            return np.where(end > first, sums[np.maximum(end - 1, 0)], 0.0)

        day, week = (np.searchsorted(at, here - width, side="left") for width in (DAY, WEEK))
        totals = before.assign(code=before_codes).groupby("code").agg({"n": "sum", "total": "sum", "last": "max"}).reindex(code)
        n = counts[right] - counts[week] + totals["n"].fillna(0).to_numpy("int64")
        total = np.where(right > week, up_to(right) - up_to(week), 0.0) + totals["total"].fillna(0.0).to_numpy()
        # The row before in (time, id): another one of the same time, or the last one of an earlier time.
        same = own.groupby(["code", "t"])["t"]
        nth = same.cumcount().to_numpy() + np.searchsorted(at, here, side="right") - right - same.transform("size").to_numpy()
        lasts = np.where(right > first, at[np.maximum(right - 1, 0)] - code * span + begin, _NEVER)
        last = np.where(nth > 0, t, np.maximum(lasts, totals["last"].astype("Int64").fillna(_NEVER).to_numpy("int64")))
        with np.errstate(invalid="ignore", divide="ignore"):
            return pd.DataFrame({
                "id": own["id"].to_numpy(), "user_activity_24h": counts[right] - counts[day], "txn_count_7d": n,
                "amount_sum_7d": np.where(n > 0, total, np.nan), "rolling_avg_7d": np.where(n > 0, total / n, np.nan),
                "time_since_last_txn": np.where(last > _NEVER, (t - last) / 1e6, np.nan)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        frame["amount"] = frame["amount"].astype("float64")
        between = (frame["ahead"] > 1) & (frame["ahead"] < self.reach)
        new = frame[~between]
        own = new[new["ahead"] == 0]
        if len(own):
            known = pd.concat([_held(self.rows, _ROWS), new[_ROWS.names]], ignore_index=True)
        if len(new):
            self.rows.appendList(_packed(new, _ROWS))
        if between.any():
            totals = frame[between].groupby("card").agg(n=("amount", "count"), total=("amount", "sum"), last=("t", "max")).reset_index()
            self.before.appendList(_packed(totals, _BEFORE))
        self.handle.registerTimer((int(key[1]) + 1) * self.slice_size // 1000)
        if len(own):
            yield self._features(own, known, _held(self.before, _BEFORE), int(key[1]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.rows, self.before):
            state.clear()
        return iter(())


def keyed_history(stream: DataFrame, entity: Entity = Entity(), lateness: str = "24 hours", slice_days: int = 1, buckets: int = 128) -> DataFrame:
    """(row id, ``COLUMNS``) of each row of a streaming frame, from state of ``slice_days`` (a divisor of 7) a key.

    Short slices split a hot card over more keys (1 + 7 / ``slice_days`` of them are alive) and cost as many copies of a row's card, time and
    amount in the shuffle. A call reads the rows of three slices of one of the ``buckets`` of cards, which a checkpoint fixes. Rows
    without a card or a time have no history.
    """
    if 7 % slice_days:
        raise ValueError("slice_days must divide 7")
    e, size = entity, slice_days * DAY
    marked = stream.withWatermark(e.time, lateness)
    known = F.col(e.key).isNotNull() & F.col(e.time).isNotNull()
    rows = marked.filter(known).select(
        F.col(e.key).alias("card"), F.col(e.time).alias("time"), F.unix_micros(e.time).alias("t"), F.col(e.row_id).alias("id"),
        F.col(e.amount).cast("double").alias("amount"))
    spread = rows.withColumn("ahead", F.explode(F.sequence(F.lit(0), F.lit(WEEK // size)))).withColumns({
        "bucket": F.pmod(F.xxhash64("card"), F.lit(buckets)), "slice": F.floor(F.col("t") / size) + F.col("ahead")})
    kind = stream.schema[e.row_id].dataType.simpleString()
    # Copies carry no id, but no null either: it would make floating-point numbers of the others.
    spread = spread.withColumn("id", F.when(F.col("ahead") == 0, F.col("id")).otherwise(F.lit(0).cast(kind)))
    found = spread.groupBy("bucket", "slice").transformWithStateInPandas(
        CardSlice(size), f"id {kind}, " + ", ".join(f"{c} {t}" for c, t in COLUMNS.items()), "Append", "EventTime")
    none = marked.filter(~known).select(F.col(e.row_id).alias("id"), *(
        F.lit(0 if t == "long" else None).cast(t).alias(c) for c, t in COLUMNS.items()))
    return found.unionByName(none).select(F.col("id").alias(e.row_id), *(
        F.col(c) if t == "long" else F.nanvl(c, F.lit(None).cast("double")).alias(c) for c, t in COLUMNS.items()))
