import datetime as dt
import random

import pandas as pd
import pytest

from pyspark.sql import functions as F

from ledgerlark.operators import history
from ledgerlark.operators.history import Entity, add_behaviour, add_user_activity, fitting_slice
from ledgerlark.operators.hotkeys import hot_keys

START = dt.datetime(2024, 3, 1)
COLUMNS = ["user_activity_24h", "rolling_avg_7d", "time_since_last_txn", "amount_to_avg_ratio"]


def rows(spark, n=400, seed=1):
    """One card with half of the rows, ties, an exactly 24 h old row, missing amounts and cards."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        card = None if i % 29 == 0 else "hot" if rng.random() < 0.5 else f"c{rng.randrange(12)}"
        minutes = rng.randrange(0, 20 * 24 * 4) * 15
        data.append((f"t{i:04d}", card, START + dt.timedelta(minutes=minutes),
                     None if i % 31 == 0 else round(rng.uniform(0, 200), 2)))
    data += [("x1", "edge", START, 5.0), ("x2", "edge", START + dt.timedelta(hours=24), 7.0),
             ("x3", "edge", START + dt.timedelta(hours=24), 0.0)]
    return spark.createDataFrame(data, "transaction_id string, card_number string, transaction_time timestamp, amount double")


def brute(pdf: pd.DataFrame) -> dict:
    out = {}
    for r in pdf.itertuples():
        if r.card_number is None:
            out[r.transaction_id] = (0, None, None, 1.0)
            continue
        mine = pdf[pdf.card_number == r.card_number]
        before = mine[mine.transaction_time < r.transaction_time]
        day = before[before.transaction_time >= r.transaction_time - pd.Timedelta(hours=24)].amount.dropna()
        week = before[before.transaction_time >= r.transaction_time - pd.Timedelta(days=7)].amount.dropna()
        ordered = mine.sort_values(["transaction_time", "transaction_id"]).reset_index(drop=True)
        at = ordered.index[ordered.transaction_id == r.transaction_id][0]
        recent = ordered.loc[max(0, at - 6):at].amount.dropna()
        gap = (r.transaction_time - ordered.transaction_time[at - 1]).total_seconds() if at else None
        ratio = r.amount / recent.mean() if len(recent) and recent.mean() and r.amount == r.amount else 1.0
        out[r.transaction_id] = (len(day), week.mean() if len(week) else None, gap, ratio)
    return out


def same(a, b):
    return (a is None or a != a) if b is None else a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("hot, slice_size", [([], None), (["hot"], None), (["hot", "c1", "edge"], 60_000_000)])
def test_history_equals_brute_force(spark, hot, slice_size):
    df = rows(spark)
    got = add_behaviour(df, hot=hot, slice_size=slice_size).select("transaction_id", *COLUMNS).collect()
    wanted = brute(df.toPandas())
    assert len(got) == len(wanted)
    for r in got:
        assert all(same(r[c], w) for c, w in zip(COLUMNS, wanted[r["transaction_id"]])), (r, wanted[r["transaction_id"]])


def test_left_edge_is_inside_and_ties_are_outside(spark):
    got = {r[0]: r[1] for r in add_user_activity(rows(spark)).filter("card_number = 'edge'")
           .select("transaction_id", "user_activity_24h").collect()}
    assert got == {"x1": 0, "x2": 1, "x3": 1}


def test_hot_cards_are_found_by_size(spark):
    df = rows(spark)
    found = lambda n: {r[0] for r in hot_keys(df, "card_number", n).collect()}
    assert found(100) == {"hot"} and found(10_000) == set()
    assert len(found(1)) == df.filter("card_number IS NOT NULL").select("card_number").distinct().count()


def test_counted_hot_cards_change_nothing(spark):
    df = rows(spark)
    cold, hot = ({r["transaction_id"]: r for r in add_behaviour(df, hot_rows=n).collect()} for n in (10_000, 20))
    assert cold.keys() == hot.keys()
    assert all(same(hot[i][c], r[c]) for i, r in cold.items() for c in COLUMNS)


def test_slices_get_shorter_for_bursts(spark):
    df = rows(spark).filter("card_number = 'hot'").withColumn("_t", F.unix_micros("transaction_time"))
    assert fitting_slice(df, Entity(), 1000) == 3_600_000_000
    assert fitting_slice(df, Entity(), 0) == 1_000_000


@pytest.mark.parametrize("slice_size", [history.SECOND, history.MINUTE, history.HOUR, history.DAY])
@pytest.mark.parametrize("odd", [1e15, float("inf")])
def test_an_odd_amount_leaves_no_trace_on_either_road(spark, slice_size, odd, monkeypatch):
    """Rows without time stay; what has left a frame does not touch it."""
    monkeypatch.setattr(history, "SLICE_BLOCK", 3)
    rng = random.Random(3)
    data = [(f"t{i:03d}", "c1", START + dt.timedelta(seconds=rng.randrange(0, 30 * 86400)), 0.01) for i in range(150)]
    data += [("odd", "c1", START + dt.timedelta(days=5), odd), ("no time", "c1", None, 3.0), ("no time either", "c1", None, 4.0)]
    df = spark.createDataFrame(data, "transaction_id string, card_number string, transaction_time timestamp, amount double")
    cold, hot = ({r["transaction_id"]: r for r in add_behaviour(df, hot=h, slice_size=slice_size).collect()} for h in ([], ["c1"]))
    assert len(cold) == len(hot) == len(data)
    week = dt.timedelta(days=7)
    for name, r in cold.items():
        other = hot[name]
        for c in COLUMNS:
            assert same(other[c], r[c]) or (r[c] != r[c] and other[c] != other[c]) or abs(other[c] - r[c]) <= 1e-9 * abs(r[c]), (c, name)
        if r["transaction_time"] is None:
            assert [r[c] for c in COLUMNS] == [0, None, None, 1.0]
        elif r["transaction_time"] - START - dt.timedelta(days=5) > week and r["rolling_avg_7d"] is not None:
            assert other["rolling_avg_7d"] == pytest.approx(0.01, rel=1e-12)
