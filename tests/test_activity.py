"""Days merged one by one against the whole history."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import plan_of
from shoreline.plans import gold
from shoreline.plans.activity import Activity
from shoreline.sources import commits
from shoreline.sources.lake import Lake


def history(frame, seed, users=12, days=9, n=90):
    pick = random.Random(seed)
    rows = [(f"e{i}" if pick.random() < 0.9 else None, pick.choice([None, *map(str, range(users))]),
             f"2024-01-{1 + int(pick.random() ** 2 * days):02d} 0{pick.randrange(9)}:00:00") for i in range(n)]
    return frame(rows, "event_id string,user_id string,timestamp timestamp")


def grid(df):
    return sorted((str(r.cohort_date), r.days_since_cohort, r.cohort_size, r.active_users, r.retention_rate_pct, r.total_events)
                  for r in df.collect())


def dates_of(events):
    return sorted(str(r.d) for r in events.select(F.to_date("timestamp").alias("d")).distinct().collect())


@pytest.mark.parametrize("block_days", [3, 63])
def test_days_in_any_order_equal_the_whole_history(spark, frame, tmp_path, block_days):
    events = history(frame, block_days).cache()
    state = Activity(spark, Lake(str(tmp_path)), block_days)
    dates = dates_of(events)
    random.Random(1).shuffle(dates)
    for date in dates + dates[:2]:
        state.merge_day(events, date)
    assert grid(state.retention()) == grid(gold.user_retention(events))
    first = {r.user_id: str(r.first_date) for r in state.first_seen().collect()}
    whole = events.where("user_id IS NOT NULL").groupBy("user_id").agg(F.min(F.to_date("timestamp")).alias("d")).collect()
    assert first == {r.user_id: str(r.d) for r in whole}


def test_a_day_that_changes(spark, frame, tmp_path):
    """Events come late to an old block, then are taken back: first days and their kept minima follow."""
    events = history(frame, 3).cache()
    extra = frame([("x1", "0", "2024-01-01 01:00:00"), ("x2", "new", "2024-01-02 01:00:00")],
                  "event_id string,user_id string,timestamp timestamp")
    state = Activity(spark, Lake(str(tmp_path)), 2)
    for date in dates_of(events):
        state.merge_day(events, date)
    assert state.first_seen().count() and commits.current(spark, state.minima)
    for now in (events.union(extra), events.where("user_id <> '3' OR timestamp > '2024-01-04'"), events):
        for date in ("2024-01-01", "2024-01-02", "2024-01-03"):
            state.merge_day(now, date)
        rest = now.where("timestamp < '2024-01-04'").union(events.where("timestamp >= '2024-01-04'"))
        assert grid(state.retention()) == grid(gold.user_retention(rest))


def test_a_late_window_keeps_old_cohorts(spark, frame, tmp_path):
    events = frame([("1", "a", "2024-01-01 01:00:00"), ("2", "a", "2024-01-09 01:00:00"), ("3", "b", "2024-01-09 01:00:00")],
                   "event_id string,user_id string,timestamp timestamp")
    state = Activity(spark, Lake(str(tmp_path)), 3)
    assert state.first_seen().count() == 0 and state.retention().count() == 0
    for date in dates_of(events):
        state.merge_day(events, date)
    assert grid(state.retention(since="2024-01-05")) == [
        ("2024-01-01", 8, 1, 1, 100.0, 1), ("2024-01-09", 0, 1, 1, 100.0, 1)]
    with pytest.raises(ValueError, match="blocks of 3 days"):
        Activity(spark, Lake(str(tmp_path)), 4).blocks()


def test_a_finished_block_is_read_as_minima(spark, frame, tmp_path):
    events = history(frame, 5).cache()
    state = Activity(spark, Lake(str(tmp_path)), 3)
    for date in dates_of(events):
        state.merge_day(events, date)
    state.first_seen().count()
    again = state.first_seen().inputFiles()
    # one block and the minima before it, however many blocks there are
    assert len({f.split("/state/")[1].split("/_versions")[0] for f in again}) == 2 < len(state.blocks())


def test_a_day_is_shuffled_once(spark, frame, tmp_path, monkeypatch):
    events = history(frame, 5)
    state = Activity(spark, Lake(str(tmp_path)))
    first, second = dates_of(events)[:2]
    state.merge_day(events, first)
    written = []
    monkeypatch.setattr(state, "_write", lambda df, *_, **__: written.append(df))
    state.merge_day(events, second)
    # one for the state and one for the day's users
    assert plan_of(written[0]).count("Exchange hashpartitioning") == 2
