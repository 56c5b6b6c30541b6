from collections import Counter

from pyspark.sql import functions as F

from compare import plan_of
from shoreline.operators import rows

SCHEMA = "id string, v int, _ingested_at timestamp, _kafka_offset bigint"


def kept(df):
    return sorted((r.id or "", r.v) for r in rows.keep_latest(df, "id").collect())


def test_latest_wins_and_null_time_loses(frame):
    df = frame([
        ("a", 1, "2024-01-01 00:00:00", 1), ("a", 2, "2024-01-01 00:00:01", 2),
        ("a", 3, None, 3), ("b", 9, None, 1),
    ], SCHEMA)
    assert kept(df) == [("a", 2), ("b", 9)]


def test_equal_times_go_to_the_higher_offset(frame):
    at = "2024-01-01 00:00:00"
    df = frame([("a", i, at, i) for i in range(20)], SCHEMA)
    assert kept(df) == [("a", 19)]


def test_full_tie_is_stable_across_partitionings(frame):
    at = "2024-01-01 00:00:00"
    df = frame([("a", i, at, 1) for i in range(50)], SCHEMA)
    picks = {tuple(kept(df.repartition(n))) for n in (1, 3, 7)}
    assert len(picks) == 1


def test_null_keys_form_one_group(frame):
    df = frame([(None, 1, "2024-01-01 00:00:00", 1), (None, 2, "2024-01-02 00:00:00", 1)], SCHEMA)
    assert kept(df) == [("", 2)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows share a key; each task sends one row of it."""
    df = spark.range(0, 30000, numPartitions=8).select(
        F.when(F.col("id") < 10000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("int").alias("v"),
        F.timestamp_seconds("id").alias("_ingested_at"),
    )
    latest = rows.keep_latest(df, "id")
    plan = plan_of(latest)
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert latest.count() == 20001
    assert latest.where("id = 'hot'").first().v == 9999


def test_random_rows_against_brute_force(frame):
    import random

    rng = random.Random(7)
    data = [
        (rng.choice("abcdef"), i, f"2024-01-01 00:00:{rng.randint(0, 9):02d}", i) for i in range(300)
    ]
    best = {}
    for row in data:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: (r[2], r[3]))
    assert kept(frame(data, SCHEMA)) == sorted((r[0], r[1]) for r in best.values())


def test_require_fields_skips_unknown_names(frame):
    df = frame([("a", 1), (None, 2), ("c", None)], "id string, v int")
    got = rows.require_fields(df, ["id", "renamed_away"]).collect()
    assert Counter(r.id for r in got) == Counter(["a", "c"])
    assert rows.require_fields(df, ["nothing"]).count() == 3


def test_successful_uses_three_valued_logic(frame):
    df = frame([
        ("completed", None), (None, "success"), ("failed", None), (None, None),
        ("failed", "success"), (None, "failed"),
    ], "status string, payment_status string")
    assert rows.successful(df).count() == 3
