from pyspark.sql import functions as F

from shoreline.operators import joins


def facts(spark):
    """A third of the rows are copies of one reading of one key."""
    return spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") < 1000, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.when(F.col("id") < 1000, F.lit(1)).otherwise(F.col("id")).alias("v"),
    )


def test_copies_are_spread(spark):
    hot = facts(spark).where("key = 'hot'")
    assert hot.select(joins.row_salt(hot, 8)).distinct().count() > 1


def test_zero_fill(frame):
    left = frame([("a",), ("b",), (None,)], "id string")
    right = frame([("a", 2, 3.0), (None, 7, 8.0)], "pid string, n int, total double")
    got = joins.left_join_filled(left, right, "id", {"n": 0, "total": 0.0}, right_key="pid")
    assert sorted((r.id or "", r.n, r.total) for r in got.collect()) == [
        ("", 0, 0.0), ("a", 2, 3.0), ("b", 0, 0.0),
    ]
