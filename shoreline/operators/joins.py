"""Join shapes that hold when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_filled(
    left: DataFrame, right: DataFrame, on: str, fill: dict[str, float], right_key: str | None = None
) -> DataFrame:
    """Left equi-join; the named right-hand columns become 0 where nothing matched.

    Both sides are expected to be unique on the key (kept-latest left, aggregated
    right), so neither side has a hot key left when it is shuffled.
    """
    if right_key and right_key != on:
        right = right.withColumnRenamed(right_key, on)
    return left.join(right, on, "left").fillna(fill)


def row_salt(df: DataFrame, salts: int) -> Column:
    """Sub-key of a row, taken from its content and its task.

    It does not depend on the row order, so a re-run of a lost task gives the same
    sub-keys; the task number spreads identical copies, which hash alike.
    """
    content = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(salts)).cast("int")
