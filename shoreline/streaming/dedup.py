"""Streaming twin of keep-latest: the first delivery of a key within the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.operators.joins import row_salt

OUT_OF_ORDER_BOUND = "30 seconds"


def with_event_time(
    records: DataFrame, column: str = "timestamp", bound: str = OUT_OF_ORDER_BOUND
) -> DataFrame:
    """Accept events up to ``bound`` behind the latest one seen.

    Several topics in one query share a watermark; set
    ``spark.sql.streaming.multipleWatermarkPolicy=max`` if an idle stream must not
    hold back the others.
    """
    return records.withWatermark(column, bound)


def first_delivery(
    events: DataFrame,
    key: str,
    time_column: str = "timestamp",
    bound: str = OUT_OF_ORDER_BOUND,
    salts: int = 1,
) -> DataFrame:
    """Drop repeated deliveries of a key that arrive within the bound.

    Rows without a key are dropped. A key that is delivered very often is first
    reduced on ``salts`` sub-keys in parallel, then once more as a whole.
    ``salts=1`` skips the first step and its state.
    """
    timed = with_event_time(events.where(F.col(key).isNotNull()), time_column, bound)
    if salts > 1:
        spread = timed.withColumn("_salt", row_salt(timed, salts))
        timed = spread.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark([key])
