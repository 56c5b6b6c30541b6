"""Row-level operators: keep-latest, mandatory fields, filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Arrival coordinates used to break ties between equal ingest times.
ARRIVAL_COLUMNS = ("_kafka_offset", "_kafka_partition", "_file_path")


def keep_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str = "_ingested_at",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the latest ``order_by``.

    Rows with a NULL key form one group. Ties go to the highest arrival
    coordinates, then to a hash of the whole row, so a re-run picks the same row.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle, so a key holding most rows reaches its reducer as one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tiebreak is None:
        tiebreak = [c for c in ARRIVAL_COLUMNS if c in df.columns]
    order = [f"`{c}` DESC NULLS LAST" for c in (order_by, *tiebreak)]
    whole_row = ", ".join(f"`{c}`" for c in df.columns)
    ranked = df.selectExpr("*", f"""row_number() OVER (
        PARTITION BY {', '.join(f'`{k}`' for k in keys)}
        ORDER BY {', '.join(order)}, xxhash64({whole_row}) DESC) AS _rank""")
    return ranked.where("_rank = 1").drop("_rank")


def present(fields: Iterable[str], df: DataFrame) -> list[str]:
    return [f for f in fields if f in df.columns]


def all_present(fields: Iterable[str]) -> Column:
    """True when every field is set."""
    condition = F.lit(True)
    for field in fields:
        condition = condition & F.col(field).isNotNull()
    return condition


def require_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL in a mandatory field; fields the frame lacks are skipped."""
    known = present(fields, df)
    return df.where(all_present(known)) if known else df


def successful(df: DataFrame) -> DataFrame:
    """Completed transactions and successful payments; NULL states do not qualify."""
    return df.where((F.col("status") == "completed") | (F.col("payment_status") == "success"))


def purchases(df: DataFrame) -> DataFrame:
    return df.where(F.col("txn_type") == "purchase")


def from_source(df: DataFrame, source: str, tag: str = "event_source") -> DataFrame:
    return df.where(F.col(tag) == source)
