"""Domain tables in the wide form: dedup per source before the union, source-side names.

A source may be missing (``None``). A domain whose sources are all missing has no table.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.operators import orders as order_totals
from shoreline.operators.rows import keep_latest, require_fields
from shoreline.operators.shape import (
    cast_times,
    rename_if_free,
    select_existing,
    stack_by_name,
    stamp,
)


def _clean(df: DataFrame, source: str, key: str) -> DataFrame:
    """Typed times, latest row per key, mandatory fields that still exist under their name."""
    return require_fields(keep_latest(cast_times(df), key), schemas.MANDATORY_FIELDS[source])


def _finish(df: DataFrame, domain: str, date: str) -> DataFrame:
    return select_existing(stamp(df, date), list(schemas.WIDE_DOMAINS[domain]))


def _merge_streams(
    frames: dict[str, DataFrame | None], key: str, domain: str, date: str
) -> DataFrame | None:
    cleaned = [
        _clean(rename_if_free(df, schemas.PRIMARY_KEYS[source], key), source, key)
        for source, df in frames.items()
        if df is not None
    ]
    return _finish(stack_by_name(*cleaned), domain, date) if cleaned else None


def events(
    user_events: DataFrame | None, clickstream: DataFrame | None, date: str
) -> DataFrame | None:
    frames = {"user_events": user_events, "clickstream": clickstream}
    return _merge_streams(frames, "event_id", "events", date)


def transactions(
    transactions: DataFrame | None, payments: DataFrame | None, date: str
) -> DataFrame | None:
    frames = {"transactions": transactions, "payments": payments}
    return _merge_streams(frames, "txn_id", "transactions", date)


class Totals(NamedTuple):
    """How order totals complete a domain: what they are, and what stands for them without orders."""

    source: str
    key: str
    of: Callable[[DataFrame], DataFrame]
    absent: dict[str, float]


TOTALS = {
    "customers": Totals(
        "crm", "customer_id", order_totals.by_customer_wide, {"total_orders": 0, "total_spent": 0.0}),
    "inventory": Totals(
        "inventory", "sku",
        lambda orders: order_totals.by_product_wide(orders).withColumnRenamed("product_id", "sku"),
        {"orders_count": 0, "units_sold": 0}),
}


def _with_totals(
    domain: str, main: DataFrame, orders: DataFrame | None, date: str
) -> DataFrame:
    """The main side with its order totals: NULL for a key without orders, fixed values
    where there is no order data at all."""
    rule = TOTALS[domain]
    cleaned = _clean(main, rule.source, rule.key)
    if orders is None:
        completed = cleaned.withColumns({name: F.lit(value) for name, value in rule.absent.items()})
    else:
        completed = cleaned.join(rule.of(orders), rule.key, "left")
    return _finish(completed, domain, date)


def customers(crm: DataFrame | None, orders: DataFrame | None, date: str) -> DataFrame | None:
    """CRM rows with order totals; without CRM data the totals alone are the table."""
    if crm is not None:
        return _with_totals("customers", crm, orders, date)
    if orders is None:
        return None
    alone = TOTALS["customers"].of(orders).withColumn("_source", F.lit("orders"))
    return _finish(alone, "customers", date)


def inventory(
    inventory: DataFrame | None, orders: DataFrame | None, date: str
) -> DataFrame | None:
    """Stock rows with order totals; no stock data, no table."""
    return None if inventory is None else _with_totals("inventory", inventory, orders, date)
