"""Domain tables, one plan per domain. Inputs are raw frames, one per source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.functions.measures import stock_status
from shoreline.operators import orders as order_totals
from shoreline.operators.joins import left_join_filled
from shoreline.operators.rows import ARRIVAL_COLUMNS, keep_latest, require_fields
from shoreline.operators.shape import align, stack_by_name, stamp

# Counts the rows that pass a named step, see ``quality.RowCounter``.
Watch = Callable[[DataFrame, str], DataFrame]

CUSTOMER_FILL = {"total_orders": 0, "total_order_value": 0.0, "avg_order_value": 0.0}
PRODUCT_FILL = {"total_quantity_sold": 0, "total_orders": 0, "total_sales_value": 0.0}


def _with_arrival(df: DataFrame, target: schemas.Columns, **given: str) -> DataFrame:
    """Align to the domain columns, keeping the arrival coordinates for tie-breaking."""
    types = {**schemas.STREAM_ENVELOPE, **schemas.BATCH_ENVELOPE}
    arrival = {name: types[name] for name in ARRIVAL_COLUMNS}
    return align(df, {**target, **arrival}, **given)


def events_from_user_events(df: DataFrame) -> DataFrame:
    return _with_arrival(df, schemas.EVENTS, event_source="'user_events'")


def events_from_clickstream(df: DataFrame) -> DataFrame:
    return _with_arrival(
        df,
        schemas.EVENTS,
        event_id="request_id",
        event_source="'clickstream'",
        page_url="path",
    )


def transactions_from_transactions(df: DataFrame) -> DataFrame:
    return _with_arrival(
        df,
        schemas.TRANSACTIONS,
        transaction_id="txn_id",
        transaction_source="'transactions'",
    )


def transactions_from_payments(df: DataFrame) -> DataFrame:
    return _with_arrival(
        df,
        schemas.TRANSACTIONS,
        transaction_id="payment_id",
        transaction_source="'payments'",
        timestamp="try_to_timestamp(payment_date)",
    )


def merge_events(user_events: DataFrame, clickstream: DataFrame) -> DataFrame:
    return stack_by_name(events_from_user_events(user_events), events_from_clickstream(clickstream))


def merge_transactions(transactions: DataFrame, payments: DataFrame) -> DataFrame:
    return stack_by_name(
        transactions_from_transactions(transactions), transactions_from_payments(payments)
    )


def _latest_complete(
    df: DataFrame, key: str, required: list[str], watch: Watch | None = None
) -> DataFrame:
    """Keep-latest, then the mandatory fields: a newer incomplete row replaces an older one.

    Rows without a key are removed first. They would form a single group, which the
    mandatory-field filter removes anyway, and all of them would be sorted for nothing.
    """
    seen = watch or (lambda frame, _: frame)
    latest = keep_latest(seen(df, "read").where(F.col(key).isNotNull()), key)
    return seen(require_fields(seen(latest, "unique"), required), "complete")


def events(
    user_events: DataFrame, clickstream: DataFrame, date: str, watch: Watch | None = None
) -> DataFrame:
    merged = merge_events(user_events, clickstream)
    rows = _latest_complete(merged, "event_id", schemas.DOMAIN_REQUIRED["events"], watch)
    return stamp(rows.select(*schemas.EVENTS), date)


def transactions(
    transactions: DataFrame, payments: DataFrame, date: str, watch: Watch | None = None
) -> DataFrame:
    merged = merge_transactions(transactions, payments)
    required = schemas.DOMAIN_REQUIRED["transactions"]
    rows = _latest_complete(merged, "transaction_id", required, watch)
    return stamp(rows.select(*schemas.TRANSACTIONS), date)


def merge_customers(crm: DataFrame, orders: DataFrame) -> DataFrame:
    """CRM rows with order totals; the latest order date stays NULL without orders."""
    return left_join_filled(
        crm, order_totals.by_customer(orders), on="customer_id", fill=CUSTOMER_FILL
    )


def customers(
    crm: DataFrame,
    orders: DataFrame,
    date: str,
    dedup_orders: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    """Customer table. Only the CRM rows carry the key being deduplicated and the totals
    are unique per customer, so the dedup runs before the join on far fewer rows."""
    latest = _latest_complete(crm, "customer_id", schemas.DOMAIN_REQUIRED["customers"], watch)
    if dedup_orders:
        orders = keep_latest(orders, "order_id")
    return stamp(align(merge_customers(latest, orders), schemas.CUSTOMERS), date)


def merge_inventory(
    inventory: DataFrame, orders: DataFrame, out_of_stock_first: bool = False
) -> DataFrame:
    """Stock rows with sales totals and a stock label."""
    merged = left_join_filled(
        inventory, order_totals.by_product(orders), on="sku", fill=PRODUCT_FILL,
        right_key="product_id",
    )
    label = stock_status("quantity_on_hand", "reorder_point", out_of_stock_first)
    return merged.withColumn("stock_status", label)


def inventory(
    inventory: DataFrame,
    orders: DataFrame,
    date: str,
    dedup_orders: bool = False,
    out_of_stock_first: bool = False,
    watch: Watch | None = None,
) -> DataFrame:
    latest = _latest_complete(inventory, "sku", schemas.DOMAIN_REQUIRED["inventory"], watch)
    if dedup_orders:
        orders = keep_latest(orders, "order_id")
    merged = merge_inventory(latest, orders, out_of_stock_first)
    return stamp(align(merged, schemas.INVENTORY), date)
