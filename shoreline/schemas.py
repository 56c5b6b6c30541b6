"""Column names and types of every layer, as Spark DDL types.

Fixed values: names, types, keys and NOT NULL lists are the data contract of the
lake, so they are written out as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

Columns = dict[str, str]


def ddl(columns: Columns) -> str:
    return ", ".join(f"`{name}` {dtype}" for name, dtype in columns.items())


# --- raw layer -------------------------------------------------------------

STREAM_ENVELOPE: Columns = {
    "_source": "string",
    "_kafka_topic": "string",
    "_kafka_partition": "int",
    "_kafka_offset": "bigint",
    "_ingested_at": "timestamp",
    "_job": "string",
    "_raw": "string",
}

BATCH_ENVELOPE: Columns = {
    "_source": "string",
    "_file_path": "string",
    "_ingested_at": "timestamp",
    "_job": "string",
    "_raw": "string",
}

PAYLOADS: dict[str, Columns] = {
    "user_events": {
        "event_id": "string",
        "user_id": "string",
        "session_id": "string",
        "event_type": "string",
        "page_url": "string",
        "referrer": "string",
        "device": "string",
        "browser": "string",
        "country": "string",
        "timestamp": "timestamp",
    },
    "clickstream": {
        "request_id": "string",
        "method": "string",
        "path": "string",
        "status_code": "int",
        "latency_ms": "int",
        "bytes_sent": "bigint",
        "user_agent": "string",
        "ip_address": "string",
        "timestamp": "timestamp",
    },
    "transactions": {
        "txn_id": "string",
        "user_id": "string",
        "txn_type": "string",
        "amount": "double",
        "currency": "string",
        "payment_method": "string",
        "status": "string",
        "merchant_id": "string",
        "timestamp": "timestamp",
    },
    "iot_sensors": {
        "reading_id": "string",
        "sensor_id": "string",
        "sensor_type": "string",
        "value": "double",
        "unit": "string",
        "location": "string",
        "timestamp": "timestamp",
    },
    "app_logs": {
        "log_id": "string",
        "level": "string",
        "service": "string",
        "message": "string",
        "trace_id": "string",
        "span_id": "string",
        "host": "string",
        "timestamp": "timestamp",
    },
    "alerts": {
        "alert_id": "string",
        "severity": "string",
        "alert_type": "string",
        "source_system": "string",
        "message": "string",
        "timestamp": "timestamp",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "product_id": "string",
        "quantity": "int",
        "unit_price": "double",
        "total_amount": "double",
        "discount_pct": "int",
        "status": "string",
        "order_date": "string",
        "shipping_address": "string",
    },
    "crm": {
        "customer_id": "string",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "phone": "string",
        "segment": "string",
        "lifetime_value": "double",
        "registered_date": "string",
        "last_purchase_date": "string",
        "preferences": "struct<newsletter:boolean,sms_alerts:boolean,preferred_channel:string>",
    },
    "inventory": {
        "sku": "string",
        "product_name": "string",
        "category": "string",
        "warehouse": "string",
        "quantity_on_hand": "int",
        "reorder_point": "int",
        "unit_cost": "double",
        "last_restock_date": "string",
        "snapshot_date": "string",
    },
    "payments": {
        "payment_id": "string",
        "order_id": "string",
        "customer_id": "string",
        "amount": "double",
        "currency": "string",
        "payment_method": "string",
        "payment_status": "string",
        "gateway": "string",
        "transaction_fee": "double",
        "payment_date": "string",
        "metadata": "struct<ip:string,device:string>",
    },
}

# Narrow read of orders for the product view: the scan parses these fields only.
PRODUCT_ORDER_COLUMNS = ["order_id", "product_id", "quantity", "total_amount", "order_date"]

TOPIC_SOURCES = {
    "events.user": "user_events",
    "events.txn": "transactions",
    "events.iot": "iot_sensors",
    "logs.app": "app_logs",
    "clicks.web": "clickstream",
}
UNKNOWN_SOURCE = "unknown"

BATCH_SOURCES = {"orders": "csv", "inventory": "csv", "crm": "json", "payments": "json"}

RAW_SOURCES = [*dict.fromkeys(TOPIC_SOURCES.values()), *BATCH_SOURCES, UNKNOWN_SOURCE]

PRIMARY_KEYS = {
    "user_events": "event_id",
    "clickstream": "request_id",
    "transactions": "txn_id",
    "payments": "payment_id",
    "crm": "customer_id",
    "orders": "order_id",
    "inventory": "sku",
    "iot_sensors": "reading_id",
    "app_logs": "log_id",
}

MANDATORY_FIELDS = {
    "user_events": ["event_id", "user_id", "timestamp"],
    "clickstream": ["request_id", "path", "timestamp"],
    "transactions": ["txn_id", "amount", "timestamp"],
    "payments": ["payment_id", "amount", "payment_date"],
    "crm": ["customer_id", "email"],
    "orders": ["order_id", "customer_id", "order_date"],
    "inventory": ["sku", "quantity_on_hand"],
    "iot_sensors": ["reading_id", "sensor_id", "value"],
    "app_logs": ["log_id", "level", "message"],
}


def raw_columns(source: str) -> Columns:
    """Payload plus envelope of one raw source, without the verbatim text."""
    envelope = BATCH_ENVELOPE if source in BATCH_SOURCES else STREAM_ENVELOPE
    return {**PAYLOADS[source], **{k: v for k, v in envelope.items() if k != "_raw"}}


# --- domain layer, one table per domain -------------------------------------

AUDIT: Columns = {"_processed_at": "timestamp", "dt": "date"}

EVENTS: Columns = {
    "event_id": "string",
    "event_source": "string",
    "timestamp": "timestamp",
    "user_id": "string",
    "session_id": "string",
    "event_type": "string",
    "page_url": "string",
    "referrer": "string",
    "device": "string",
    "browser": "string",
    "country": "string",
    "request_id": "string",
    "method": "string",
    "path": "string",
    "status_code": "int",
    "latency_ms": "int",
    "bytes_sent": "bigint",
    "user_agent": "string",
    "ip_address": "string",
    "_ingested_at": "timestamp",
}

TRANSACTIONS: Columns = {
    "transaction_id": "string",
    "transaction_source": "string",
    "timestamp": "timestamp",
    "user_id": "string",
    "txn_type": "string",
    "merchant_id": "string",
    "status": "string",
    "order_id": "string",
    "customer_id": "string",
    "payment_status": "string",
    "gateway": "string",
    "transaction_fee": "double",
    "amount": "double",
    "currency": "string",
    "payment_method": "string",
    "_ingested_at": "timestamp",
}

CUSTOMERS: Columns = {
    "customer_id": "string",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "phone": "string",
    "segment": "string",
    "lifetime_value": "double",
    "registered_date": "string",
    "last_purchase_date": "string",
    "_source": "string",
    "_ingested_at": "timestamp",
    "total_orders": "bigint",
    "total_order_value": "double",
    "latest_order_date": "string",
    "avg_order_value": "double",
}

INVENTORY: Columns = {
    "sku": "string",
    "product_name": "string",
    "category": "string",
    "warehouse": "string",
    "quantity_on_hand": "int",
    "reorder_point": "int",
    "unit_cost": "double",
    "last_restock_date": "string",
    "snapshot_date": "string",
    "_source": "string",
    "_ingested_at": "timestamp",
    "total_quantity_sold": "bigint",
    "total_orders": "bigint",
    "total_sales_value": "double",
    "stock_status": "string",
}

DOMAINS: dict[str, Columns] = {
    "events": {**EVENTS, **AUDIT},
    "transactions": {**TRANSACTIONS, **AUDIT},
    "customers": {**CUSTOMERS, **AUDIT},
    "inventory": {**INVENTORY, **AUDIT},
}

DOMAIN_REQUIRED = {
    "events": ["event_id", "timestamp", "event_source"],
    "transactions": ["transaction_id", "timestamp", "amount"],
    "customers": ["customer_id"],
    "inventory": ["sku"],
}

# --- domain layer, wide form (one job for all domains) -----------------------

WIDE_DOMAINS: dict[str, Columns] = {
    "events": {
        "event_id": "string",
        "user_id": "string",
        "session_id": "string",
        "event_type": "string",
        "page_url": "string",
        "path": "string",
        "method": "string",
        "status_code": "int",
        "latency_ms": "int",
        "device": "string",
        "browser": "string",
        "user_agent": "string",
        "ip_address": "string",
        "country": "string",
        "timestamp": "timestamp",
        "_source": "string",
        "_ingested_at": "timestamp",
        "_processed_at": "timestamp",
        "dt": "date",
    },
    "transactions": {
        "txn_id": "string",
        "payment_id": "string",
        "order_id": "string",
        "user_id": "string",
        "customer_id": "string",
        "txn_type": "string",
        "amount": "double",
        "currency": "string",
        "payment_method": "string",
        "payment_status": "string",
        "status": "string",
        "gateway": "string",
        "merchant_id": "string",
        "transaction_fee": "double",
        "timestamp": "timestamp",
        "payment_date": "date",
        "_source": "string",
        "_ingested_at": "timestamp",
        "_processed_at": "timestamp",
        "dt": "date",
    },
    "customers": {
        "customer_id": "string",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "phone": "string",
        "segment": "string",
        "lifetime_value": "double",
        "registered_date": "date",
        "last_purchase_date": "date",
        "total_orders": "int",
        "total_spent": "double",
        "_source": "string",
        "_ingested_at": "timestamp",
        "_processed_at": "timestamp",
        "dt": "date",
    },
    "inventory": {
        "sku": "string",
        "product_name": "string",
        "category": "string",
        "warehouse": "string",
        "quantity_on_hand": "int",
        "reorder_point": "int",
        "unit_cost": "double",
        "last_restock_date": "date",
        "orders_count": "int",
        "units_sold": "int",
        "_source": "string",
        "_ingested_at": "timestamp",
        "_processed_at": "timestamp",
        "dt": "date",
    },
}

# --- KPI layer ---------------------------------------------------------------

KPIS = ["daily_revenue", "user_retention", "iot_anomaly_summary", "inventory_turnover"]

SENSOR_DAY: Columns = {
    "sensor_type": "string",
    "anomaly_date": "date",
    "total_readings": "bigint",
    "anomaly_count": "bigint",
    "avg_sensor_value": "double",
    "min_sensor_value": "double",
    "max_sensor_value": "double",
    "avg_z_score": "double",
    "max_abs_z_score": "double",
    "anomaly_rate_pct": "double",
}


@dataclass(frozen=True)
class Contract:
    """A serving table: column types, NOT NULL columns and primary key."""

    table: str
    columns: Columns
    required: tuple[str, ...]
    key: tuple[str, ...]


CONTRACTS: dict[str, Contract] = {
    "daily_revenue": Contract(
        table="kpi_daily_revenue",
        columns={
            "revenue_date": "date",
            "total_revenue": "decimal(12,2)",
            "total_transactions": "bigint",
            "avg_transaction_value": "decimal(10,2)",
            "unique_customers": "bigint",
            "total_fees": "decimal(10,2)",
            "total_events": "bigint",
            "unique_users": "bigint",
            "conversion_rate_pct": "decimal(5,2)",
            "aggregated_at": "timestamp",
            "dt": "date",
        },
        required=("revenue_date", "total_revenue", "total_transactions", "aggregated_at", "dt"),
        key=("revenue_date", "dt"),
    ),
    "user_retention": Contract(
        table="kpi_user_retention",
        columns={
            "cohort_date": "date",
            "days_since_cohort": "int",
            "cohort_size": "bigint",
            "active_users": "bigint",
            "retention_rate_pct": "decimal(5,2)",
            "total_events": "bigint",
            "aggregated_at": "timestamp",
            "dt": "date",
        },
        required=(
            "cohort_date", "days_since_cohort", "cohort_size", "active_users",
            "retention_rate_pct", "aggregated_at", "dt",
        ),
        key=("cohort_date", "days_since_cohort", "dt"),
    ),
    "inventory_turnover": Contract(
        table="kpi_inventory_turnover",
        columns={
            "category": "varchar(100)",
            "product_count": "bigint",
            "total_stock_units": "bigint",
            "total_units_sold": "bigint",
            "total_revenue": "decimal(12,2)",
            "avg_turnover_ratio": "decimal(8,4)",
            "total_stock_value": "decimal(12,2)",
            "products_need_reorder": "bigint",
            "products_out_of_stock": "bigint",
            "reorder_rate_pct": "decimal(5,2)",
            "stock_out_rate_pct": "decimal(5,2)",
            "aggregated_at": "timestamp",
            "dt": "date",
        },
        required=("category", "product_count", "aggregated_at", "dt"),
        key=("category", "dt"),
    ),
    "iot_anomaly_summary": Contract(
        table="kpi_iot_anomaly_summary",
        columns={
            "sensor_type": "varchar(50)",
            "anomaly_date": "date",
            "total_readings": "bigint",
            "anomaly_count": "bigint",
            "avg_sensor_value": "decimal(10,4)",
            "min_sensor_value": "decimal(10,4)",
            "max_sensor_value": "decimal(10,4)",
            "avg_z_score": "decimal(8,4)",
            "max_abs_z_score": "decimal(8,4)",
            "anomaly_rate_pct": "decimal(5,2)",
            "aggregated_at": "timestamp",
            "dt": "date",
        },
        required=("sensor_type", "anomaly_date", "total_readings", "anomaly_count",
                  "aggregated_at", "dt"),
        key=("sensor_type", "anomaly_date", "dt"),
    ),
}
