"""Source-shaped frames derived from the test tables, always from whole tables.

Every event is delivered twice. The second delivery carries ``value + 1`` and an ingest
time that, depending on the event, is earlier than, equal to or later than the first.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2026-04-17"
BATCH_TIME = "2026-04-17 00:00:00"
AUDIT_TIME = "2026-04-18 01:00:00"
# Added to measures so that no average lies half-way between two printed values, where
# the engines would round differently.
OFF_TIE = 0.00123457
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DAYS = "yyyy-MM-dd"

# Columns of the test tables that are read.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}

CURRENCY = "CASE WHEN k < 50 THEN 'USD' WHEN k < 80 THEN 'EUR' ELSE 'VND' END AS currency"
METHOD = (
    "CASE WHEN k < 5 THEN NULL WHEN k < 40 THEN 'card' WHEN k < 70 THEN 'wallet' "
    "ELSE 'transfer' END AS payment_method"
)


class SampleSources:
    """Test tables of one scale factor, shaped like the sources of the lake."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Events with ``k`` taken out of their JSON properties."""
        return self.table("events").selectExpr(
            "event_id",
            "CAST(ts AS TIMESTAMP) AS ts",
            "user_id",
            "event_type",
            f"value + {OFF_TIE}D AS value",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        """Both deliveries of every event, from one scan."""
        return self.events.selectExpr("*", "explode(array(0, 1)) AS again").selectExpr(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            "k",
            "CASE again WHEN 0 THEN value ELSE value + 1 END AS value",
            "ts + make_interval(0, 0, 0, 0, 0, CASE again WHEN 0 THEN 1 ELSE k - 50 END)"
            " AS _ingested_at",
            "event_id * 2 + again AS _kafka_offset",
        )

    # --- stream sources ---------------------------------------------------------

    def user_events(self) -> DataFrame:
        return self.deliveries.where("event_type <> 'error'").selectExpr(
            "CAST(event_id AS STRING) AS event_id",
            "CASE WHEN k <> 0 THEN CAST(user_id AS STRING) END AS user_id",
            "'s' || user_id AS session_id",
            "event_type",
            "'/' || event_type AS page_url",
            "CASE WHEN k >= 30 THEN '/home' END AS referrer",
            "CASE WHEN k < 50 THEN 'mobile' ELSE 'desktop' END AS device",
            "'firefox' AS browser",
            "'VN' AS country",
            "CASE WHEN k <> 1 THEN ts END AS timestamp",
            "'user_events' AS _source",
            "_kafka_offset",
            "_ingested_at",
        )

    def clickstream(self) -> DataFrame:
        return self.deliveries.where("event_type = 'error'").selectExpr(
            "CASE WHEN k <> 2 THEN 'r' || event_id END AS request_id",
            "'GET' AS method",
            "CASE WHEN k <> 3 THEN '/' || event_type END AS path",
            "k + 200 AS status_code",
            "CAST(floor(value * 10) AS INT) AS latency_ms",
            "CAST(floor(value * 100) AS BIGINT) AS bytes_sent",
            "'agent' AS user_agent",
            "'10.0.0.' || k AS ip_address",
            "ts AS timestamp",
            "'clickstream' AS _source",
            "_kafka_offset",
            "_ingested_at",
        )

    def transactions(self) -> DataFrame:
        return self.deliveries.where("event_type <> 'signup'").selectExpr(
            "'t' || event_id AS txn_id",
            "CAST(user_id AS STRING) AS user_id",
            "CASE WHEN k < 14 THEN 'refund' ELSE 'purchase' END AS txn_type",
            "CASE WHEN k = 99 THEN NULL WHEN k < 14 THEN -value ELSE value END AS amount",
            CURRENCY,
            METHOD,
            "CASE WHEN k < 60 THEN 'completed' WHEN k < 80 THEN 'pending' ELSE 'failed' END"
            " AS status",
            "'m' || k AS merchant_id",
            "ts AS timestamp",
            "'transactions' AS _source",
            "_kafka_offset",
            "_ingested_at",
        )

    def payments(self) -> DataFrame:
        return self.deliveries.where("event_type = 'signup'").selectExpr(
            "'p' || event_id AS payment_id",
            "'o' || event_id AS order_id",
            "'c' || user_id AS customer_id",
            "value AS amount",
            CURRENCY,
            METHOD,
            "CASE WHEN k < 70 THEN 'success' WHEN k < 80 THEN 'pending' WHEN k < 90 THEN 'failed'"
            " ELSE 'refunded' END AS payment_status",
            "'gate' AS gateway",
            "value * 0.02D AS transaction_fee",
            "CASE WHEN k = 98 THEN 'not a date' ELSE date_format(ts, 'yyyy-MM-dd') END"
            " AS payment_date",
            "'payments' AS _source",
            "'drop-' || _kafka_offset AS _file_path",
            "_ingested_at",
        )

    def iot_sensors(self) -> DataFrame:
        """Readings: the event type is the sensor type; some have no value."""
        return self.events.selectExpr(
            "CAST(event_id AS STRING) AS reading_id",
            "'sensor-' || user_id AS sensor_id",
            "event_type AS sensor_type",
            "CASE WHEN k <> 4 THEN value END AS value",
            "'unit' AS unit",
            "'loc_' || CAST(floor(k / 25) AS STRING) AS location",
            "ts AS timestamp",
            "'iot_sensors' AS _source",
            "ts + INTERVAL 1 MINUTE AS _ingested_at",
        )

    # --- batch sources ------------------------------------------------------------

    def _two_drops(self, df: DataFrame, updated: str, minutes: str) -> DataFrame:
        """Each row in two drops; the second has ``updated + 1`` and a shifted ingest time."""
        kept = [c for c in df.columns if c not in (updated, "shift")]
        return df.selectExpr("*", "explode(array(0, 1)) AS again").selectExpr(
            *kept,
            f"CASE again WHEN 0 THEN {updated} ELSE {updated} + 1 END AS {updated}",
            "CASE again WHEN 0 THEN 'drop-1' ELSE 'drop-2' END AS _file_path",
            f"TIMESTAMP '{BATCH_TIME}' + make_interval(0, 0, 0, 0, 0,"
            f" CASE again WHEN 0 THEN 0 ELSE {minutes} END) AS _ingested_at",
        )

    def crm(self) -> DataFrame:
        """All customers, and all suppliers as customers that never order."""
        customers = self.table("customer").selectExpr(
            "'c' || c_custkey AS customer_id",
            "c_name AS first_name",
            "CASE WHEN c_acctbal >= 0 THEN c_name || '@example.com' END AS email",
            "c_mktsegment AS segment",
            "c_acctbal AS lifetime_value",
            "c_nationkey AS shift",
        )
        suppliers = self.table("supplier").selectExpr(
            "'s' || s_suppkey AS customer_id",
            "s_name AS first_name",
            "s_name || '@example.com' AS email",
            "'SUPPLIER' AS segment",
            "s_acctbal AS lifetime_value",
            "s_nationkey AS shift",
        )
        rows = customers.unionByName(suppliers).selectExpr(
            "*",
            "'L' AS last_name",
            "CAST(NULL AS STRING) AS phone",
            "'2020-01-01' AS registered_date",
            "'2026-01-01' AS last_purchase_date",
            "'crm' AS _source",
        )
        return self._two_drops(rows, "lifetime_value", "shift - 12")

    def customer_orders(self) -> DataFrame:
        """All orders."""
        return self.table("orders").selectExpr(
            "'o' || o_orderkey AS order_id",
            "'c' || o_custkey AS customer_id",
            "o_totalprice AS total_amount",
            "o_orderstatus AS status",
            "date_format(o_orderdate, 'yyyy-MM-dd') AS order_date",
        )

    def inventory(self) -> DataFrame:
        """All parts, and one never sold service item without stock per supplier."""
        parts = self.table("part").selectExpr(
            "'p' || p_partkey AS sku",
            "p_name AS product_name",
            "p_type AS category",
            "'WH-' || p_brand AS warehouse",
            "CAST(round((p_retailprice - 900) * 10) AS INT) AS quantity_on_hand",
            "p_size + 10 AS reorder_point",
            f"p_retailprice + {OFF_TIE}D AS unit_cost",
            "p_size AS shift",
        )
        services = self.table("supplier").selectExpr(
            "'s' || s_suppkey AS sku",
            "s_name AS product_name",
            "'SERVICE' AS category",
            "'WH-none' AS warehouse",
            "0 AS quantity_on_hand",
            "CAST(NULL AS INT) AS reorder_point",
            "s_acctbal AS unit_cost",
            "s_nationkey AS shift",
        )
        rows = parts.unionByName(services).selectExpr(
            "*",
            "'2026-04-01' AS last_restock_date",
            f"'{DATE}' AS snapshot_date",
            "'inventory' AS _source",
        )
        return self._two_drops(rows, "unit_cost", "shift - 20")

    def product_orders(self) -> DataFrame:
        """All order lines."""
        return self.table("lineitem").selectExpr(
            "'o' || l_orderkey || '-' || l_linenumber AS order_id",
            "'p' || l_partkey AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "l_extendedprice * (1 - l_discount) AS total_amount",
            "date_format(l_shipdate, 'yyyy-MM-dd') AS order_date",
        )

    # --- raw lines ------------------------------------------------------------------

    def topic_lines(self, time_format: str = MICROS) -> DataFrame:
        """Every event as a topic record. Error events are cut short, views come as arrays,
        and purchases carry a key of the envelope."""
        rows = self.events
        body = F.to_json(F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").alias("user_id"),
            "event_type",
            F.round("value", 2).alias("value"),
            F.date_format("ts", time_format).alias("timestamp"),
            F.when(F.col("event_type") == "purchase", "payload").alias("_source"),
        ))
        line = (
            F.when(F.col("event_type") == "error", F.substring(body, F.lit(1), F.length(body) - 1))
            .when(F.col("event_type") == "view", F.concat(F.lit("["), body, F.lit("]")))
            .otherwise(body)
        )
        topic = (
            F.when(F.col("event_type") == "purchase", "events.txn")
            .when(F.col("event_type") == "signup", "no.route")
            .otherwise("events.user")
        )
        return rows.select(
            line.alias("value"),
            topic.alias("topic"),
            F.lit(0).alias("partition"),
            F.col("event_id").alias("offset"),
        )
