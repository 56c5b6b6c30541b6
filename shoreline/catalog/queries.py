"""Published queries: name -> callable(spark, folder of the test tables) -> DataFrame.

Times leave as text and measures rounded, so that both engines print the same values.
Audit times of the run are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.catalog.frames import AUDIT_TIME, BATCH_TIME, DATE, DAYS, TABLES, SampleSources
from shoreline.functions import measures
from shoreline.functions.temporal import event_bucket
from shoreline.operators import contracts, envelope, orders, rows, shape
from shoreline.plans import daily, gold, gold_wide, quality, silver, silver_wide
from shoreline.session import UNSORTED_WRITES, scratch_path, with_settings
from shoreline.sources import drops
from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake
from shoreline.streaming import dedup, ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
RUN_TIMES = ("_processed_at", "_aggregated_at", "aggregated_at")
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def publish(df: DataFrame, digits: int = 4) -> DataFrame:
    """Times as text, doubles rounded, run times dropped."""
    def shown(name: str, dtype: str) -> str:
        if dtype == "timestamp":
            return f"date_format(`{name}`, '{TIME_TEXT}') AS `{name}`"
        if dtype == "date":
            return f"date_format(`{name}`, 'yyyy-MM-dd') AS `{name}`"
        if dtype == "double":
            return f"round(`{name}`, {digits}) AS `{name}`"
        if dtype.startswith("decimal"):
            return f"CAST(`{name}` AS DOUBLE) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[shown(n, t) for n, t in df.dtypes if n not in RUN_TIMES])


def query(function: Callable[[SampleSources], DataFrame]) -> Callable[[SampleSources], DataFrame]:
    """Register a query over the sample sources under the function's name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(SampleSources(spark, folder))

    QUERIES[function.__name__] = run
    return function


# --- row operators -----------------------------------------------------------------


@query
def dedup_latest(src: SampleSources) -> DataFrame:
    latest = rows.keep_latest(src.deliveries, "event_id")
    return publish(latest.select("event_id", "user_id", "event_type", "value", "_kafka_offset"))


@query
def mandatory_filter(src: SampleSources) -> DataFrame:
    kept = rows.require_fields(src.user_events(), schemas.MANDATORY_FIELDS["user_events"])
    return publish(kept.select("event_id", "user_id", "timestamp", "_kafka_offset"))


@query
def successful_transactions(src: SampleSources) -> DataFrame:
    merged = silver.merge_transactions(src.transactions(), src.payments())
    return publish(rows.successful(merged).select("transaction_id", "transaction_source", "amount"))


@query
def purchase_transactions(src: SampleSources) -> DataFrame:
    return publish(rows.purchases(src.transactions()).select("txn_id", "amount", "_kafka_offset"))


@query
def sensor_source_filter(src: SampleSources) -> DataFrame:
    """Sensor rows of an event table: clickstream rows tagged as sensor readings."""
    tagged = silver.events_from_clickstream(src.clickstream()).withColumn(
        "event_source", F.when(F.col("status_code") >= 250, "iot_sensors").otherwise("clickstream")
    )
    readings = gold.readings_from_events(tagged).where(F.col("value").isNotNull())
    return publish(readings)


# --- shape --------------------------------------------------------------------------


@query
def union_missing_columns(src: SampleSources) -> DataFrame:
    stacked = shape.stack_by_name(src.user_events(), src.clickstream())
    return publish(stacked.select(
        "_source", "event_id", "request_id", "event_type", "method", "status_code", "_kafka_offset"
    ))


@query
def conform_to_schema(src: SampleSources) -> DataFrame:
    """Declared types over text input; what does not fit is NULL, absent columns are NULL."""
    raw = src.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("k") < 50, F.col("k").cast("string")).otherwise(F.col("event_type"))
        .alias("status_code"),
        F.col("value").cast("string").alias("latency_ms"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
    target = {"event_id": "bigint", "status_code": "int", "latency_ms": "double",
              "country": "string", "dt": "date"}
    return publish(shape.conform(raw, target))


@query
def event_time_bucket(src: SampleSources) -> DataFrame:
    late = src.user_events()
    buckets = event_bucket(F.col("timestamp"), F.col("_ingested_at"))
    return late.groupBy(F.col("_source").alias("source"), *[
        c.alias(n) for n, c in buckets.items()
    ]).agg(F.count("*").alias("row_count"))


@query
def line_totals(src: SampleSources) -> DataFrame:
    total = measures.line_total(
        "l_quantity", "l_extendedprice", F.round(F.col("l_discount") * 100).cast("int")
    )
    return publish(src.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.min(total).alias("smallest"), F.max(total).alias("largest"),
        F.count(total).alias("line_count"),
    ), digits=2)


# --- raw records ----------------------------------------------------------------------


LANDED = (
    "event_id string, user_id bigint, event_type string, value double, _source string, "
    "_kafka_topic string, _kafka_offset bigint, _ingested_at string, _raw string, "
    "_error_reason string"
)


@query
def bronze_envelope(src: SampleSources) -> DataFrame:
    """Every line as it lands: good ones with payload and envelope, bad ones with a reason."""
    fixed = F.lit(AUDIT_TIME).cast("timestamp")
    landed = envelope.stream_rows(src.topic_lines(), ingested_at=fixed)
    return publish(landed.select(
        "zone", "source", "dt", "hour", F.from_json("value", LANDED).alias("line")
    ).select(
        "zone", "source", "dt", "hour", "line.event_id", "line.user_id",
        F.col("line.value").alias("amount"), F.col("line._source").alias("envelope_source"),
        "line._kafka_topic", "line._kafka_offset", "line._ingested_at", "line._raw",
        "line._error_reason",
    ))


@query
def json_parse_split(src: SampleSources) -> DataFrame:
    parsed = envelope.parse_records(src.topic_lines())
    return parsed.select("offset", F.coalesce("reason", F.lit("ok")).alias("outcome"))


@query
def topic_routing(src: SampleSources) -> DataFrame:
    source = envelope.source_of(F.col("topic"))
    return src.topic_lines().groupBy("topic", source.alias("source")).agg(
        F.count("*").alias("row_count")
    )


@query
def batch_envelope(src: SampleSources) -> DataFrame:
    """Batch envelope over parquet files, with the file each row came from."""
    drop = src.table("customer").select(
        "c_custkey", "c_name", F.col("_metadata.file_name").alias("_file_path")
    )
    return envelope.with_batch_envelope(drop, "crm").select(
        "c_custkey", "c_name", "_source", "_file_path", "_job",
        F.get_json_object("_raw", "$.c_name").alias("raw_name"),
    )


# --- streams --------------------------------------------------------------------------


def _event_stream(src: SampleSources) -> SampleSources:
    """The same sources with the events read as a stream."""
    class Streamed(SampleSources):
        def table(self, name: str) -> DataFrame:
            # a pattern, because a stream cannot start from the path of a single file
            reader = self.spark.readStream.schema(TABLES[name])
            return reader.parquet(f"{self.folder}/{name}.parque[t]")

    return Streamed(src.spark, src.folder)


def _ingested_lake(src: SampleSources) -> Lake:
    """Run the raw ingest over all event records until nothing is left."""
    root = scratch_path(src.spark, "ingest")
    lake = Lake(f"{root}/lake")
    records = _event_stream(src).topic_lines(DAYS)
    running = ingest.start_raw_ingest(
        records, lake, f"{root}/checkpoint", name="ingest", available_now=True
    )
    running.awaitTermination()
    return lake


@query
def stream_ingest_available_now(src: SampleSources) -> DataFrame:
    lake = _ingested_lake(src)
    partitions = "zone string, source string, dt string, hour string, batch string"
    landed = src.spark.read.schema(f"{LANDED}, {partitions}").json(lake.raw)
    return publish(landed.where("zone = 'bronze'").select(
        "source", "dt", "hour", "event_id", "user_id", "event_type",
        F.col("value").alias("amount"), "_source", "_kafka_topic", "_kafka_offset", "_raw",
    ))


@query
def dead_letter(src: SampleSources) -> DataFrame:
    lake = _ingested_lake(src)
    sources = [*dict.fromkeys(schemas.TOPIC_SOURCES.values()), schemas.UNKNOWN_SOURCE]
    found = [(s, tables.read_dead_letter(src.spark, lake, s)) for s in sources]
    none = shape.empty(src.spark, {"source": "string", **tables.DEAD_LETTER})
    parts = [df.withColumn("source", F.lit(s)) for s, df in found if df is not None]
    return shape.stack_by_name(none, *parts).select(
        "source", "_kafka_topic", "_kafka_offset", "_error_reason", "_raw"
    )


@query
def stream_dedup_watermark(src: SampleSources) -> DataFrame:
    root = scratch_path(src.spark, "dedup")
    twice = _event_stream(src).deliveries.select("event_id", "user_id", "event_type", "ts")
    kept = dedup.first_delivery(twice, "event_id", time_column="ts")
    running = (
        kept.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/events")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return publish(src.spark.read.parquet(f"{root}/events"))


# --- batch drops ------------------------------------------------------------------------


@query
def batch_csv_ingest(src: SampleSources) -> DataFrame:
    root = scratch_path(src.spark, "csv")
    lake = Lake(f"{root}/lake")
    order_file = shape.align(src.customer_orders(), schemas.PAYLOADS["orders"])
    order_file.write.option("header", True).csv(f"{root}/drop/orders")
    drops.land_drop(src.spark, f"{root}/drop/orders", "orders", lake, DATE)
    landed = tables.read_raw(src.spark, lake, "orders", DATE)
    return publish(landed.select(
        "order_id", "customer_id", "total_amount", "status", "order_date", "_source"
    ))


def _write_json_arrays(df: DataFrame, path: str) -> None:
    """One JSON array per file, as an upstream system would drop them."""
    def arrays(batches):
        import pandas as pd

        first = True
        for batch in batches:
            lines = [("" if first and i == 0 else ",") + t for i, t in enumerate(batch["line"])]
            if first and lines:
                lines[0] = "[" + lines[0]
            first = first and not lines
            yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["[]" if first else "]"]})

    lines = df.select(F.to_json(F.struct("*")).alias("line"))
    lines.mapInPandas(arrays, "value string").write.text(path)


@query
def batch_json_array_ingest(src: SampleSources) -> DataFrame:
    root = scratch_path(src.spark, "json")
    lake = Lake(f"{root}/lake")
    payments = src.payments().withColumn("metadata", F.struct(
        F.lit("10.0.0.1").alias("ip"), F.col("payment_method").alias("device")
    ))
    _write_json_arrays(
        shape.align(payments, schemas.PAYLOADS["payments"]), f"{root}/drop/payments"
    )
    drops.land_drop(src.spark, f"{root}/drop/payments", "payments", lake, DATE)
    landed = tables.read_raw(src.spark, lake, "payments", DATE)
    return publish(landed.select(
        "payment_id", "customer_id", "amount", "payment_status", "payment_date",
        F.col("metadata.device").alias("device"), "_source",
    ))


# --- domain tables ------------------------------------------------------------------------


@query
def silver_events(src: SampleSources) -> DataFrame:
    return publish(silver.events(src.user_events(), src.clickstream(), DATE))


@query
def silver_transactions(src: SampleSources) -> DataFrame:
    return publish(silver.transactions(src.transactions(), src.payments(), DATE))


@query
def silver_customers(src: SampleSources) -> DataFrame:
    return publish(silver.customers(src.crm(), src.customer_orders(), DATE), digits=6)


@query
def silver_inventory(src: SampleSources) -> DataFrame:
    return publish(silver.inventory(src.inventory(), src.product_orders(), DATE))


@query
def wide_events(src: SampleSources) -> DataFrame:
    return publish(silver_wide.events(src.user_events(), src.clickstream(), DATE))


@query
def wide_transactions(src: SampleSources) -> DataFrame:
    return publish(silver_wide.transactions(src.transactions(), src.payments(), DATE))


@query
def wide_customers(src: SampleSources) -> DataFrame:
    return publish(silver_wide.customers(src.crm(), src.customer_orders(), DATE))


@query
def wide_customers_orders_only(src: SampleSources) -> DataFrame:
    return publish(silver_wide.customers(None, src.customer_orders(), DATE))


@query
def wide_inventory(src: SampleSources) -> DataFrame:
    return publish(silver_wide.inventory(src.inventory(), src.product_orders(), DATE))


@query
def orders_by_customer(src: SampleSources) -> DataFrame:
    return publish(orders.by_customer(src.customer_orders()), digits=6)


@query
def orders_by_product(src: SampleSources) -> DataFrame:
    return publish(orders.by_product(src.product_orders()))


@query
def left_join_zero_fill(src: SampleSources) -> DataFrame:
    merged = silver.merge_customers(src.crm(), src.customer_orders())
    return publish(merged.select(
        "customer_id", "_file_path", "total_orders", "total_order_value", "avg_order_value",
        "latest_order_date",
    ), digits=6)


@query
def stock_status(src: SampleSources) -> DataFrame:
    merged = silver.merge_inventory(src.inventory(), src.product_orders())
    strict = measures.stock_status("quantity_on_hand", "reorder_point", out_of_stock_first=True)
    return publish(merged.select(
        "sku", "_file_path", "quantity_on_hand", "reorder_point", "stock_status",
        strict.alias("strict_status"),
    ))


# --- KPI tables ---------------------------------------------------------------------------


def _events(src: SampleSources) -> DataFrame:
    return silver.events(src.user_events(), src.clickstream(), DATE)


def _transactions(src: SampleSources) -> DataFrame:
    return silver.transactions(src.transactions(), src.payments(), DATE)


def _inventory(src: SampleSources) -> DataFrame:
    return silver.inventory(src.inventory(), src.product_orders(), DATE)


def _wide_events(src: SampleSources) -> DataFrame:
    return silver_wide.events(src.user_events(), src.clickstream(), DATE)


def _wide_transactions(src: SampleSources) -> DataFrame:
    return silver_wide.transactions(src.transactions(), src.payments(), DATE)


def _wide_inventory(src: SampleSources) -> DataFrame:
    return silver_wide.inventory(src.inventory(), src.product_orders(), DATE)


@query
def daily_activity(src: SampleSources) -> DataFrame:
    return publish(gold.daily_activity(_events(src)))


@query
def daily_revenue(src: SampleSources) -> DataFrame:
    return publish(gold.daily_revenue(_transactions(src), _events(src)))


@query
def revenue_breakdown(src: SampleSources) -> DataFrame:
    return publish(
        gold_wide.revenue_breakdown(_wide_transactions(src), _wide_events(src)), digits=6
    )


@query
def retention_grid(src: SampleSources) -> DataFrame:
    return publish(gold.user_retention(_events(src)))


@query
def retention_grid_in_order(src: SampleSources) -> DataFrame:
    return publish(gold.in_report_order(gold.user_retention(_wide_events(src))))


@query
def retention_span(src: SampleSources) -> DataFrame:
    return publish(gold_wide.retention_span(_wide_events(src)))


@query
def retention_span_known_users(src: SampleSources) -> DataFrame:
    return publish(gold_wide.retention_span(_wide_events(src), drop_anonymous=True))


@query
def sensor_baseline(src: SampleSources) -> DataFrame:
    return publish(gold.sensor_baseline(gold.readings_from_raw(src.iot_sensors())))


@query
def sensor_bounds(src: SampleSources) -> DataFrame:
    bounded = gold_wide.bounded_readings(gold.readings_from_raw(src.iot_sensors()))
    return publish(bounded.select(
        "reading_id", "sensor_type", "value", "lower_bound", "upper_bound", "is_anomaly",
        "anomaly_type", "deviation_sigma",
    ))


@query
def sensor_z_scores(src: SampleSources) -> DataFrame:
    scored = gold.score_readings(gold.readings_from_raw(src.iot_sensors()))
    return publish(scored.select("reading_id", "sensor_type", "z_score", "is_anomaly"))


@query
def sensor_anomaly_by_location(src: SampleSources) -> DataFrame:
    return publish(gold_wide.sensor_anomaly_by_location(gold.readings_from_raw(src.iot_sensors())))


@query
def sensor_anomaly_by_day(src: SampleSources) -> DataFrame:
    return publish(gold.sensor_anomaly(gold.readings_from_raw(src.iot_sensors())))


@query
def product_turnover(src: SampleSources) -> DataFrame:
    measured = gold.product_turnover(_inventory(src))
    return publish(measured.select(
        "sku", "turnover_ratio", "stock_coverage_days", "needs_reorder", "stock_value"
    ), digits=9)


@query
def inventory_by_category(src: SampleSources) -> DataFrame:
    return publish(gold.inventory_turnover(_inventory(src)))


@query
def inventory_by_category_warehouse(src: SampleSources) -> DataFrame:
    return publish(gold_wide.stock_turnover(_wide_inventory(src), _wide_transactions(src)))


@query
def cogs_equal_share(src: SampleSources) -> DataFrame:
    shared = gold_wide.equal_cost_share(_wide_inventory(src), _wide_transactions(src))
    return publish(shared.select("category", "warehouse", "cogs_estimate"))


# --- serving and contracts ------------------------------------------------------------------


def _audited(kpi: DataFrame) -> DataFrame:
    return gold.with_audit(kpi, DATE)


@query
def serving_daily_revenue(src: SampleSources) -> DataFrame:
    kpi = _audited(gold.daily_revenue(_transactions(src), _events(src)))
    return publish(contracts.to_serving(kpi, schemas.CONTRACTS["daily_revenue"]))


@query
def serving_user_retention(src: SampleSources) -> DataFrame:
    kpi = _audited(gold.user_retention(_events(src)))
    return publish(contracts.to_serving(kpi, schemas.CONTRACTS["user_retention"]))


@query
def serving_inventory_turnover(src: SampleSources) -> DataFrame:
    kpi = _audited(gold.inventory_turnover(_inventory(src)))
    return publish(contracts.to_serving(kpi, schemas.CONTRACTS["inventory_turnover"]))


@query
def serving_sensor_anomaly(src: SampleSources) -> DataFrame:
    kpi = _audited(gold.sensor_anomaly(gold.readings_from_raw(src.iot_sensors())))
    return publish(contracts.to_serving(kpi, schemas.CONTRACTS["iot_anomaly_summary"]))


READINGS_CONTRACT = schemas.Contract(
    table="readings",
    columns={"reading_id": "string", "sensor_type": "varchar(5)", "value": "decimal(4,2)"},
    required=("reading_id", "sensor_type", "value"),
    key=("reading_id",),
)


@query
def contract_not_null(src: SampleSources) -> DataFrame:
    return contracts.column_violations(src.iot_sensors(), READINGS_CONTRACT).where("check_name = 'not_null'")


@query
def contract_primary_key(src: SampleSources) -> DataFrame:
    twice = schemas.Contract("deliveries", {}, (), ("user_id", "event_type"))
    return contracts.key_duplicates(src.deliveries, twice)


@query
def contract_numeric(src: SampleSources) -> DataFrame:
    return contracts.column_violations(src.iot_sensors(), READINGS_CONTRACT).where("check_name = 'numeric'")


@query
def contract_violations(src: SampleSources) -> DataFrame:
    return contracts.violations(src.iot_sensors(), READINGS_CONTRACT)


# --- layer checks -----------------------------------------------------------------------------


def _bronze_report(src: SampleSources) -> DataFrame:
    return quality.bronze_report(src.spark, {
        "user_events": src.user_events(),
        "clickstream": src.clickstream(),
        "transactions": src.transactions(),
        "payments": src.payments(),
        "iot_sensors": src.iot_sensors(),
        "crm": src.crm(),
        "inventory": src.inventory(),
        "orders": src.customer_orders(),
        "app_logs": None,
    })


def _silver_report(src: SampleSources) -> DataFrame:
    return quality.layer_report(src.spark, "silver", {
        "events": _events(src),
        "transactions": _transactions(src),
        "customers": silver.customers(src.crm(), src.customer_orders(), DATE),
        "inventory": _inventory(src),
    })


@query
def bronze_layer_report(src: SampleSources) -> DataFrame:
    return publish(_bronze_report(src))


@query
def silver_layer_report(src: SampleSources) -> DataFrame:
    return publish(_silver_report(src).drop("latest"))


@query
def layer_verdict(src: SampleSources) -> DataFrame:
    return quality.layer_status(_bronze_report(src).unionByName(_silver_report(src)))


@query
def lineage_ratio(src: SampleSources) -> DataFrame:
    report = _bronze_report(src).unionByName(_silver_report(src))
    return publish(quality.lake_verdict(report))


@query
def freshness(src: SampleSources) -> DataFrame:
    return publish(quality.freshness(src.deliveries, "_ingested_at"))


@query
def kpi_profile(src: SampleSources) -> DataFrame:
    """Profile of an activity table that is partitioned by its own day."""
    activity = gold.daily_activity(_events(src)).withColumnRenamed("event_date", "dt")
    return publish(quality.profile_kpi(src.spark, "daily_activity", activity))


@query
def dedup_accounting(src: SampleSources) -> DataFrame:
    merged = silver.merge_events(src.user_events(), src.clickstream())
    return quality.dedup_accounting(
        merged, "event_id", schemas.DOMAIN_REQUIRED["events"], ["_ingested_at", "_kafka_offset"]
    )


# --- lake jobs -----------------------------------------------------------------------------------


@query
def lake_roundtrip_dynamic_overwrite(src: SampleSources) -> DataFrame:
    """All days written, then the first day written again with new values."""
    path = f"{scratch_path(src.spark, 'overwrite')}/events"
    by_day = src.events.select(
        "event_id", "event_type", "value", F.to_date("ts").alias("dt")
    )
    tables.write_table(by_day, path)
    first_day = by_day.agg(F.min("dt")).scalar()
    again = by_day.where(F.col("dt") == first_day).withColumn("value", F.col("value") + 1)
    tables.write_table(again, path)
    return publish(tables.read_all(src.spark, path))


def _raw_lake(src: SampleSources, without: Sequence[str] = ()) -> Lake:
    """A lake whose raw layer holds all sample sources, or all but some, under one processing date."""
    lake = Lake(f"{scratch_path(src.spark, 'lake')}/lake")
    src = SampleSources(with_settings(src.spark, **UNSORTED_WRITES), src.folder)
    frames = {
        "user_events": src.user_events(),
        "clickstream": src.clickstream(),
        "transactions": src.transactions(),
        "payments": src.payments(),
        "iot_sensors": src.iot_sensors(),
        "crm": src.crm(),
        "inventory": src.inventory(),
        "orders": shape.stack_by_name(src.customer_orders(), src.product_orders()),
    }
    at = F.lit(BATCH_TIME).cast("timestamp")
    for source, df in frames.items():
        if source in without:
            continue
        lineage = {"_source": F.lit(source), "_ingested_at": at}
        known = df.withColumns({c: v for c, v in lineage.items() if c not in df.columns})
        line = F.to_json(
            F.struct("*"), {"timestampFormat": envelope.ISO_MICROS, "ignoreNullFields": "true"}
        )
        tables.write_raw(known.select(
            line.alias("value"), F.lit("bronze").alias("zone"), F.lit(source).alias("source"),
            F.lit(DATE).alias("dt"), F.lit("00").alias("hour"),
        ), lake, f"sample-{source}", packed=True)
    return lake


@query
def daily_job_ledger(src: SampleSources) -> DataFrame:
    return daily.run_day(src.spark, _raw_lake(src), DATE)


@query
def wide_daily_job_ledger(src: SampleSources) -> DataFrame:
    return daily.run_day(src.spark, _raw_lake(src), DATE, wide=True)


@query
def lake_validation(src: SampleSources) -> DataFrame:
    lake = _raw_lake(src)
    daily.run_day(src.spark, lake, DATE)
    report = quality.validate_lake(src.spark, lake, DATE)
    return report.select("layer", "table_name", "status", "row_count")


@query
def gold_verification(src: SampleSources) -> DataFrame:
    lake = _raw_lake(src)
    daily.run_day(src.spark, lake, DATE)
    return quality.verify_gold(src.spark, lake).drop("latest")
