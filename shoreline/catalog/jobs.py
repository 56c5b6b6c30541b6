"""Published queries that read back what the lake jobs wrote.

Each one runs jobs on a lake of its own and returns the rows that are in the lake afterwards.
Most have the twin of the query that computes the same table without a lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.catalog.frames import BATCH_TIME, DATE, DAYS, SampleSources
from shoreline.catalog.oracles import BASE, DAY, DOM, ORACLES
from shoreline.catalog.queries import (
    LANDED,
    QUERIES,
    _event_stream,
    _raw_lake,
    publish,
    query,
)
from shoreline.operators import shape
from shoreline.plans import daily
from shoreline.session import scratch_path
from shoreline.sources import drops, serving
from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake
from shoreline.streaming import ingest


def same_as(name: str, twin: str) -> None:
    ORACLES[name] = ORACLES[twin]


# --- raw layer: a write replaces its own batch only ---------------------------------------


@query
def raw_two_ingests(src: SampleSources) -> DataFrame:
    """The event records, split over two ingests with a checkpoint each, into one lake."""
    root = scratch_path(src.spark, "two-ingests")
    lake = Lake(f"{root}/lake")
    records = _event_stream(src).topic_lines(DAYS)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        ingest.start_raw_ingest(
            records.where(half == part), lake, f"{root}/checkpoint-{part}", available_now=True
        ).awaitTermination()
    partitions = "zone string, source string, dt string, hour string, batch string"
    landed = src.spark.read.schema(f"{LANDED}, {partitions}").json(lake.raw)
    return publish(landed.where("zone = 'bronze'").select(
        "source", "dt", "hour", "event_id", "user_id", "event_type",
        F.col("value").alias("amount"), "_source", "_kafka_topic", "_kafka_offset", "_raw",
    ))


same_as("raw_two_ingests", "stream_ingest_available_now")


def _order_file(src: SampleSources) -> DataFrame:
    return shape.align(src.customer_orders(), schemas.PAYLOADS["orders"])


def _landed_orders(src: SampleSources, lake: Lake) -> DataFrame:
    landed = tables.read_raw(src.spark, lake, "orders", DATE)
    return publish(landed.select(
        "order_id", "customer_id", "total_amount", "status", "order_date", "_source"
    ))


@query
def two_drops_one_day(src: SampleSources) -> DataFrame:
    """A morning and an evening drop of one source, filed under the same date."""
    root = scratch_path(src.spark, "two-drops")
    lake = Lake(f"{root}/lake")
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    for part, name in enumerate(("morning", "evening")):
        path = f"{root}/drop/{name}"
        _order_file(src).where(half == part).write.option("header", True).csv(path)
        drops.land_drop(src.spark, path, "orders", lake, DATE)
    return _landed_orders(src, lake)


same_as("two_drops_one_day", "batch_csv_ingest")


@query
def repaired_drop(src: SampleSources) -> DataFrame:
    """A drop whose quantities are no numbers, then the repaired one under the same id: no
    dead letter of the first is left."""
    root = scratch_path(src.spark, "repaired")
    lake = Lake(f"{root}/lake")
    orders = _order_file(src)
    broken = orders.withColumn("quantity", F.concat(F.lit("x"), F.monotonically_increasing_id()))
    for name, rows in (("broken", broken), ("repaired", orders)):
        rows.write.option("header", True).csv(f"{root}/drop/{name}")
        drops.land_drop(src.spark, f"{root}/drop/{name}", "orders", lake, DATE, drop_id="orders-1")
    bad = tables.read_dead_letter(src.spark, lake, "orders")
    left = bad.select(F.col("_raw").alias("order_id"))
    return shape.stack_by_name(_landed_orders(src, lake), left)


same_as("repaired_drop", "batch_csv_ingest")


@query
def raw_inferred(src: SampleSources) -> DataFrame:
    """Raw rows whose schema is taken from the files."""
    found = tables.read_raw_inferred(src.spark, _raw_lake(src), "inventory", DATE)
    return found.select("sku", "category", "warehouse", "quantity_on_hand", "reorder_point")


ORACLES["raw_inferred"] = f"""{BASE}
SELECT sku, category, warehouse, quantity_on_hand, reorder_point FROM stock"""


@query
def day_with_missing_source(src: SampleSources) -> DataFrame:
    """A day on which payments sent nothing: the transactions of the other source remain."""
    lake = _raw_lake(src, without=["payments"])
    daily.build_silver(src.spark, lake, DATE, only=["transactions"])
    written = tables.read_all(src.spark, lake.domain("transactions"))
    return written.groupBy("transaction_source").agg(F.count("*").alias("rows"))


ORACLES["day_with_missing_source"] = f"""{DOM}
SELECT transaction_source, count(*) AS rows FROM tx_silver WHERE transaction_source = 'transactions' GROUP BY 1"""


# --- table layers ------------------------------------------------------------------------


@query
def empty_rerun(src: SampleSources) -> DataFrame:
    """All days written, then the first day again without any row."""
    path = f"{scratch_path(src.spark, 'empty')}/events"
    by_day = src.events.select("event_id", "event_type", F.to_date("ts").alias("dt"))
    tables.write_table(by_day, path)
    first = str(by_day.agg(F.min("dt")).first()[0])
    tables.write_date(by_day.where("false"), path, first)
    return publish(tables.read_all(src.spark, path))


ORACLES["empty_rerun"] = f"""{BASE}
SELECT event_id, event_type, strftime(CAST(ts AS DATE), {DAY}) AS dt FROM ev
WHERE CAST(ts AS DATE) > (SELECT CAST(min(ts) AS DATE) FROM ev)"""


def _written(src: SampleSources, columns: list[str], domain: str | None = None, kpi: str | None = None,
             digits: int = 4) -> DataFrame:
    """One table after the jobs it needs ran on a raw lake."""
    lake = _raw_lake(src)
    if domain:
        daily.build_silver(src.spark, lake, DATE, only=[domain])
        path = lake.domain(domain)
    else:
        needed = {"daily_revenue": ["transactions", "events"], "user_retention": ["events"],
                  "inventory_turnover": ["inventory"]}.get(kpi, [])
        if needed:
            daily.build_silver(src.spark, lake, DATE, only=needed)
        daily.build_gold(src.spark, lake, DATE, only=[kpi])
        path = lake.kpi(kpi)
    return publish(tables.read_all(src.spark, path).select(*columns), digits)


def _columns(src: SampleSources, name: str) -> list[str]:
    return QUERIES[name](src.spark, src.folder).columns


def _job(name: str, twin: str, digits: int = 4, **table: str) -> None:
    def run(src: SampleSources) -> DataFrame:
        return _written(src, _columns(src, twin), digits=digits, **table)

    run.__name__ = name
    query(run)
    same_as(name, twin)


_job("job_transactions", "silver_transactions", domain="transactions")
_job("job_events", "silver_events", domain="events")
_job("job_customers", "silver_customers", digits=6, domain="customers")
_job("job_inventory", "silver_inventory", domain="inventory")
_job("job_daily_revenue", "daily_revenue", kpi="daily_revenue")
_job("job_user_retention", "retention_grid", kpi="user_retention")
_job("job_inventory_turnover", "inventory_by_category", kpi="inventory_turnover")
_job("job_sensor_anomaly", "sensor_anomaly_by_day", kpi="iot_anomaly_summary")


@query
def serving_rows(src: SampleSources) -> DataFrame:
    """What a load sends of the revenue that the job wrote, when every other day is loaded already."""
    lake = _raw_lake(src)
    daily.build_silver(src.spark, lake, DATE, only=["transactions", "events"])
    daily.build_gold(src.spark, lake, DATE, only=["daily_revenue"])
    contract = schemas.CONTRACTS["daily_revenue"]
    written = tables.read_partition(src.spark, lake.kpi("daily_revenue"), DATE)
    even = F.day("revenue_date") % 2 == 0
    loaded = serving.to_serving(written, contract).where(even).select(*contract.key)
    return publish(serving.rows_to_load(written, contract, loaded))


ORACLES["serving_rows"] = f"""
SELECT * FROM ({ORACLES["serving_daily_revenue"]}) WHERE CAST(right(revenue_date, 2) AS INTEGER) % 2 = 1"""


@query
def forms_side_by_side(src: SampleSources) -> DataFrame:
    """A canonical and a wide day on one lake; the canonical revenue is what it was."""
    lake = _raw_lake(src)
    needed = ["transactions", "events"]
    daily.build_silver(src.spark, lake, DATE, only=needed)
    daily.build_silver(src.spark, lake, DATE, wide=True, only=needed)
    daily.build_gold(src.spark, lake, DATE, wide=True, only=["daily_revenue"])
    daily.build_gold(src.spark, lake, DATE, only=["daily_revenue"])
    revenue = tables.read_all(src.spark, lake.kpi("daily_revenue"))
    return publish(revenue.select(*_columns(src, "daily_revenue")))


same_as("forms_side_by_side", "daily_revenue")


# --- rounding and times -------------------------------------------------------------------


@query
def round_half_up(src: SampleSources) -> DataFrame:
    """Exact half-way decimals, both signs: halves go away from zero."""
    half = (F.col("event_id") - 5000).cast("decimal(20,3)") + F.lit("0.005").cast("decimal(20,3)")
    return src.events.select(
        "event_id",
        F.round(half, 2).cast("string").alias("cents"),
        F.round(half * 100, 0).cast("bigint").alias("units"),
    )


ORACLES["round_half_up"] = f"""{BASE},
half AS (SELECT event_id, CAST(event_id - 5000 AS DECIMAL(20, 3)) + CAST(0.005 AS DECIMAL(20, 3)) AS h FROM ev)
SELECT event_id,
       CAST(CAST(sign(h) * floor(abs(h) * 100 + 0.5) / 100 AS DECIMAL(20, 2)) AS VARCHAR) AS cents,
       CAST(sign(h) * floor(abs(h) * 100 + 0.5) AS BIGINT) AS units FROM half"""


@query
def text_times(src: SampleSources) -> DataFrame:
    """Times that arrive as text, in three spellings and broken ones."""
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.concat(at, F.lit("Z")))
        .when(kind == 1, F.concat(at, F.lit("+00:00")))
        .when(kind == 2, at)
        .otherwise(F.lit("no time"))
    )
    typed = shape.cast_times(src.events.select(
        "event_id", text.alias("timestamp"), F.lit(BATCH_TIME).alias("_ingested_at")))
    return typed.select(
        "event_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss").alias("_ingested_at"))


ORACLES["text_times"] = f"""{BASE}
SELECT event_id, CASE WHEN event_id % 4 < 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp,
       '{BATCH_TIME}' AS _ingested_at FROM ev"""
