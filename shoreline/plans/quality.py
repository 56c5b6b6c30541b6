"""Layer checks and ledgers, each one a small report frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.functions.measures import percent
from shoreline.operators.rows import all_present
from shoreline.sources.lake import Footers, Lake, read_all, read_footers, read_partition, read_raw

# A frame, what the footers say, nothing, or the reason why there is none.
Table = DataFrame | Footers | str | None

REPORT: schemas.Columns = {
    "layer": "string",
    "table_name": "string",
    "status": "string",
    "row_count": "bigint",
    "latest": "timestamp",
    "error": "string",
}

BRONZE_CHECKED = [
    "user_events", "transactions", "app_logs", "iot_sensors", "clickstream",
    "orders", "crm", "inventory", "payments",
]
AUDIT_TIMES = ("_processed_at", "_aggregated_at")


def freshness(df: DataFrame, column: str) -> DataFrame:
    """Row count and latest value of an audit time."""
    return df.agg(F.count("*").alias("row_count"), F.max(column).alias("latest"))


def attempt(read: Callable[[], DataFrame | None]) -> Table:
    """The table, ``None`` without data, or the reason why it cannot be read."""
    try:
        return read()
    except (PySparkException, Py4JJavaError) as error:
        return str(error).strip().splitlines()[0]


def _moment(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def _table_row(
    spark: SparkSession,
    layer: str,
    name: str,
    df: Table,
    required: Sequence[str],
    times: Sequence[str],
) -> DataFrame:
    """Status of one table: missing, ok, or error (unreadable, or a required column is absent)."""
    if df is None or isinstance(df, str):
        given = [(layer, name, "missing" if df is None else "error", 0, None, df)]
        return spark.createDataFrame(given, schemas.ddl(REPORT))
    if isinstance(df, Footers) and not required and any(c in df.columns for c in times):
        return df.counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.lit("ok").alias("status"), "row_count",
            _moment(df.latest).alias("latest"), F.lit(None).cast("string").alias("error"))
    absent = [c for c in required if c not in df.columns]
    time = next((c for c in times if c in df.columns), None)
    if time is None and "_ingested_at" not in times:
        absent.append(" or ".join(times))
    latest = F.max(F.col(time).try_cast("timestamp")) if time else F.lit(None).cast("timestamp")
    # with a given schema a field the files lack is a column without any value
    given_fields = [c for c in required if c in df.columns]
    counted = df.agg(
        F.count("*").alias("row_count"),
        latest.alias("latest"),
        *[F.count(c).alias(f"_set{i}") for i, c in enumerate(given_fields)],
    )
    unset = [
        F.when((F.col("row_count") > 0) & (F.col(f"_set{i}") == 0), F.lit(c))
        for i, c in enumerate(given_fields)
    ]
    missing = F.concat_ws(", ", *[F.lit(c) for c in absent], *unset)
    return counted.withColumn("missing", missing).select(
        F.lit(layer).alias("layer"),
        F.lit(name).alias("table_name"),
        F.when(F.col("missing") == "", "ok").otherwise("error").alias("status"),
        "row_count",
        F.when(F.col("missing") == "", F.col("latest")).alias("latest"),
        F.when(F.col("missing") != "", F.concat(F.lit("missing fields: "), "missing"))
        .alias("error"),
    )


def layer_report(
    spark: SparkSession,
    layer: str,
    tables: Mapping[str, Table],
    required: Sequence[str] = (),
    times: Sequence[str] = AUDIT_TIMES,
) -> DataFrame:
    """One row per table of a layer, from one aggregation per table."""
    rows = [_table_row(spark, layer, n, df, required, times) for n, df in tables.items()]
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report


def bronze_report(spark: SparkSession, tables: Mapping[str, Table]) -> DataFrame:
    return layer_report(
        spark, "bronze", tables, required=("_source", "_ingested_at"), times=("_ingested_at",)
    )


def layer_status(report: DataFrame) -> DataFrame:
    """Per layer: total rows and whether every table is ok or merely missing."""
    return report.groupBy("layer").agg(
        F.sum("row_count").alias("total_rows"),
        F.every(F.col("status").isin("ok", "missing")).alias("passed"),
    )


def lake_verdict(report: DataFrame) -> DataFrame:
    """One row: all layers passed, rows per layer, silver rows as a percentage of bronze."""
    def rows_of(layer: str):
        return F.coalesce(
            F.sum(F.when(F.col("layer") == layer, F.col("row_count"))), F.lit(0)
        ).alias(f"{layer}_rows")

    return report.agg(
        F.every(F.col("status").isin("ok", "missing")).alias("passed"),
        rows_of("bronze"),
        rows_of("silver"),
        rows_of("gold"),
    ).withColumn("silver_to_bronze_pct", percent("silver_rows", "bronze_rows"))


def validate_lake(spark: SparkSession, lake: Lake, date: str) -> DataFrame:
    """Report over all layers of a lake for one date."""
    def partition(path: str) -> Table:
        # an hourly check of a large table should not read it
        return attempt(lambda: read_footers(spark, path, date) or read_partition(spark, path, date))

    bronze = {s: attempt(partial(read_raw, spark, lake, s, date)) for s in BRONZE_CHECKED}
    silver = {d: partition(lake.domain(d)) for d in schemas.DOMAINS}
    gold = {k: partition(lake.kpi(k)) for k in schemas.KPIS}
    return (
        bronze_report(spark, bronze)
        .unionByName(layer_report(spark, "silver", silver))
        .unionByName(layer_report(spark, "gold", gold))
    )


# --- KPI profile -------------------------------------------------------------------

PROFILE: schemas.Columns = {
    "kpi": "string",
    "status": "string",
    "row_count": "bigint",
    "column_count": "int",
    "latest": "timestamp",
    "date_partitions": "bigint",
    "error": "string",
}


def profile_kpi(spark: SparkSession, kpi: str, df: Table) -> DataFrame:
    """Rows, columns, freshness and number of dates of one KPI table."""
    if df is None or isinstance(df, str):
        given = [(kpi, "missing" if df is None else "error", 0, None, None, None, df)]
        return spark.createDataFrame(given, schemas.ddl(PROFILE))
    if isinstance(df, Footers):
        counted = df.counts.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), _moment(df.latest).alias("latest"),
            F.count_if(F.col("row_count") > 0).alias("date_partitions"))
        return counted.select(
            F.lit(kpi).alias("kpi"), F.lit("ok").alias("status"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            "latest", "date_partitions", F.lit(None).cast("string").alias("error"))
    time = next((c for c in AUDIT_TIMES if c in df.columns), None)
    latest = F.max(time) if time else F.lit(None).cast("timestamp")
    dates = F.count_distinct("dt") if "dt" in df.columns else F.lit(None).cast("bigint")
    return df.agg(
        F.count("*").alias("row_count"),
        latest.alias("latest"),
        dates.alias("date_partitions"),
    ).select(
        F.lit(kpi).alias("kpi"),
        F.lit("ok").alias("status"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        "latest",
        "date_partitions",
        F.lit(None).cast("string").alias("error"),
    )


def verify_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    """Profile of every KPI table, all dates."""
    def table(path: str) -> Table:
        return attempt(lambda: read_footers(spark, path) or read_all(spark, path))

    found = {k: table(lake.kpi(k)) for k in schemas.KPIS}
    rows = [profile_kpi(spark, k, df) for k, df in found.items()]
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report


def collected(report: DataFrame) -> DataFrame:
    """The same report, computed once: it has one row per table."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def preview(df: DataFrame, rows: int = 5) -> None:
    """Print the schema and a few rows."""
    df.printSchema()
    df.show(rows, truncate=False)


def all_ok(report: DataFrame) -> DataFrame:
    """One row: no table is missing or broken."""
    return report.agg(F.every(F.col("status") == "ok").alias("passed"))


# --- accounting ----------------------------------------------------------------------


def dedup_accounting(
    df: DataFrame, key: str, required: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row: rows before and after keep-latest, and rows then lost to mandatory fields.

    Only the key, the order and one flag are shuffled, reduced per task beforehand.
    """
    newest = F.struct(*[F.col(c) for c in order_by])
    per_key = df.withColumn("_complete", all_present(required)).groupBy(key).agg(
        F.count("*").alias("copies"), F.max_by("_complete", newest).alias("complete")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after_dedup"),
        F.count_if(F.col("complete")).alias("rows_kept"),
    ).select(
        "rows_before",
        "rows_after_dedup",
        (F.col("rows_before") - F.col("rows_after_dedup")).alias("duplicates_removed"),
        (F.col("rows_after_dedup") - F.col("rows_kept")).alias("incomplete_dropped"),
        "rows_kept",
    )


class RowCounter:
    """Counts rows that pass a point of a plan, as a side effect of the action itself.

    Exact behind the last shuffle. Before it, tasks that run again after a lost executor
    count again; ``dedup_accounting`` is the exact report.
    """

    def __init__(self) -> None:
        self._observations: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        observation = Observation(name)
        self._observations[name] = observation
        time = next((F.unix_micros(c) for c in AUDIT_TIMES if dict(df.dtypes).get(c) == "timestamp"), F.lit(None).cast("bigint"))
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.max(time).alias("latest"))

    def latest(self, name: str) -> int | None:
        """The latest audit time, in microseconds; only valid after the action."""
        return self._observations[name].get["latest"]

    def counts(self) -> dict[str, int]:
        """Counts so far; only valid after the action that runs the plan."""
        return {name: o.get["rows"] for name, o in self._observations.items()}


def ledger(spark: SparkSession, counts: Mapping[tuple[str, str], int]) -> DataFrame:
    """Row counts per layer and table as a frame."""
    rows = [(layer, table, rows) for (layer, table), rows in counts.items()]
    return spark.createDataFrame(rows, "layer string, table_name string, row_count bigint")
