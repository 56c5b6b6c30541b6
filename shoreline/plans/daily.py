"""Jobs over a lake: one date from raw rows to serving tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from shoreline import schemas
from shoreline.operators.shape import empty
from shoreline.plans import gold, gold_wide, quality, silver, silver_wide
from shoreline.plans.activity import Activity
from shoreline.sources import commits
from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake
from shoreline.sources.serving import existing_keys, load_jdbc
from shoreline.streaming.rolling import vacuum_raw

Counts = dict[tuple[str, str], int]


def previous_day() -> str:
    """Default processing date: yesterday in UTC."""
    return (datetime.now(timezone.utc) - timedelta(days=1)).strftime("%Y-%m-%d")


class MissingInput(ValueError):
    """No data where a table needs them."""


def _write_counted(
    spark: SparkSession, counts: Counts, layer: str, name: str, df: DataFrame | None, path: str,
    date: str, sort_by: list[str] | None = None, notes: dict | None = None,
) -> None:
    """Replace a date of a table and count its rows, both in the one write action. Without a frame
    the date is left without rows."""
    if df is None:
        tables.clear_date(spark, path, date)
        counts[layer, name] = 0
        return
    counter = quality.RowCounter()
    tables.write_date(
        counter.watch(df, name), path, date, sort_by, lambda: {**(notes or {}), "latest": counter.latest(name)})
    counts[layer, name] = counter.counts()[name]


def _chosen(frames: Mapping[str, Callable], only: Sequence[str] | None) -> dict[str, Callable]:
    """All plans, or those of the named tables."""
    unknown = set(only or ()) - set(frames)
    if unknown:
        raise ValueError(f"unknown: {', '.join(sorted(unknown))}")
    return {name: plan for name, plan in frames.items() if only is None or name in only}


# --- which dates are stale ---------------------------------------------------------------------

#: What each domain table is made of.
DOMAIN_SOURCES = {
    "events": ("user_events", "clickstream"),
    "transactions": ("transactions", "payments"),
    "customers": ("crm", "orders"),
    "inventory": ("inventory", "orders"),
}
#: What each KPI table is made of; readings come from the raw layer.
KPI_DOMAINS = {
    "daily_revenue": ("transactions", "events"),
    "user_retention": ("events",),
    "iot_anomaly_summary": (),
    "inventory_turnover": ("inventory",),
}


def _ledger_entry(spark: SparkSession, lake: Lake, domain: str, date: str) -> dict:
    """The batches that a domain's date is made of, by source: how many, and a digest of their names."""
    out = {}
    for source in DOMAIN_SOURCES[domain]:
        found = tables.raw_inputs(spark, lake, source, date)
        out[source] = {"batches": len(found), "digest": hashlib.sha256("\n".join(found).encode()).hexdigest()}
    return out


def change_ledger(
    spark: SparkSession, lake: Lake, domains: Sequence[str] | None = None, dates: Sequence[str] | None = None,
    wide: bool = False,
) -> DataFrame:
    """domain, dt, status, batches_built, batches_now for each date that has raw data.

    ``late`` means that batches came, or were landed anew, after the table was written, ``current`` that none
    did, ``unbuilt`` that the table was not written from a known set of batches. Names of folders and the tables' last
    commits are read, no data. Rolled files count as the batches they are made of.
    """
    rows = []
    to = lake.wide if wide else lake
    for domain in domains or DOMAIN_SOURCES:
        written = commits.current(spark, to.domain(domain)) or {}
        known = {d for source in DOMAIN_SOURCES[domain] for d in tables.raw_dates(spark, lake, source)}
        for date in sorted(known if dates is None else known & set(dates)):
            now = _ledger_entry(spark, lake, domain, date)
            built = written.get(f"dt={date}", {}).get("inputs")
            status = "unbuilt" if built is None else "current" if built == now else "late"
            counted = [None if x is None else sum(s["batches"] for s in x.values()) for x in (built, now)]
            rows.append((domain, date, status, *counted))
    return spark.createDataFrame(rows, "domain string, dt string, status string, batches_built int, batches_now int")


def rebuild_late(
    spark: SparkSession, lake: Lake, dates: Sequence[str] | None = None, wide: bool = False, **options
) -> dict[str, Counts]:
    """Build the domain tables of late dates anew, and the KPI tables that were built from them; returns the rows by date.

    Dates that are current or were never built are left alone. Options go to `build_gold`.
    """
    found = change_ledger(spark, lake, dates=dates, wide=wide).where("status = 'late'").orderBy("dt", "domain").collect()
    late: dict[str, list[str]] = {}
    for row in found:
        late.setdefault(row.dt, []).append(row.domain)
    to = lake.wide if wide else lake
    out = {}
    for date, domains in late.items():
        counts = build_silver(spark, lake, date, wide, only=domains)
        kpis = [
            kpi for kpi, needs in KPI_DOMAINS.items()
            if set(needs) & set(domains) and tables.notes_of(spark, to.kpi(kpi), date) is not None]
        if kpis:
            counts.update(build_gold(spark, lake, date, wide, only=kpis, **options))
        out[date] = counts
    return out


def read_by(spark: SparkSession, lake: Lake, date: str, wide: bool = False, retention_days: int = 1) -> list[str]:
    """The folders that the jobs of a date read: raw data that count, and domain tables, events of all dates that retention
    looks at."""
    to = lake.wide if wide else lake
    paths = []
    for source in quality.BRONZE_CHECKED:
        found = tables.raw_folders(spark, lake, "bronze", source, date)
        paths += [f"{lake.bronze(source)}/dt={date}"] if found is None else [f"{lake.raw}/{f}" for f in found]
    for domain in schemas.DOMAINS:
        paths += tables.range_folders(spark, to.domain(domain), date, retention_days if domain == "events" else 1)
    return paths


def vacuum(spark: SparkSession, lake: Lake, keep_seconds: float) -> int:
    """Delete what no commit names any more, once older than the time to keep; returns how many folders and files."""
    roots = [form.domain(d) for form in (lake, lake.wide) for d in schemas.DOMAINS]
    roots += [form.kpi(k) for form in (lake, lake.wide) for k in schemas.KPIS]
    gone = sum(len(commits.vacuum(spark, root, keep_seconds)) for root in roots)
    for source in quality.BRONZE_CHECKED:
        for date in tables.raw_dates(spark, lake, source):
            gone += len(vacuum_raw(spark, lake, source, date, keep_seconds))
    return gone


# --- tables of a date ----------------------------------------------------------------------------


def domain_frames(
    spark: SparkSession,
    lake: Lake,
    date: str,
    counters: dict[str, quality.RowCounter] | None = None,
    only: Sequence[str] | None = None,
    allow_missing: bool = False,
) -> dict[str, DataFrame]:
    """Plans of the domain tables for one date.

    A source without data is an empty frame if the other source of the domain has some, or if
    ``allow_missing``; else the job fails. With ``counters`` the rows read, unique and complete are
    counted while a table is written.
    """
    def raw(*sources: str) -> list[DataFrame]:
        found = [tables.read_raw(spark, lake, s, date) for s in sources]
        if not allow_missing and all(df is None for df in found):
            raise MissingInput(f"{' and '.join(sources)}: no raw data of {date} in {lake.raw}")
        return [
            empty(spark, schemas.raw_columns(s)) if df is None else df
            for s, df in zip(sources, found)
        ]

    def watch(domain: str) -> silver.Watch | None:
        if counters is None:
            return None
        counters[domain] = quality.RowCounter()
        return counters[domain].watch

    plans = _chosen({
        "events": lambda: silver.events(
            *raw("user_events", "clickstream"), date, watch=watch("events")),
        "transactions": lambda: silver.transactions(
            *raw("transactions", "payments"), date, watch=watch("transactions")),
        "customers": lambda: silver.customers(
            *raw("crm", "orders"), date, watch=watch("customers")),
        "inventory": lambda: silver.inventory(
            *raw("inventory"), tables.read_product_orders(spark, lake, date), date,
            watch=watch("inventory")),
    }, only)
    return {name: plan() for name, plan in plans.items()}


def wide_domain_frames(
    spark: SparkSession, lake: Lake, date: str, only: Sequence[str] | None = None
) -> dict[str, DataFrame | None]:
    def raw(source: str) -> DataFrame | None:
        return tables.read_raw(spark, lake, source, date)

    plans = _chosen({
        "events": lambda: silver_wide.events(raw("user_events"), raw("clickstream"), date),
        "transactions": lambda: silver_wide.transactions(raw("transactions"), raw("payments"), date),
        "customers": lambda: silver_wide.customers(raw("crm"), raw("orders"), date),
        "inventory": lambda: silver_wide.inventory(raw("inventory"), raw("orders"), date),
    }, only)
    return {name: plan() for name, plan in plans.items()}


def build_silver(
    spark: SparkSession,
    lake: Lake,
    date: str,
    wide: bool = False,
    steps: dict[str, dict[str, int]] | None = None,
    only: Sequence[str] | None = None,
    allow_missing: bool = False,
) -> Counts:
    """Write the domain tables of a date, all or the named ones; returns the rows per table.

    ``steps`` is filled with the rows per domain that were read, unique and complete; rows
    read minus unique are duplicates, unique minus complete lack a mandatory field. The batches that
    a table is made of are noted with it.
    """
    counters: dict[str, quality.RowCounter] | None = None if steps is None else {}
    # taken before the sources are listed: what comes in between is late, never lost
    made_of = {d: _ledger_entry(spark, lake, d, date) for d in DOMAIN_SOURCES if only is None or d in only}
    frames = (
        wide_domain_frames(spark, lake, date, only) if wide
        else domain_frames(spark, lake, date, counters, only, allow_missing)
    )
    to = lake.wide if wide else lake
    counts: Counts = {}
    for name, df in frames.items():
        _write_counted(
            spark, counts, "silver", name, df, to.domain(name), date, notes={"inputs": made_of[name]})
        if counters and name in counters:
            steps[name] = counters[name].counts()
    return counts


def remember_day(spark: SparkSession, lake: Lake, date: str) -> Activity:
    """Merge the events table of a date into the state of active days."""
    state = Activity(spark, lake)
    events = tables.read_partition(spark, lake.domain("events"), date, schemas.DOMAINS["events"])
    state.merge_day(empty(spark, schemas.DOMAINS["events"]) if events is None else events, date)
    return state


def kpi_frames(
    spark: SparkSession, lake: Lake, date: str, retention_days: int = 1,
    only: Sequence[str] | None = None, allow_missing: bool = False, history: bool = False,
) -> dict[str, DataFrame]:
    """Plans of the KPI tables; a table without the domain dates it needs fails unless
    ``allow_missing``. Retention beyond the first day needs several dates, or ``history``: then
    the date is merged into the state of active days, and cohorts are those of first days ever."""
    def given(found: DataFrame | None, what: str, columns: schemas.Columns) -> DataFrame:
        if found is None and not allow_missing:
            raise MissingInput(f"{what}: no data of {date}")
        return empty(spark, columns) if found is None else found

    def domain(name: str, days: int = 1) -> DataFrame:
        columns = schemas.DOMAINS[name]
        path = lake.domain(name)
        return given(tables.read_range(spark, path, date, days, columns), path, columns)

    def iot() -> DataFrame:
        found = tables.read_raw(spark, lake, "iot_sensors", date)
        return given(found, lake.bronze("iot_sensors"), schemas.raw_columns("iot_sensors"))

    def retention() -> DataFrame:
        if not history:
            return gold.user_retention(domain("events", retention_days))
        domain("events")
        since = datetime.fromisoformat(date) - timedelta(days=retention_days - 1)
        return remember_day(spark, lake, date).retention(since=since.strftime("%Y-%m-%d"), until=date)

    plans = _chosen({
        "daily_revenue": lambda: gold.daily_revenue(domain("transactions"), domain("events")),
        "user_retention": retention,
        "iot_anomaly_summary": lambda: gold.sensor_anomaly(gold.readings_from_raw(iot())),
        "inventory_turnover": lambda: gold.inventory_turnover(domain("inventory")),
    }, only)
    return {name: gold.with_audit(plan(), date) for name, plan in plans.items()}


def wide_kpi_frames(
    spark: SparkSession, lake: Lake, date: str, retention_days: int = 1,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame | None]:
    def domain(name: str, days: int = 1) -> DataFrame | None:
        return tables.read_range(spark, lake.wide.domain(name), date, days)

    def revenue() -> DataFrame | None:
        transactions = domain("transactions")
        return None if transactions is None else gold_wide.revenue_breakdown(transactions, domain("events"))

    def retention() -> DataFrame | None:
        events = domain("events", retention_days)
        return None if events is None else gold_wide.retention_span(events)

    def anomalies() -> DataFrame | None:
        iot = tables.read_raw(spark, lake, "iot_sensors", date)
        return None if iot is None else gold_wide.sensor_anomaly_by_location(gold.readings_from_raw(iot))

    def turnover() -> DataFrame | None:
        stock = domain("inventory")
        return None if stock is None else gold_wide.stock_turnover(stock, domain("transactions"))

    plans = _chosen({
        "daily_revenue": revenue, "user_retention": retention,
        "iot_anomaly_summary": anomalies, "inventory_turnover": turnover,
    }, only)
    frames = {name: plan() for name, plan in plans.items()}
    return {name: None if df is None else gold_wide.with_audit(df, date) for name, df in frames.items()}


def build_gold(
    spark: SparkSession, lake: Lake, date: str, wide: bool = False, retention_days: int = 1,
    only: Sequence[str] | None = None, allow_missing: bool = False, history: bool = False,
) -> Counts:
    """Write the KPI tables of a date, all or the named ones; returns the rows per table."""
    frames = (
        wide_kpi_frames(spark, lake, date, retention_days, only) if wide
        else kpi_frames(spark, lake, date, retention_days, only, allow_missing, history)
    )
    to = lake.wide if wide else lake
    order = {} if wide else {"user_retention": ["cohort_date", "days_since_cohort"]}
    counts: Counts = {}
    for name, df in frames.items():
        _write_counted(spark, counts, "gold", name, df, to.kpi(name), date, order.get(name))
    return counts


def load_serving(
    spark: SparkSession,
    lake: Lake,
    date: str,
    url: str,
    properties: Mapping[str, str],
    skip_loaded: bool = True,
) -> dict[str, bool]:
    """Append the KPI rows of a date to the serving tables; False where nothing was sent."""
    done = dict.fromkeys(schemas.CONTRACTS, False)
    for kpi, contract in schemas.CONTRACTS.items():
        rows = tables.read_partition(spark, lake.kpi(kpi), date)
        if rows is not None:
            loaded = existing_keys(spark, contract, date, url, properties) if skip_loaded else None
            done[kpi] = load_jdbc(rows, contract, url, properties, loaded)
    return done


def run_day(
    spark: SparkSession,
    lake: Lake,
    date: str | None = None,
    wide: bool = False,
    retention_days: int = 1,
    serving: tuple[str, Mapping[str, str]] | None = None,
    allow_missing: bool = False,
    history: bool = False,
) -> DataFrame:
    """Domain tables, KPI tables, then (with a URL) the serving load. Returns the ledger."""
    date = date or previous_day()
    counts = build_silver(spark, lake, date, wide, allow_missing=allow_missing)
    counts.update(build_gold(
        spark, lake, date, wide, retention_days, allow_missing=allow_missing, history=history))
    if serving and not wide:
        load_serving(spark, lake, date, *serving)
    return quality.ledger(spark, counts)
