"""Published queries over lakes with a history: rewrites that fail, rolled files, days that are built one by one."""

from __future__ import annotations

import contextlib
import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.catalog.frames import DAYS, SampleSources
from shoreline.catalog.jobs import QUERIES, same_as
from shoreline.catalog.oracles import BASE, DAY, DAY_LINES, DOM, ORACLES, SOURCES, STAMP, _with
from shoreline.catalog.queries import LANDED, _event_stream, _events, publish, query
from shoreline.plans import daily
from shoreline.plans.activity import Activity
from shoreline.session import scratch_path
from shoreline.sources import commits
from shoreline.sources import lake as tables
from shoreline.sources.commits import Folder
from shoreline.sources.lake import Lake
from shoreline.streaming import ingest, rolling
from shoreline.streaming.lateness import MICRO, Lateness, ProgressLog, is_idle, watermark
from shoreline.streaming.records import file_records

__all__ = ["ORACLES", "QUERIES"]

# --- writes that fail --------------------------------------------------------------------------


@query
def failed_rewrite(src: SampleSources) -> DataFrame:
    """All days written; then the first day and, in one write, all days again by jobs that break at their last
    event. What is left are the rows of the first write."""
    path = f"{scratch_path(src.spark, 'failed')}/events"
    by_day = src.events.select("event_id", "event_type", F.to_date("ts").alias("dt"))
    tables.write_table(by_day, path)
    first, last = by_day.agg(F.min("dt"), F.max("event_id")).first()
    broken = by_day.withColumn("event_type", F.when(
        F.col("event_id") == last, F.raise_error(F.lit("broken"))).otherwise(F.lit("rewritten")))
    for write in (lambda: tables.write_date(broken, path, str(first)), lambda: tables.write_table(broken, path)):
        with contextlib.suppress(PySparkException):
            write()
    return publish(tables.read_all(src.spark, path))


ORACLES["failed_rewrite"] = f"""{BASE}
SELECT event_id, event_type, strftime(CAST(ts AS DATE), {DAY}) AS dt FROM ev"""

# --- rolled files --------------------------------------------------------------------------------

#: Parts of the event records that arrive one after another.
DELIVERIES = 3


def _rolled_lake(src: SampleSources) -> Lake:
    """The event records in several ingests of one stream, each a batch of its own, then rolled."""
    root = scratch_path(src.spark, "rolled")
    lake = Lake(f"{root}/lake")
    records = _event_stream(src).topic_lines(DAYS)
    part = F.pmod(F.xxhash64("value"), F.lit(DELIVERIES))
    for i in range(DELIVERIES):
        ingest.start_raw_ingest(
            records.where(part == i), lake, f"{root}/checkpoint-{i}", name="ingest", available_now=True
        ).awaitTermination()
    rolling.roll_all(src.spark, lake, _sources(), policy=rolling.RollPolicy(idle=0))
    return lake


def _sources() -> list[str]:
    return [*dict.fromkeys(schemas.TOPIC_SOURCES.values()), schemas.UNKNOWN_SOURCE]


def _counting_folders(src: SampleSources, lake: Lake) -> list[tuple[str, str, str, str]]:
    """Source, date, hour and folder of the good lines that count."""
    out = []
    for source in _sources():
        for date in tables.raw_dates(src.spark, lake, source):
            found = tables.raw_folders(src.spark, lake, "bronze", source, date)
            if found is None:
                # one file from the start: nothing was rolled
                found = Folder(src.spark, lake.raw).glob(f"zone=bronze/source={source}/dt={date}/hour=*/batch=*")
            for folder in found:
                hour = folder.split("hour=")[1].split("/")[0]
                out.append((source, date, hour, f"{lake.raw}/{folder}"))
    return out


@query
def stream_ingest_rolled(src: SampleSources) -> DataFrame:
    """The lines of a stream after its small files were rolled."""
    lake = _rolled_lake(src)
    folders = _counting_folders(src, lake)
    landed = src.spark.read.schema(LANDED).json([f for *_, f in folders]).select(
        "*", F.input_file_name().alias("file"))
    at = {name: F.regexp_extract("file", rf"{name}=([^/]+)", 1).alias(name) for name in ("source", "dt", "hour")}
    return publish(landed.select(
        *at.values(), "event_id", "user_id", "event_type", F.col("value").alias("amount"),
        "_source", "_kafka_topic", "_kafka_offset", "_raw",
    ))


same_as("stream_ingest_rolled", "stream_ingest_available_now")


@query
def rolled_files(src: SampleSources) -> DataFrame:
    """Files of each source, date and hour after rolling: one, as none fills a part."""
    lake = _rolled_lake(src)
    rows = [(*at, f) for *at, f in _counting_folders(src, lake)]
    folders = src.spark.createDataFrame(rows, "source string, dt string, hour string, folder string")
    files = src.spark.read.text([f for *_, f in rows]).select(F.input_file_name().alias("file")).distinct()
    inside = F.regexp_extract("file", r"source=[^/]+/dt=[^/]+/hour=[^/]+/batch=[^/]+", 0)
    own = F.regexp_extract("folder", r"source=[^/]+/dt=[^/]+/hour=[^/]+/batch=[^/]+", 0)
    return folders.join(files, own == inside).groupBy("source", "dt", "hour").agg(F.count("*").alias("files"))


ORACLES["rolled_files"] = f"""
SELECT source, dt, hour, 1 AS files FROM ({ORACLES["stream_ingest_available_now"]}) GROUP BY ALL"""

# --- days built one by one -----------------------------------------------------------------------


def _merged_days(src: SampleSources, block_days: int = 8) -> Activity:
    """The domain events by day of the event, each day merged into the state by itself, odd days first; then the
    first day once more."""
    lake = Lake(f"{scratch_path(src.spark, 'activity')}/lake")
    path = lake.domain("events")
    tables.write_table(_events(src).withColumn("dt", F.to_date("timestamp")), path)
    dates = sorted(slot.removeprefix("dt=") for slot in commits.current(src.spark, path))
    state = Activity(src.spark, lake, block_days)
    for date in [*dates[1::2], *dates[::2], dates[0]]:
        state.merge_day(tables.read_partition(src.spark, path, date), date)
    return state


@query
def first_seen_day_by_day(src: SampleSources) -> DataFrame:
    """Each user's first day ever, from days that were merged one by one."""
    return publish(_merged_days(src).first_seen())


ORACLES["first_seen_day_by_day"] = f"""{DOM}
SELECT user_id, strftime(min(CAST(timestamp AS DATE)), {DAY}) AS first_date
FROM ev_silver WHERE user_id IS NOT NULL GROUP BY user_id"""


@query
def retention_day_by_day(src: SampleSources) -> DataFrame:
    """The retention grid from bitmaps of active days."""
    return publish(_merged_days(src).retention())


same_as("retention_day_by_day", "retention_grid")

# --- late deliveries -------------------------------------------------------------------------------


def _late_lake(src: SampleSources) -> tuple[Lake, list[str]]:
    """Event records of which a quarter comes late. The table of the second day is built in between; then the late ones
    of that day land. Of other days nothing is late."""
    root = scratch_path(src.spark, "late")
    lake = Lake(f"{root}/lake")
    records = _event_stream(src).topic_lines(DAYS)
    second = str(src.events.agg(F.date_add(F.to_date(F.min("ts")), 1)).first()[0])
    late = F.col("value").contains(f'"timestamp":"{second}"') & (F.pmod(F.xxhash64("value"), F.lit(4)) == 0)
    dates = [second]
    for i, part in enumerate((~late, late)):
        ingest.start_raw_ingest(
            records.where(part), lake, f"{root}/checkpoint-{i}", name="ingest", available_now=True).awaitTermination()
        if i == 0:
            dates.append(sorted(d for d in tables.raw_dates(src.spark, lake, "user_events") if d > second)[0])
            daily.build_silver(src.spark, lake, second, only=["events"])
    return lake, dates


@query
def late_dates(src: SampleSources) -> DataFrame:
    """Which dates of the events table are late in the run of the day after."""
    lake, (_, after) = _late_lake(src)
    daily.build_silver(src.spark, lake, after, only=["events"])
    return daily.change_ledger(src.spark, lake, ["events"]).select("dt", "status", "batches_built", "batches_now")


ORACLES["late_dates"] = f"""{BASE},
days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM ev WHERE event_type = 'click'),
marked AS (SELECT d, CAST((SELECT min(ts) FROM ev) AS DATE) + 1 AS second FROM days),
named AS (SELECT *, min(d) FILTER (d > second) OVER () AS after FROM marked)
SELECT strftime(d, {DAY}) AS dt, CASE d WHEN second THEN 'late' WHEN after THEN 'current' ELSE 'unbuilt' END AS status,
       CAST(CASE WHEN d IN (second, after) THEN 1 END AS INTEGER) AS batches_built,
       CAST(CASE WHEN d = second THEN 2 ELSE 1 END AS INTEGER) AS batches_now
FROM named"""


@query
def late_delivery(src: SampleSources) -> DataFrame:
    """Both days after the late dates were built anew, and whether that changed the day's table."""
    lake, dates = _late_lake(src)
    path = lake.domain("events")
    daily.build_silver(src.spark, lake, dates[1], only=["events"])
    rolling.roll_all(src.spark, lake, ["user_events"], dates, rolling.RollPolicy(idle=0))
    before = commits.current(src.spark, path)
    daily.rebuild_late(src.spark, lake)
    after = commits.current(src.spark, path)
    changed = [slot.removeprefix("dt=") for slot in after if after[slot] != before.get(slot)]
    rows = tables.read_all(src.spark, path)
    return publish(rows.select("event_id", "user_id", "event_type", "dt")).withColumn("rebuilt", F.col("dt").isin(changed))


ORACLES["late_delivery"] = f"""{BASE},
marked AS (SELECT *, CAST(ts AS DATE) AS d, CAST((SELECT min(ts) FROM ev) AS DATE) + 1 AS second FROM ev WHERE event_type = 'click')
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       strftime(d, {DAY}) AS dt, d = second AS rebuilt
FROM marked WHERE d IN (second, (SELECT min(d) FROM marked WHERE d > second))"""

# --- schemas from data -------------------------------------------------------------------------------


@query
def raw_type_conflicts(src: SampleSources) -> DataFrame:
    """Fields whose type changes: a value that is a number in the first half of the month and text in the second, and
    one that is both on each day."""
    lake = Lake(f"{scratch_path(src.spark, 'types')}/lake")
    early = F.day("ts") <= 15
    line = F.when(early, F.to_json(F.struct("event_id", F.round("value", 2).alias("amount"), F.col("k").alias("code")))).otherwise(
        F.to_json(F.struct("event_id", F.col("event_type").alias("amount"), F.col("k").cast("string").alias("code"))))
    line = F.when(early & (F.col("event_id") % 2 == 0), F.replace(line, F.lit('"code":'), F.lit('"code":[1],"was":'))).otherwise(line)
    tables.write_raw(src.events.select(
        line.alias("value"), F.lit("bronze").alias("zone"), F.lit("iot_sensors").alias("source"),
        F.date_format("ts", DAYS).alias("dt"), F.lit("00").alias("hour")), lake, "sample")
    lines = tables.raw_lines(src.spark, lake, "iot_sensors", tables.raw_dates(src.spark, lake, "iot_sensors"))
    found = tables.type_conflicts(tables.field_types(lines))
    # how many digits the numbers of a day have is not the point
    kind = F.regexp_replace("type", r"DECIMAL\(.*\)", "DECIMAL")
    return found.groupBy("field", kind.alias("type")).agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.sum("dates").alias("dates"))


ORACLES["raw_type_conflicts"] = f"""{BASE},
typed AS (
  SELECT CAST(ts AS DATE) AS d, unnest([
    {{'field': 'amount', 'type': CASE WHEN extract(day FROM ts) <= 15 THEN 'DECIMAL' ELSE 'STRING' END}},
    {{'field': 'code', 'type': CASE WHEN extract(day FROM ts) > 15 THEN 'STRING'
       WHEN event_id % 2 = 0 THEN 'ARRAY<BIGINT>' ELSE 'BIGINT' END}}]) AS x FROM ev),
daily AS (SELECT d, x.field AS field, CASE WHEN count(DISTINCT x.type) > 1 THEN 'VARIANT' ELSE min(x.type) END AS type
          FROM typed GROUP BY d, x.field)
SELECT field, type, strftime(min(d), {DAY}) AS first_date, strftime(max(d), {DAY}) AS last_date, count(*) AS dates
FROM daily GROUP BY field, type"""

# --- late rows and silent sources ------------------------------------------------------------------

#: Fixed by the catalog: when each event arrives, and once more. Events are on time by halves of their month, but every
#: tenth comes with the second half; every seventh arrives again with that half. Sign-ups stop after the first.
ARRIVAL = "CASE WHEN event_id % 10 = 0 THEN 1 WHEN day(ts) <= 15 THEN 0 ELSE 1 END"


def _late_ingest(src: SampleSources) -> tuple[Lake, str]:
    """Two arrivals of event records, taken by one ingest that is stopped in between."""
    root = scratch_path(src.spark, "lateness")
    lake = Lake(f"{root}/lake")
    lines = src.topic_lines(DAYS).withColumnRenamed("offset", "event_id").join(
        src.events.selectExpr("event_id", "event_type", f"{ARRIVAL} AS first"), "event_id")
    each = lines.selectExpr("value", "topic", "event_type", "explode(IF(event_id % 7 = 0, array(first, 1), array(first))) AS arrival")
    each = each.where("arrival = 0 OR event_type <> 'signup'")
    running = None
    for i in (0, 1):
        each.where(F.col("arrival") == i).select("value", "topic").write.mode("append").partitionBy("topic").text(f"{root}/in")
        running = ingest.start_raw_ingest(
            file_records(src.spark, f"{root}/in"), lake, f"{root}/checkpoint", available_now=True, lateness=Lateness())
        running.awaitTermination()
    return lake, f"ingest-{running.id}"


@query
def late_rows(src: SampleSources) -> DataFrame:
    """Every delivery by where it went: good lines, broken ones, late ones; nothing is lost."""
    lake, _ = _late_ingest(src)
    out = None
    for source in _sources():
        parts = [(tables.read_dead_letter(src.spark, lake, source), "_error_reason")]
        parts += [(src.spark.read.schema("_raw string").json(f"{lake.bronze(source)}"), None)] if tables.raw_dates(
            src.spark, lake, source) else []
        for df, reason in parts:
            if df is not None:
                rows = df.select(F.lit(source).alias("source"), "_raw", (F.col(reason) if reason else F.lit("ok")).alias("outcome"))
                out = rows if out is None else out.unionByName(rows)
    return out.groupBy("source", "outcome", "_raw").agg(F.count("*").alias("deliveries"))


# the lines carry days, so event times are midnights
ARRIVED = f"""{_with(SOURCES, DAY_LINES)},
arrived AS (
  SELECT source, outcome, line, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ts, event_type, unnest(CASE WHEN event_id % 7 = 0 THEN [first, 1] ELSE [first] END) AS arrival
  FROM (SELECT *, {ARRIVAL.replace('day(ts)', 'extract(day FROM ts)')} AS first FROM routed)),
kept AS (SELECT * FROM arrived WHERE arrival = 0 OR event_type <> 'signup')"""

ORACLES["late_rows"] = f"""{ARRIVED},
limits AS (SELECT source, max(ts) AS latest FROM kept WHERE arrival = 0 AND outcome = 'ok' GROUP BY source)
SELECT source, CASE WHEN outcome = 'ok' AND arrival = 1 AND ts < latest - INTERVAL 30 SECOND THEN 'late_record' ELSE outcome END
       AS outcome, line AS _raw, count(*) AS deliveries
FROM kept LEFT JOIN limits USING (source) GROUP BY 1, 2, 3"""


@query
def silent_sources(src: SampleSources) -> DataFrame:
    """Latest event of each source, whether it was silent in the last batch, and the watermark without silent ones."""
    lake, name = _late_ingest(src)
    progress = ProgressLog(src.spark, lake, name).before()
    lateness = Lateness(idle=0)
    last = max(h.seen for h in progress.values())
    now = datetime.datetime.fromtimestamp(last / MICRO, datetime.timezone.utc)
    reached = round(watermark(progress, lateness, now).timestamp() * MICRO)
    rows = [(s, h.latest, is_idle(h, last, lateness), reached) for s, h in sorted(progress.items())]
    found = src.spark.createDataFrame(rows, "source string, latest bigint, silent boolean, watermark bigint")
    return publish(found.withColumns({c: F.timestamp_micros(c) for c in ("latest", "watermark")}))


ORACLES["silent_sources"] = f"""{ARRIVED},
heard AS (SELECT source, max(ts) FILTER (outcome = 'ok') AS latest, max(arrival) = 0 AS silent FROM kept GROUP BY source)
SELECT source, strftime(latest, {STAMP}) AS latest, silent,
       strftime((SELECT min(latest) FILTER (NOT silent) FROM heard) - INTERVAL 30 SECOND, {STAMP}) AS watermark FROM heard"""
