"""Topic records to the raw layer, exactly once."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoreline.operators.envelope import STREAM_JOB, parse_records, parsed_rows, stream_rows
from shoreline.schemas import TOPIC_SOURCES, UNKNOWN_SOURCE
from shoreline.sources.lake import Lake, write_raw
from shoreline.streaming.lateness import Lateness, ProgressLog, advanced, mark_late, observed
from shoreline.streaming.rolling import RollPolicy, roll

COMMIT_INTERVAL = "60 seconds"
#: Column of the time that is logged for a micro-batch.
BATCH_TIME = "_batch_time"


def start_raw_ingest(
    records: DataFrame,
    lake: Lake,
    checkpoint: str,
    name: str = "ingest",
    routes: dict[str, str] | None = None,
    job: str = STREAM_JOB,
    available_now: bool = False,
    policy: RollPolicy | None = None,
    lateness: Lateness | None = None,
) -> StreamingQuery:
    """Route, wrap and land all topics with one query, bad lines in the dead-letter zone.

    Nothing is shuffled: a Kafka partition carries one topic, so a task writes to one
    source and few hours. A micro-batch is written under its own batch name by
    replacing it, so the retry of a failed batch leaves one copy. The name holds the id that
    Spark keeps in the checkpoint: a restart finds its batches, another ingest never does.
    The row limit of the writer bounds the size of a file. With a policy, small files are rolled: after each
    micro-batch the sources and dates that it or an earlier one wrote to are looked at, until nothing of
    them is left to roll. What a stopped query leaves is rolled by the ``roll`` job. With a lateness, rows
    that come later than their source allows go to the dead-letter zone too; without one, none is late.
    """
    started: Future[str] = Future()
    waiting: set[tuple[str, str]] = set()
    sources = [*dict.fromkeys((routes or TOPIC_SOURCES).values()), UNKNOWN_SOURCE]

    def land(batch_rows: DataFrame, batch_id: int) -> None:
        spark = batch_rows.sparkSession
        batch = f"{name}-{started.result()}-{batch_id:09d}"
        progress = heard = None
        rows = batch_rows
        if lateness is not None:
            log = ProgressLog(spark, lake, f"{name}-{started.result()}")
            progress = log.before(batch_id)
            parsed, heard = observed(parse_records(batch_rows), sources, F.col(BATCH_TIME), lateness, routes)
            rows = parsed_rows(mark_late(parsed, progress, lateness, routes), F.col(BATCH_TIME), routes, job)
        touched = Observation()
        if policy is not None:
            rows = rows.observe(touched, F.collect_set(F.struct("source", "dt")).alias("at"))
        write_raw(rows, lake, batch)
        if heard is not None:
            log.note(batch_id, advanced(progress, heard.get, sources))
        if policy is not None:
            waiting.update(tuple(x) for x in touched.get["at"])
            for source, date in sorted(waiting):
                if roll(spark, lake, source, date, policy):
                    waiting.discard((source, date))

    # what is late is known when the batch begins, so then the rows are wrapped within it
    given = stream_rows(records, routes, job) if lateness is None else records.withColumn(BATCH_TIME, F.current_timestamp())
    writer = given.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(land)
    trigger = {"availableNow": True} if available_now else {"processingTime": COMMIT_INTERVAL}
    running = writer.trigger(**trigger).start()
    started.set_result(str(running.id))
    return running


def start_console(records: DataFrame, routes: dict[str, str] | None = None) -> StreamingQuery:
    """Print the raw rows of the records that are there now."""
    return (
        stream_rows(records, routes)
        .writeStream.format("console")
        .option("truncate", False)
        .trigger(availableNow=True)
        .start()
    )
