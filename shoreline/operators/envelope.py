"""Raw-layer records: parse, route, add lineage, split good from bad.

The payload is handled as a VARIANT object, so every key of it is kept without a
schema, and no Python runs per record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions import payload as pl
from shoreline.functions.temporal import event_bucket, parse_timestamp
from shoreline.schemas import TOPIC_SOURCES, UNKNOWN_SOURCE

STREAM_JOB = "shoreline_stream_ingest"
BATCH_JOB = "shoreline_batch_ingest"
#: Drops have a date, no hour.
BATCH_HOUR = "00"

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Columns a batch reader adds to the payload.
CORRUPT = "_corrupt_record"
BATCH_READ_COLUMNS = ("_file_path", CORRUPT)


def source_of(topic: Column, routes: dict[str, str] | None = None) -> Column:
    """Source name of a topic; topics without a route are ``unknown``."""
    pairs = [F.lit(x) for route in (routes or TOPIC_SOURCES).items() for x in route]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), topic), F.lit(UNKNOWN_SOURCE))


def parse_records(records: DataFrame) -> DataFrame:
    """Add the parsed object (``fields``) and the reason for rejecting the line, if any."""
    parsed = records.withColumn("document", pl.parse_document("value")).withColumn(
        "fields", pl.object_fields("value", "document")
    )
    return parsed.withColumn("reason", pl.reject_reason("value", "document", "fields"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull())


def _iso(moment: Column) -> Column:
    return F.date_format(moment, ISO_MICROS)


def _raw_rows(parsed: DataFrame, lineage: dict[str, Column], ingested_at: Column) -> DataFrame:
    """One JSON line per record, good ones with their payload, bad ones with the reason.

    Both kinds leave in one pass. Good rows are bucketed by event time, bad rows and
    rows without a usable time by ingest time.
    """
    good = F.col("reason").isNull()
    envelope = {**lineage, "_ingested_at": _iso(ingested_at), "_raw": F.col("value")}
    bad = {**{k: v for k, v in lineage.items() if k not in ("_source", "_job")},
           "_raw": F.col("value"),
           "_error_reason": F.col("reason"),
           "_error_ts": _iso(ingested_at)}
    event_time = F.when(good, parse_timestamp(pl.text_field("document", "timestamp")))
    bucket = event_bucket(F.col("_moment"), ingested_at)
    return parsed.withColumn("_moment", event_time).select(
        F.when(good, pl.extend_object("value", "fields", envelope))
        .otherwise(F.to_json(F.struct(*[v.alias(k) for k, v in bad.items()])))
        .alias("value"),
        F.when(good, "bronze").otherwise("dead_letter").alias("zone"),
        lineage["_source"].alias("source"),
        *[v.alias(k) for k, v in bucket.items()],
    )


def stream_rows(
    records: DataFrame,
    routes: dict[str, str] | None = None,
    job: str = STREAM_JOB,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Raw-layer rows of topic records (``value, topic, partition, offset``).

    Works on static and streaming frames alike. In a stream the ingest time is the
    time logged for the micro-batch, so a replay writes the same rows.
    """
    moment = ingested_at if ingested_at is not None else F.current_timestamp()
    return parsed_rows(parse_records(records), moment, routes, job)


def parsed_rows(
    parsed: DataFrame, ingested_at: Column, routes: dict[str, str] | None = None, job: str = STREAM_JOB
) -> DataFrame:
    """Raw-layer rows of records that are parsed already."""
    lineage = {
        "_source": source_of(F.col("topic"), routes),
        "_kafka_topic": F.col("topic"),
        "_kafka_partition": F.col("partition").cast("int"),
        "_kafka_offset": F.col("offset").cast("bigint"),
        "_job": F.lit(job),
    }
    return _raw_rows(parsed, lineage, ingested_at)


def with_batch_envelope(
    drop: DataFrame,
    source: str,
    job: str = BATCH_JOB,
    ingested_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed batch rows with their lineage: source, file, ingest time, job, row as JSON."""
    content = [c for c in drop.columns if c not in BATCH_READ_COLUMNS]
    return drop.select(
        *content,
        F.lit(source).alias("_source"),
        "_file_path",
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
        F.lit(job).alias("_job"),
        F.to_json(F.struct(*content)).alias("_raw"),
        *keep,
    )


def batch_rows(
    drop: DataFrame,
    source: str,
    date: str,
    job: str = BATCH_JOB,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Raw-layer rows of a batch drop, filed under the processing date.

    A record the reader could not parse goes to the dead-letter zone with its text.
    """
    moment = ingested_at if ingested_at is not None else F.current_timestamp()
    enveloped = with_batch_envelope(drop, source, job, moment, keep=[CORRUPT])
    content = [c for c in enveloped.columns if c != CORRUPT]
    good = F.to_json(F.struct(*content), {"timestampFormat": ISO_MICROS})
    bad = F.to_json(F.struct(
        "_file_path",
        F.col(CORRUPT).alias("_raw"),
        F.lit("malformed_record").alias("_error_reason"),
        _iso(moment).alias("_error_ts"),
    ))
    broken = F.col(CORRUPT).isNotNull()
    return enveloped.select(
        F.when(broken, bad).otherwise(good).alias("value"),
        F.when(broken, "dead_letter").otherwise("bronze").alias("zone"),
        F.lit(source).alias("source"),
        F.lit(date).alias("dt"),
        F.lit(BATCH_HOUR).alias("hour"),
    )
