"""Event-time progress of an ingest, source by source.

Each micro-batch notes the latest event time of every source and when the source was last heard of, in one small file named by
the batch. The next batch takes its limits from the file before its own, so a retried batch decides as it did the first
time, and a restart goes on where it stopped. A row that is older than its source's limit is late: it goes to the dead-letter zone with
that reason, not into an hour that may be closed. No state is shuffled or kept on executors.

`watermark` is the time up to which all sources have been read. A source that has been silent for a while doesn't
hold it back.
"""

from __future__ import annotations

import datetime
import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoreline.functions import payload as pl
from shoreline.functions.temporal import parse_timestamp
from shoreline.operators.envelope import source_of
from shoreline.sources.commits import Folder
from shoreline.sources.lake import Lake

LATE = "late_record"
MICRO = 1_000_000


class Lateness(NamedTuple):
    """Fixed values of the stream contract: seconds that rows may be out of order, and that a source may be silent."""

    bound: float = 30.0
    idle: float = 60.0


class Heard(NamedTuple):
    """Microseconds of a source's latest event, and of the batch that last had rows of it."""

    latest: int | None
    seen: int


Progress = dict[str, Heard]


class ProgressLog:
    """The files of one ingest."""

    def __init__(self, spark: SparkSession, lake: Lake, ingest: str) -> None:
        self.folder = Folder(spark, f"{lake.raw}/_progress/{ingest}")

    def before(self, batch: int | None = None) -> Progress:
        """What was noted before a batch, or at last."""
        numbers = [int(n) for n in self.folder.names() if n[0] != "." and (batch is None or int(n) < batch)]
        if not numbers:
            return {}
        held = json.loads(self.folder.read(f"{max(numbers):012d}"))
        return {source: Heard(*x) for source, x in held.items()}

    def note(self, batch: int, progress: Progress) -> None:
        """Note the progress after a batch; a retry finds it noted."""
        self.folder.create(f"{batch:012d}", json.dumps(progress, sort_keys=True))


def event_time() -> Column:
    """The event time of a parsed record."""
    return parse_timestamp(pl.text_field("document", "timestamp"))


def mark_late(parsed: DataFrame, progress: Progress, lateness: Lateness, routes: dict[str, str] | None = None) -> DataFrame:
    """Good rows that are older than their source's limit get the reason."""
    limits = {s: h.latest - round(lateness.bound * MICRO) for s, h in progress.items() if h.latest is not None}
    if not limits:
        return parsed
    pairs = [F.lit(x) for item in limits.items() for x in item]
    limit = F.try_element_at(F.create_map(*pairs), source_of(F.col("topic"), routes))
    late = F.col("reason").isNull() & (F.unix_micros(event_time()) < limit)
    return parsed.withColumn("reason", F.when(late, F.lit(LATE)).otherwise(F.col("reason")))


def observed(
    parsed: DataFrame, sources: list[str], batch_time: Column, lateness: Lateness, routes: dict[str, str] | None = None
) -> tuple[DataFrame, Observation]:
    """Counts rows and takes the latest event time of each source while the rows are written. A time further in the future than
    the bound moves nothing."""
    own = source_of(F.col("topic"), routes)
    at = F.unix_micros(event_time())
    honest = at <= F.unix_micros(batch_time) + round(lateness.bound * MICRO)
    seen = Observation()
    metrics = [F.max(F.unix_micros(batch_time)).alias("at")]
    for i, source in enumerate(sources):
        metrics += [F.count_if(own == source).alias(f"rows_{i}"), F.max(F.when((own == source) & honest, at)).alias(f"latest_{i}")]
    return parsed.observe(seen, *metrics), seen


def advanced(progress: Progress, seen: dict, sources: list[str]) -> Progress:
    """Progress after a batch. Event times never go back."""
    out = dict(progress)
    for i, source in enumerate(sources):
        if seen[f"rows_{i}"]:
            known = out[source].latest if source in out else None
            times = [t for t in (known, seen[f"latest_{i}"]) if t is not None]
            out[source] = Heard(max(times, default=None), seen["at"])
    return out


def is_idle(heard: Heard, now: int, lateness: Lateness) -> bool:
    return now - heard.seen > lateness.idle * MICRO


def watermark(progress: Progress, lateness: Lateness = Lateness(), now: datetime.datetime | None = None) -> datetime.datetime | None:
    """All rows before this time have come, as far as can be told; None if no source is active or one has no time yet.

    Silent sources are left out; when all are silent, the last one heard of counts.
    """
    if not progress:
        return None
    moment = round((now or datetime.datetime.now(datetime.timezone.utc)).timestamp() * MICRO)
    last = max(h.seen for h in progress.values())
    active = [h for h in progress.values() if not is_idle(h, moment, lateness)] or [
        h for h in progress.values() if h.seen == last]
    if any(h.latest is None for h in active):
        return None
    micros = min(h.latest for h in active) - round(lateness.bound * MICRO)
    return datetime.datetime.fromtimestamp(micros / MICRO, datetime.timezone.utc)
