"""Rolling: many small files of an hour become few large ones.

A micro-batch closes its files, so a stream leaves a file for each task, source, hour and minute. `roll` packs the small files of
an hour once they fill a part, once the oldest has waited long enough, or once nothing has come for a while. These limits
are taken from the files themselves, so they hold over micro-batches and restarts. The scan of an hour that fills parts packs its files into tasks of
one part, and each task writes one file: nothing is shuffled. Hours with less than a part are gathered by hour. No line
is parsed. One commit for each source and date puts the new files of both zones in place of the old ones; readers see either.
"""

from __future__ import annotations

import time
from collections import defaultdict
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.sources import commits
from shoreline.sources.commits import Folder
from shoreline.sources.lake import LANDED, PACKED, RAW_PARTITIONS, Lake, raw_dates, slot_of, written_batches

ZONES = ("bronze", "dead_letter")


class RollPolicy(NamedTuple):
    """Fixed values of the raw layer: bytes of a part, seconds from its first line and from its last."""

    part_bytes: int = 128 * 1024 * 1024
    age: float = 600.0
    idle: float = 300.0


@dataclass
class Batch:
    """One batch of an hour in both zones."""

    slot: str
    folders: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    first: float = float("inf")
    last: float = 0.0


def batches(spark: SparkSession, lake: Lake, source: str, date: str) -> dict[str, list[Batch]]:
    """The batches of each hour that count and are whole, but for those that were landed as compressed files."""
    raw = Folder(spark, lake.raw)
    slots = commits.current(spark, lake.raw_log(source, date)) or {}
    found: dict[str, Batch] = {}

    def note(folder: str, size: int, at: float) -> None:
        batch = found.setdefault(slot_of(folder), Batch(slot_of(folder)))
        if folder not in batch.folders:
            batch.folders.append(folder)
        batch.sizes.append(size)
        batch.first, batch.last = min(batch.first, at), max(batch.last, at)

    for zone in ZONES:
        plain = f"zone={zone}/source={source}/dt={date}/hour=*/batch=*"
        packed = {slot_of(folder) for folder, *_ in raw.files(plain, f"*{PACKED}")}
        for folder, size, at in raw.files(plain):
            if slot_of(folder) not in slots and slot_of(folder) not in packed:
                note(folder, size, at)
    for folder in commits.folders_of(slots):
        for _, size, at in raw.files(folder):
            note(folder, size, at)
    out = defaultdict(list)
    for slot, batch in sorted(found.items()):
        hour, name = slot.split("/")
        if slot in slots or raw.exists(f"{LANDED}/{name.removeprefix('batch=')}"):
            out[hour].append(batch)
    return out


def due(hour: list[Batch], policy: RollPolicy, now: float) -> list[Batch]:
    """The batches of an hour to be rolled: those whose files fill less than half a part on average, if there are
    several and a limit is reached."""
    small = [b for b in hour if 2 * sum(b.sizes) < policy.part_bytes * len(b.sizes)]
    files, size = sum(len(b.sizes) for b in small), sum(sum(b.sizes) for b in small)
    zones = len({f.split("zone=")[1].split("/")[0] for b in small for f in b.folders})
    if files <= zones:
        return []
    waited = now - min(b.first for b in small) >= policy.age or now - max(b.last for b in small) >= policy.idle
    return small if waited or size >= policy.part_bytes else []


class Group(NamedTuple):
    """What is rolled together: batches of one source, date and hour."""

    source: str
    date: str
    hour: str
    batches: list[Batch]

    def folders(self, zone: str | None = None) -> list[str]:
        return [f for b in self.batches for f in b.folders if zone is None or f"zone={zone}/" in f]

    def size(self) -> int:
        return sum(sum(b.sizes) for b in self.batches)


def roll(
    spark: SparkSession, lake: Lake, source: str, date: str, policy: RollPolicy = RollPolicy(), now: float | None = None
) -> int:
    """Roll the hours of one source and date that are due; returns how many files were replaced."""
    return roll_all(spark, lake, [source], [date], policy, now)


def roll_all(
    spark: SparkSession, lake: Lake, sources: list[str], dates: list[str] | None = None,
    policy: RollPolicy = RollPolicy(), now: float | None = None,
) -> int:
    """Roll what is due of the sources, on all their dates or the given ones, in one job; then one commit for each
    source and date."""
    now = time.time() if now is None else now
    groups = [
        Group(source, date, hour, chosen)
        for source in sources
        for date in (_dates(spark, lake, source) if dates is None else dates)
        for hour, found in batches(spark, lake, source, date).items() if (chosen := due(found, policy, now))]
    if not groups:
        return 0
    version = commits.new_version()
    name = f"roll-{version.rpartition('/')[2]}"
    lines = _packed(spark, lake, [g for g in groups if g.size() >= policy.part_bytes], policy)
    few = _gathered(spark, lake, [g for g in groups if g.size() < policy.part_bytes])
    for df in (lines, few):
        if df is not None:
            df.withColumn("batch", F.lit(name)).select("value", *RAW_PARTITIONS).write.mode("append").partitionBy(
                *RAW_PARTITIONS).text(f"{lake.raw}/{version}")
    written = written_batches(spark, lake, version)
    for source, date in dict.fromkeys((g.source, g.date) for g in groups):
        slots = commits.current(spark, lake.raw_log(source, date)) or {}
        changes = {}
        for g in groups:
            if (g.source, g.date) == (source, date):
                made_of = [x for b in g.batches for x in slots.get(b.slot, {"of": [b.slot]}).get("of", ())]
                changes |= {b.slot: {"folders": [], "of": []} for b in g.batches}
                at = f"/source={source}/dt={date}/{g.hour}/"
                changes[f"{g.hour}/batch={name}"] = {"folders": [f for f in written if at in f], "of": sorted(made_of)}
        commits.commit(spark, lake.raw_log(source, date), changes)
    return sum(len(b.sizes) for g in groups for b in g.batches)


def _dates(spark: SparkSession, lake: Lake, source: str) -> list[str]:
    return sorted({d for zone in ZONES for d in raw_dates(spark, lake, source, zone)})


def _packed(spark: SparkSession, lake: Lake, groups: list[Group], policy: RollPolicy) -> DataFrame | None:
    """Lines of hours that fill parts. The scan of each fills its tasks up to a part; nothing is shuffled."""
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", policy.part_bytes)
    packing.conf.set("spark.sql.files.openCostInBytes", 0)
    # few bytes are not spread over many tasks
    packing.conf.set("spark.sql.files.minPartitionNum", 1)
    lines: DataFrame | None = None
    for g in groups:
        for zone in ZONES:
            if g.folders(zone):
                part = packing.read.option("lineSep", "\n").text([f"{lake.raw}/{f}" for f in g.folders(zone)])
                values = (zone, g.source, g.date, g.hour.removeprefix("hour="))
                part = part.select("value", *(F.lit(v).alias(c) for c, v in zip(RAW_PARTITIONS, values)))
                lines = part if lines is None else lines.union(part)
    return lines


def _gathered(spark: SparkSession, lake: Lake, groups: list[Group]) -> DataFrame | None:
    """Lines of hours that don't fill a part, each brought to one task, all in one scan."""
    if not groups:
        return None
    folders = [f"{lake.raw}/{f}" for g in groups for f in g.folders()]
    lines = spark.read.option("lineSep", "\n").text(folders).select("value", F.input_file_name().alias("_file"))
    at = {c: F.regexp_extract("_file", rf"/{c}=([^/]+)", 1) for c in RAW_PARTITIONS[:-1]}
    return lines.withColumns(at).drop("_file").repartition(*RAW_PARTITIONS[:-1])


def vacuum_raw(spark: SparkSession, lake: Lake, source: str, date: str, keep_seconds: float, now: float | None = None) -> list[str]:
    """Delete batches of a source's date that were rolled, and superseded versions of it, once older than the time to keep."""
    raw = Folder(spark, lake.raw)
    until = (time.time() if now is None else now) - keep_seconds
    slots = commits.current(spark, lake.raw_log(source, date)) or {}
    used = set(commits.folders_of(slots))
    at = f"zone=*/source={source}/dt={date}/hour=*/batch=*"
    newest: dict[str, float] = {}
    for pattern in (at, f"{commits.VERSIONS}/*/{at}"):
        for folder, _, written in raw.files(pattern):
            newest[folder] = max(written, newest.get(folder, 0.0))
    # a plain folder goes if its slot was taken over; a version if no slot names it any more
    gone = [f for f, written in newest.items() if written < until and f not in used and (
        f.startswith(commits.VERSIONS) or slot_of(f) in slots)]
    for folder in gone:
        raw.delete(folder)
    return sorted(gone)
