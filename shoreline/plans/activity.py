"""Who was active on which day, kept from day to day.

For each user and block of days one row holds a bitmap of the active days and, in the order of its set bits, the events
of each of them. A day is merged into its block by setting or clearing one bit of each user, so merging a day again, in
any order, gives what that day's events say now. First-seen dates are the lowest bits: those of finished blocks are kept
as minima, merged block by block, so a day reads one block and one row for each user, never old events.

    <lake>/state/activity/block=<first day>/...        user_id, bits, counts
    <lake>/state/first_seen/before=<first day>/...     user_id, first_day

Both tables are committed like the tables of the lake, so a failed merge leaves the state as it was.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions import measures
from shoreline.functions.temporal import day_of
from shoreline.sources import commits
from shoreline.sources.lake import Lake

#: Days of a block. A bitmap has 63 bits to use; the sign stays clear.
BLOCK_DAYS = 56
MOST_DAYS = 63
EPOCH = datetime.date(1970, 1, 1)
STATE = "user_id string, bits bigint, counts array<bigint>"
FIRST = "user_id string, first_day int"


def day_number(date: str) -> int:
    return (datetime.date.fromisoformat(date) - EPOCH).days


class Activity:
    """The state of one lake."""

    def __init__(self, spark: SparkSession, lake: Lake, block_days: int = BLOCK_DAYS) -> None:
        if not 1 <= block_days <= MOST_DAYS:
            raise ValueError(f"a block has 1 to {MOST_DAYS} days")
        self.spark, self.block_days = spark, block_days
        self.table = f"{lake.root}/state/activity"
        self.minima = f"{lake.root}/state/first_seen"

    def _slots(self) -> commits.Slots:
        slots = commits.current(self.spark, self.table) or {}
        if other := {s["days"] for s in slots.values()} - {self.block_days}:
            raise ValueError(f"{self.table} has blocks of {other.pop()} days")
        return slots

    def _read(self, root: str, slot: dict | None, schema: str) -> DataFrame:
        if not slot or not slot["folders"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in slot["folders"]])

    def _write(self, df: DataFrame, root: str, name: str, **notes) -> None:
        at = f"{name}/{commits.new_version()}"
        df.write.parquet(f"{root}/{at}")
        commits.commit(self.spark, root, {name: {"folders": [at], **notes}})

    # --- merging ----------------------------------------------------------------------------------

    def merge_day(self, events: DataFrame, date: str) -> None:
        """Take over the users of one day, in place of what was known of that day.

        Events are reduced to users before anything is shuffled; both sides of the join have one row a user. The events of
        the one day are grouped by user alone, which is how the join needs them: they are shuffled once.
        """
        day = day_number(date)
        name = f"block={day - day % self.block_days}"
        old = self._read(self.table, self._slots().get(name), STATE)
        of_day = events.where(F.col("user_id").isNotNull() & (day_of("timestamp") == date))
        users = of_day.groupBy(F.col("user_id").cast("string").alias("_user")).agg(F.count("event_id").alias("_n"))
        offset = day % self.block_days
        bit, below = F.lit(1 << offset).cast("long"), F.lit((1 << offset) - 1).cast("long")
        both = old.join(users, F.col("user_id") == F.col("_user"), "full_outer")
        bits, counts = F.coalesce("bits", F.lit(0)), F.coalesce("counts", F.array().cast("array<bigint>"))
        rank = F.bit_count(bits.bitwiseAND(below))
        was = (bits.bitwiseAND(bit) != 0).cast("int")
        own = F.when(F.col("_n").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("_n"))
        merged = both.select(
            F.coalesce("user_id", "_user").alias("user_id"),
            F.when(F.col("_n").isNull(), bits.bitwiseAND(F.bitwise_not(bit))).otherwise(bits.bitwiseOR(bit)).alias("bits"),
            F.concat(F.slice(counts, F.lit(1), rank), own, F.slice(counts, rank + was + 1, F.size(counts))).alias("counts"),
        ).where("bits <> 0")
        self._write(merged, self.table, name, days=self.block_days)

    # --- reading ----------------------------------------------------------------------------------

    def blocks(self) -> dict[int, dict]:
        """First day and slot of each block, in order."""
        return dict(sorted((int(name.removeprefix("block=")), slot) for name, slot in self._slots().items()))

    def _first_days(self, blocks: Iterable[tuple[int, dict]]) -> DataFrame:
        """Users and their first day, a row for each block."""
        found = self.spark.createDataFrame([], FIRST)
        for start, slot in blocks:
            lowest = F.col("bits").bitwiseAND(-F.col("bits"))
            first = F.lit(start) + F.bit_count(lowest - 1)
            found = found.unionByName(self._read(self.table, slot, STATE).select("user_id", first.cast("int").alias("first_day")))
        return found

    def _seen_before(self, start: int) -> DataFrame:
        """First days in the blocks before one; kept, and made anew only from where a block has changed since."""
        of = {day: slot["folders"] for day, slot in self.blocks().items() if day < start}
        if not of:
            return self.spark.createDataFrame([], FIRST)
        kept = {int(n.removeprefix("before=")): s for n, s in (commits.current(self.spark, self.minima) or {}).items()}

        def holds(day: int, slot: dict) -> bool:
            return day <= start and slot["of"] == {str(d): f for d, f in of.items() if d < day}

        from_ = max((day for day, slot in kept.items() if holds(day, slot)), default=None)
        if from_ == start:
            return self._read(self.minima, kept[start], FIRST)
        base = self._read(self.minima, kept.get(from_), FIRST)
        more = [(d, s) for d, s in self.blocks().items() if d < start and (from_ is None or d >= from_)]
        if more or from_ is None:
            merged = _least(base.unionByName(self._first_days(more)))
            self._write(merged, self.minima, f"before={start}", of={str(d): f for d, f in of.items()})
        else:
            return base
        return self._read(self.minima, (commits.current(self.spark, self.minima) or {})[f"before={start}"], FIRST)

    def first_seen(self) -> DataFrame:
        """user_id and the date of the user's first day ever."""
        blocks = self.blocks()
        if not blocks:
            return self.spark.createDataFrame([], "user_id string, first_date date")
        last = max(blocks)
        days = self._seen_before(last).unionByName(self._first_days([(last, blocks[last])]))
        return _least(days).select("user_id", F.date_from_unix_date("first_day").alias("first_date"))

    def user_days(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """user_id, activity_date, events, from the blocks between two dates, both included."""
        found = self.spark.createDataFrame([], "user_id string, activity_date date, events bigint")
        low = day_number(since) if since else None
        high = day_number(until) if until else None
        for start, slot in self.blocks().items():
            if (low is not None and start + self.block_days <= low) or (high is not None and start > high):
                continue
            places = F.filter(F.sequence(F.lit(0), F.lit(self.block_days - 1)), lambda i: F.getbit("bits", i) == 1)
            each = F.explode(F.arrays_zip(places.alias("place"), F.col("counts").alias("events")))
            rows = self._read(self.table, slot, STATE).select("user_id", each.alias("x")).select(
                "user_id", F.date_from_unix_date(F.lit(start) + F.col("x.place")).alias("activity_date"), "x.events")
            found = found.unionByName(rows)
        if since:
            found = found.where(F.col("activity_date") >= since)
        return found.where(F.col("activity_date") <= until) if until else found

    def retention(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """Cohort by day grid as `gold.user_retention`, with cohorts of first days ever; of the days between two dates if given.

        A cohort's size is the number of users first seen on its day, whether that day is in the grid or not.
        """
        first = self.first_seen().withColumnRenamed("first_date", "cohort_date")
        sizes = first.groupBy("cohort_date").agg(F.count("*").alias("cohort_size"))
        grid = self.user_days(since, until).join(first, "user_id").groupBy(
            "cohort_date", F.datediff("activity_date", "cohort_date").alias("days_since_cohort")
        ).agg(F.count("*").alias("active_users"), F.sum("events").alias("total_events"))
        return grid.join(sizes, "cohort_date").select(
            "cohort_date", "days_since_cohort", "cohort_size", "active_users",
            measures.percent("active_users", "cohort_size").alias("retention_rate_pct"), "total_events")


def _least(days: DataFrame) -> DataFrame:
    return days.groupBy("user_id").agg(F.min("first_day").alias("first_day"))
