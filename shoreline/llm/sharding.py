"""Sharding by sampled splitters, near equal in bytes.

A record's key is a 64-bit hash of its text, so equal texts are neighbours. Its weight is its
size plus the mean size: ranges of equal weight are bounded in bytes and in rows, also where
texts are tiny. Key samples are drawn with probability proportional to weight; their weighted
quantiles cut the keys into many more ranges than shards. Ranges that turn out overfull are
sampled again and subdivided until they are small or hold one key. A range of one key that is
still overfull is split by document id into parts, so that no task numbers more than a few
means of rows. The parts stay in one shard unless their bytes exceed a shard's share. Ranges,
heaviest first, go to the lightest shard: shards differ by less than a range, and equal texts
stay together unless they don't fit.

Only the samples (SAMPLES a range), added up by key, and one row a range or part reach the
driver, however long the records are. Slots count rows within a shard, by range, part, key and
id; each part is numbered by itself. Rows that equal in id and text share a part.

A null text has size 1, like an empty one. A null id is a value like others. Rows that repeat
get slots of their own. A very long text is one record, read for its size and hash only. Other
columns pass through, also if they are named like the new ones, which then get an underscore.
An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.text import fresh
from shoreline.session import cut_lineage

SHARDS = 8
RANGES_PER_SHARD = 64
ROWS_PER_RANGE = 1_000_000
SAMPLES = 64
#: A range is overfull above so many times the mean.
OVERFULL = 2


class Plan(NamedTuple):
    #: Lower bounds of the ranges but the first.
    splitters: np.ndarray
    #: (range, the shard of each part, the first slot of each part); most ranges have one part
    ranges: list[tuple[int, list[int], list[int]]]


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def key_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _draw(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def in_range(key: Column, splitters: np.ndarray) -> Column:
    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, keys.to_numpy(), side="right").astype(np.int32))

    return find(key)


def _splitters(records: DataFrame, total: float, ranges: int) -> np.ndarray:
    """Weighted quantiles of a sample drawn by weight."""
    step = max(total / (ranges * SAMPLES), 1.0)
    drawn = records.where(_draw(F.col("id").cast("string"), F.col("key"), F.lit(3)) * step < F.col("weight"))
    rows = drawn.groupBy("key").agg(F.sum(F.greatest("weight", F.lit(step))).alias("weight")).toArrow()
    key, weight = (rows.column(c).to_numpy() for c in ("key", "weight"))
    if not len(key):
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(key)
    reached = np.cumsum(weight[order])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, ranges) / ranges)
    return np.unique(key[order][at])


def plan(records: DataFrame, shards: int) -> Plan:
    """(id, key, size) to ranges and their shards."""
    row = records.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    if not row.rows:
        return Plan(np.zeros(0, dtype=np.int64), [])
    ranges = max(RANGES_PER_SHARD * shards, -(-row.rows // ROWS_PER_RANGE))
    records = records.withColumn("weight", F.col("size") + F.lit(row.bytes / row.rows))
    mean = 2 * row.bytes / ranges
    splitters = _splitters(records, 2 * row.bytes, ranges)
    while True:
        ranged = records.withColumn("range", in_range(F.col("key"), splitters))
        sums = ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.sum("weight").alias("weight"),
            F.min("key").alias("least"), F.max("key").alias("most"))
        found = sums.collect()
        over = [r for r in found if r.weight > OVERFULL * mean]
        wide = [r for r in over if r.least != r.most]
        if not wide:
            break
        inside = ranged.where(F.col("range").isin([r.range for r in wide]))
        weight = sum(r.weight for r in wide)
        more = _splitters(inside, weight, max(2 * len(wide), math.ceil(2 * weight / mean)))
        ends = np.array([x for r in wide for x in (r.least + 1, r.most)], dtype=np.int64)
        # a heavy key gets a range of its own, so that only its rows are kept together
        more = np.concatenate([more, more[more < np.iinfo(np.int64).max] + 1, ends])
        splitters = np.unique(np.concatenate([splitters, more]))
    parts = {r.range: [(r.rows, r.bytes)] for r in found}
    cut = [(r.range, int(r.weight // mean) + 1) for r in over]
    if cut:
        counts = ranged.sparkSession.createDataFrame(cut, "range int, parts int")
        sums = ranged.join(F.broadcast(counts), "range").groupBy("range", part_of(F.col("parts")).alias("part")).agg(
            F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        parts.update({at: [(0, 0)] * n for at, n in cut})
        for r in sums.collect():
            parts[r.range][r.part] = (r.rows, r.bytes)
    return Plan(splitters, dealt(parts, shards))


def dealt(parts: dict[int, list[tuple[int, int]]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """Rows and bytes of each range's parts to their shards and first slots."""
    total = sum(size for of in parts.values() for _, size in of)
    # (bytes, range, its parts from, to): a range is dealt whole unless it exceeds a shard's share
    pieces = []
    for at, of in parts.items():
        size = sum(p[1] for p in of)
        whole = size * shards <= total
        pieces += [(size, at, 0, len(of))] if whole else [(p[1], at, k, k + 1) for k, p in enumerate(of)]
    load = [(0, s) for s in range(shards)]
    shard = {at: [0] * len(of) for at, of in parts.items()}
    for size, at, begin, end in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        filled, own = heapq.heappop(load)
        shard[at][begin:end] = [own] * (end - begin)
        heapq.heappush(load, (filled + size, own))
    out, slots = [], [0] * shards
    for at in sorted(parts):
        first = []
        for own, (rows, _) in zip(shard[at], parts[at]):
            first.append(slots[own])
            slots[own] += rows
        out.append((at, shard[at], first))
    return out


def part_of(parts: Column) -> Column:
    """Which of its range's parts a record belongs to."""
    return F.floor(_draw(F.col("id").cast("string"), F.lit(9)) * parts).cast("int")


def placed(records: DataFrame, made: Plan) -> DataFrame:
    """Adds shard and slot to a frame with id, key and size; other columns pass through."""
    of = records.sparkSession.createDataFrame(made.ranges, "range int, shards array<int>, firsts array<long>")
    out = records.withColumn("range", in_range(F.col("key"), made.splitters)).join(F.broadcast(of), "range")
    out = out.withColumn("part", part_of(F.size("shards"))).withColumns({
        "shard": F.get("shards", F.col("part")), "first": F.get("firsts", F.col("part"))}).drop("shards", "firsts")
    order = Window.partitionBy("range", "part").orderBy("key", "id")
    return out.withColumn("slot", (F.col("first") + F.row_number().over(order) - 1).cast("long")).drop("range", "part", "first")


def shard_rows(docs: DataFrame, *, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; the texts are read once and not moved."""
    t = F.col(text)
    records = cut_lineage(docs.select(
        F.col(doc_id).alias("id"), key_of(t).alias("key"), size_of(t).alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
    ))
    return placed(records, plan(records, shards)).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded(docs: DataFrame, *, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with shard and slot, each range of them in one partition."""
    shard, slot = fresh(docs, "shard", "slot")
    packed = docs.select(
        F.col(doc_id).alias("id"), key_of(F.col(text)).alias("key"), size_of(F.col(text)).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    made = plan(cut_lineage(packed.select("id", "key", "size")), shards)
    return placed(packed, made).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("shard").alias(shard), F.col("slot").alias(slot))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Writes a folder for each shard."""
    out = sharded(docs, **options)
    out.write.partitionBy(out.columns[-2]).parquet(path)
