"""Importance resampling towards a target distribution.

Features are runs of one to N consecutive words, hashed into BUCKETS buckets. Counts over all documents and over all target texts
give a gain for each bucket, the rounded-down log of the smoothed probability ratio. A document's weight is the sum of its features'
gains; weight plus Gumbel noise from a hash of its id is its score, and the highest scores are drawn: a sample without
replacement with probabilities in proportion to the importance weights.

Texts of a batch are joined, with a sentinel byte that UTF-8 never holds between them. One regular expression pass finds all
words; a search of their positions among the document offsets tells whose they are, and runs whose ends differ in that
belong to no document. Counts and sums are one `bincount` each. Batches are worked on in parts of PART bytes.

Counting scans the texts once; a task returns one row for each bucket it saw. Scoring scans them again with the gains, a table
of BUCKETS numbers whatever the input. Only ids and scores are sorted, in ranges, for the ranks.

A null or empty text has no features, weight 0 and, with too few words, no rank. Rows that repeat an id share the noise, each with its own
weight; equal rows get ranks of their own, but `resampled` keeps all that equal the last one drawn. A null id is hashed as the word null and comes after others of the same score.
No target text makes every bucket equally likely in the target; an empty table gives an empty result.
Columns of any name pass through `resampled`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import fresh, ranked
from shoreline.session import cut_lineage

N = 1
BUCKETS = 10_000
SEED = 2024
#: Documents with fewer words are not drawn; of the others this percentage is.
LEAST_WORDS, PERCENT = 20, 10
#: Bytes of text that are joined; a longer text is joined with none.
PART = 4 << 20
SENTINEL = b"\xff"
#: Lower-cased text: everything but ASCII other than digits and a-z, and not the sentinel.
WORD = re.compile(rb"[0-9a-z\x80-\xfe]+")


def _joined(texts: pa.Array, size: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """Lower-case bytes of runs of texts, a sentinel after each, and where each text begins."""
    held, begins, at = [], [], 0
    for value in texts.cast(pa.large_binary()):
        data = value.as_py() or b""
        if held and at + len(data) > size:
            yield b"".join(held).lower(), np.array(begins)
            held, begins, at = [], [], 0
        held += (data, SENTINEL)
        begins.append(at)
        at += len(data) + 1
    if held:
        yield b"".join(held).lower(), np.array(begins)


def features(joined: bytes, begins: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each document; document and bucket of each feature."""
    found = np.fromiter(
        ((m.start(), m.end(), crc32(m.group())) for m in WORD.finditer(joined)),
        np.dtype([("start", "i8"), ("end", "i8"), ("hash", "u4")]))
    of = np.searchsorted(begins, found["start"], "right") - 1
    words = np.bincount(of, minlength=len(begins))
    docs, hashed = [of], [found["hash"]]
    run = found["hash"]
    for more in range(1, n):
        # longer by a blank and the next word; a checksum goes on where it ended
        following = zip(run[:-1].tolist(), found["start"][more:].tolist(), found["end"][more:].tolist())
        run = np.fromiter((crc32(joined[a:b], crc32(b" ", h)) for h, a, b in following), np.uint32)
        own = of[more:] == of[:len(of) - more]
        docs.append(of[more:][own])
        hashed.append(run[own])
    return words, np.concatenate(docs), (np.concatenate(hashed) % buckets).astype(np.int64)


def bucket_counts(texts: DataFrame, *, text: str = "text", n: int = N, buckets: int = BUCKETS, part: int = PART) -> DataFrame:
    """(bucket, features) over all texts; a task sends one row for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for joined, begins in _joined(batch.column(0), part):
                total += np.bincount(features(joined, begins, n, buckets)[2], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "features"])

    counted = texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "bucket long, features long")
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def _totals(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():
        out[row.bucket] = row.features
    return out


def gains(docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text", n: int = N, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket; BUCKETS rows from each side reach the driver."""
    s = _totals(bucket_counts(docs, text=text, n=n, buckets=buckets), buckets)
    t = _totals(bucket_counts(target, text=target_text, n=n, buckets=buckets), buckets)
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return [math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s.tolist(), t.tolist())]


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def weighed(docs: DataFrame, gain: list[int], *, text: str = "text", n: int = N, part: int = PART) -> DataFrame:
    """`docs` with n_words, n_features and weight."""
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.float64))

    @F.arrow_udf("words bigint, features bigint, weight bigint")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for texts in batches:
            parts = [[np.zeros(0, np.int64)] * 3]
            for joined, begins in _joined(texts, part):
                words, of, bucket = features(joined, begins, n, len(table))
                # whole numbers below 2^53: the sums are exact
                weight = np.bincount(of, table[bucket], len(begins)).astype(np.int64)
                parts.append([words, np.bincount(of, minlength=len(begins)), weight])
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)]
            yield pa.StructArray.from_arrays(columns, ["words", "features", "weight"])

    said, *names = fresh(docs, "_said", "n_words", "n_features", "weight")
    given = docs.withColumn(said, weigh(F.col(f"`{text}`").cast("string")))
    return given.withColumns({x: F.col(f"{said}.{y}") for x, y in zip(names, ("words", "features", "weight"))}).drop(said)


def _scores(docs: DataFrame, gain: list[int], doc_id: str, text: str, n: int, seed: int) -> DataFrame:
    """n_words, n_features, weight, score and key (hash of the text) added to `docs`, under names it doesn't have."""
    words, features, weight, score, key = _names(docs)
    return weighed(docs, gain, text=text, n=n).withColumns({
        score: F.col(weight) + noise(F.col(f"`{doc_id}`"), seed), key: F.xxhash64(F.col(f"`{text}`"))})


def _names(docs: DataFrame) -> list[str]:
    return fresh(docs, "n_words", "n_features", "weight", "score", "text_key")


def _drawn(docs: DataFrame, gain: list[int], doc_id: str, text: str, n: int, least_words: int, percent: int, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """Documents with enough words by rank, from 0; the others; and how many are drawn."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = _scores(given, gain, "doc_id", "text", n, seed).drop("text")
    # the serial number splits rows that are equal in all else among the ranges of the sort
    rows = cut_lineage(rows).withColumn("_serial", F.monotonically_increasing_id())
    able = rows.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_key"), F.asc("_serial")]
    return ranked(able, *order, name="_rank"), rows.where(F.col("n_words") < least_words), percent * able.count() // 100


def scored(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    n: int = N, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank, n_words, text_key for each document; rank is null where it isn't drawn."""
    gain = gains(docs, target, text=text, target_text=target_text, n=n, buckets=buckets)
    able, few, drawn = _drawn(docs, gain, doc_id, text, n, least_words, percent, seed)
    rank = F.when(F.col("_rank") < drawn, F.col("_rank") + 1)
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words", "text_key"]
    return able.withColumn("rank", rank).select(*columns).unionByName(
        few.withColumn("rank", F.lit(None).cast("long")).select(*columns))


def resampled(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    n: int = N, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """The documents that are drawn, unchanged. No text is shuffled: the last drawn row says which others are.
    Rows equal to it in id and text all stay."""
    gain = gains(docs, target, text=text, target_text=target_text, n=n, buckets=buckets)
    able, _, drawn = _drawn(docs, gain, doc_id, text, n, least_words, percent, seed)
    last = able.where(F.col("_rank") == drawn - 1).first()
    if last is None:
        return docs.where(F.lit(False))
    words, _, _, score, key = _names(docs)
    here = F.col(f"`{doc_id}`")
    upto = F.col(key) <= last.text_key
    if last.doc_id is None:
        tie = here.isNotNull() | upto
    else:
        tie = F.coalesce((here < F.lit(last.doc_id)) | ((here == F.lit(last.doc_id)) & upto), F.lit(False))
    taken = (F.col(score) > last.score) | ((F.col(score) == last.score) & tie)
    rows = _scores(docs, gain, doc_id, text, n, seed).where((F.col(words) >= least_words) & taken)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
