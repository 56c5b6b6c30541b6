"""Exact token counts for every context limit, from a histogram of encoded lengths.

Each document is encoded whole; only its length leaves the task. Documents are counted by
length, and sums from the long end answer, for each length as a limit: how many documents
and tokens reach it, and how many tokens are left if every document is cut there. The sums
run in blocks of BLOCK lengths; the few block totals are added first, so no task sorts all
lengths.

A long text is encoded in parts that end before a space between letters, where the
tokenizer's own pattern always ends a piece, so the lengths add up exactly. A null text has
length 0, like an empty one. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.session import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PART = 20_000
BLOCK = 4_096


def load(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


SEAM = regex.compile(r"(?<=\p{L})(?= \p{L})")


def parts(text: str, size: int = PART) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        seam = SEAM.search(text, at + size)
        if seam is None:
            break
        yield text[at:seam.start()]
        at = seam.start()
    yield text[at:]


def encoded_length(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of each text. The vocabulary file is read by the executors, once a task."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = load(vocabulary)
        for texts in batches:
            yield pd.Series([
                sum(len(encoding.encode_ordinary(p)) for p in parts(t)) if t else 0 for t in texts
            ], dtype="int64")

    return count(text.cast("string"))


def histogram(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """length, docs."""
    return docs.select(encoded_length(F.col(text), vocabulary).alias("length")).groupBy("length").agg(
        F.count("*").alias("docs"))


def by_limit(lengths: DataFrame) -> DataFrame:
    """length, docs, docs_from and tokens_from (of documents with that length or more), docs_to (with that length or less) and
    tokens_cut (all tokens if documents are cut at that length)."""
    lengths = cut_lineage(lengths.withColumn("block", F.floor(F.col("length") / BLOCK)))
    blocks = lengths.groupBy("block").agg(
        F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("length")).alias("t"))
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    # a row for each BLOCK lengths
    blocks = blocks.select(
        "block", F.col("d").alias("own_d"), F.col("t").alias("own_t"), F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("t"),
    )
    every = Window.partitionBy(F.lit(0))
    blocks = blocks.withColumns({"all_docs": F.max(F.col("d") + F.col("own_d")).over(every), "all_tokens": F.max(F.col("t") + F.col("own_t")).over(every)})
    own = Window.partitionBy("block").orderBy(F.desc("length"))
    out = lengths.join(blocks, "block")
    docs_from = F.sum("docs").over(own) + F.col("d")
    tokens_from = F.sum(F.col("docs") * F.col("length")).over(own) + F.col("t")
    out = out.withColumns({"docs_from": docs_from, "tokens_from": tokens_from})
    return out.select(
        "length", "docs", "docs_from", "tokens_from",
        (F.col("all_docs") - F.col("docs_from") + F.col("docs")).alias("docs_to"),
        (F.col("all_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("length")).alias("tokens_cut"),
    )


def quantile(limits: DataFrame, share: float) -> int | None:
    """The least length that at least `share` of the documents don't exceed."""
    total = F.col("docs_to") + F.col("docs_from") - F.col("docs")
    return limits.where(F.col("docs_to") >= total * share).agg(F.min("length")).first()[0]
