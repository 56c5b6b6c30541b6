"""Mixing sources to target weights.

Tokens are summed for each source; the mix takes as many tokens as there are, shared by
weight, and no source more than `cap` times over: what exceeds that is shared again among
the others. A source's rate is its target over its size. Each document comes floor(rate)
times, and once more if its draw is below the rest of the rate. The draw is a hash of seed
and document id, so a rerun takes the same copies.

Null and empty texts have size 0 and are repeated like others. A null source is a source.
Rows with the same id share their draw. An empty table gives an empty result. Columns of
any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.text import fresh, ranked, small_side, words_of
from shoreline.session import cut_lineage

WEIGHTS = (1, 2, 3)
CAP = 3


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) to (source, source_size, target, rate).

    Sources in code point order, null last, take the weights in turn. Each round shares
    what is left among the sources below their cap, over the small table of sources, until
    none exceeds it.
    """
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights)).cast("int") + 1)
    ranks = ranked(sizes, F.asc_nulls_last("source"), name="_rank")
    table = cut_lineage(ranks.select("source", "source_size", turn.cast("long").alias("_weight")))
    most = (F.col("source_size") * cap).cast("decimal(38,0)")
    capped, before = F.lit(False), -1
    while True:
        row = table.select("_weight", most.alias("_most"), capped.alias("_capped")).agg(
            F.sum(F.col("_most") / cap).cast("decimal(38,0)").alias("total"),
            F.sum(F.when(F.col("_capped"), F.col("_most"))).alias("fixed"),
            F.sum(F.when(~F.col("_capped"), F.col("_weight"))).alias("weight"),
            F.count_if("_capped").alias("n"),
        ).first()
        left = int(row.total or 0) - int(row.fixed or 0)
        weight = int(row.weight or 1)
        if row.n == before:
            break
        before = row.n
        share = (F.col("_weight").cast("decimal(38,0)") * F.lit(left).cast("decimal(38,0)"))
        capped = most * F.lit(weight).cast("decimal(38,0)") < share
    target = F.when(capped, most.cast("double")).otherwise(
        (F.col("_weight") * F.lit(left)).cast("double") / F.lit(weight).cast("double")
    )
    return table.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def copies(rate: Column, doc_id: Column, seed: int = 0) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(doc_id, seed) < rate - whole).cast("long")).cast("long")


def mixed_counts(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, cap: int = CAP, seed: int = 0,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for each document; one scan of the texts."""
    sized = cut_lineage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    ))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    targets = targets.withColumnRenamed("source", "_source")
    return sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target",
        (copies(F.col("rate"), F.col("doc_id"), seed) * F.col("size")).alias("taken"), "source",
    )


def mix_sources(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, cap: int = CAP, seed: int = 0,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of `docs`."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(word_count(F.col(text))).alias("source_size"))
    here, rate, nth = fresh(docs, "_source", "_rate", "_nth")
    rates = small_side(source_targets(sizes, weights, cap).select(F.col("source").alias(here), F.col("rate").alias(rate)))
    out = docs.join(rates, docs[source].eqNullSafe(F.col(here)))
    repeat = F.array_repeat(F.lit(1), copies(F.col(rate), F.col(doc_id), seed).cast("int"))
    return out.withColumn(nth, F.explode(repeat)).select(*[F.col(f"`{c}`") for c in docs.columns])
