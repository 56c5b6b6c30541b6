"""Column expressions and frame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import cut_lineage

#: What separates words: space and 0x09-0x0D.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """A-Z as a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once for each row.

    A plain column would be put into every lambda that names it and be computed there again
    for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame doesn't have, as close to the given ones as can be."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows of a few numbers each; beyond that a join shuffles both sides.
SMALL_ROWS = 2_000_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The frame, materialised, for the narrow side of a join: broadcast if its count allows."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= rows else df


def ranked(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """Adds the gapless position, from 0, of each row in the given order.

    Spark sorts by ranges; a row's place in its partition plus the rows of the partitions
    before it is its rank. Only the partition sizes meet in one task.
    """
    at, block, start = fresh(df, "_at", "_block", "_start")
    placed = cut_lineage(df.sort(*order).withColumn(at, F.monotonically_increasing_id()))
    placed = placed.withColumn(block, F.shiftright(at, 33))
    sizes = placed.groupBy(block).agg(F.count("*").alias("n"))
    starts = sizes.selectExpr(
        f"`{block}`", f"sum(n) over (order by `{block}`) - n as `{start}`"
    )
    return placed.join(F.broadcast(starts), block).withColumn(
        name, F.col(start) + F.col(at).bitwiseAND((1 << 33) - 1)
    ).drop(at, block, start)
