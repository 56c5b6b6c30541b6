"""Projections: schema alignment, renames, audit columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions.temporal import parse_timestamp, processing_day
from shoreline.schemas import Columns, ddl


def empty(spark: SparkSession, columns: Columns) -> DataFrame:
    """Zero rows with the given columns."""
    return spark.createDataFrame([], ddl(columns))


def align(df: DataFrame, target: Columns, **given: str) -> DataFrame:
    """Project to the target columns, in order.

    ``given`` holds SQL expressions that override a column; a column the frame lacks
    becomes a typed NULL.
    """
    known = set(df.columns)

    def pick(name: str, dtype: str) -> str:
        if name in given:
            return f"{given[name]} AS `{name}`"
        return f"`{name}`" if name in known else f"CAST(NULL AS {dtype}) AS `{name}`"

    return df.selectExpr(*[pick(name, dtype) for name, dtype in target.items()])


def conform(df: DataFrame, target: Columns) -> DataFrame:
    """Align and cast to the declared types; a value that does not fit becomes NULL."""
    casts = [f"try_cast(`{n}` AS {storage_type(t)}) AS `{n}`" for n, t in target.items()]
    return align(df, target).selectExpr(*casts)


def storage_type(dtype: str) -> str:
    """In-memory type of a declared type; the length of a varchar is checked by the contract."""
    return "string" if dtype.startswith("varchar") else dtype


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project to an ordered list, leaving out the names the frame lacks."""
    return df.select(*[n for n in names if n in df.columns])


def rename_if_free(df: DataFrame, old: str, new: str) -> DataFrame:
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def cast_times(df: DataFrame, columns: Sequence[str] = ("timestamp", "_ingested_at")) -> DataFrame:
    """Parse the time columns that still are text."""
    textual = {name for name, dtype in df.dtypes if dtype == "string"}
    return df.withColumns({c: parse_timestamp(c) for c in columns if c in textual})


def stack_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing on one side is NULL there."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def stamp(df: DataFrame, date: str, audit: str = "_processed_at") -> DataFrame:
    """Audit time and partition date."""
    return df.withColumns({audit: F.current_timestamp(), "dt": processing_day(date)})


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.round(name, scale) for name, scale in digits.items()})
