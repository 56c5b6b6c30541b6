"""Batch drops: CSV files with a header, JSON files holding one array each."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.operators.envelope import BATCH_HOUR, CORRUPT, batch_rows
from shoreline.schemas import BATCH_SOURCES, PAYLOADS, ddl
from shoreline.session import UNSORTED_WRITES, with_settings
from shoreline.sources.lake import Lake, replace_raw_batch


def _schema(source: str) -> str:
    return ddl({**PAYLOADS[source], CORRUPT: "string"})


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file_path"))


def read_csv_drop(spark: SparkSession, path: str, source: str) -> DataFrame:
    """CSV drop with declared types, in the column order of the file contract."""
    reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", CORRUPT)
    return _with_file(reader.schema(_schema(source)).csv(path))


def read_json_drop(spark: SparkSession, path: str, source: str) -> DataFrame:
    """JSON-array drop, nested structs included. A file is read by one task, so large
    drops should come as many files."""
    reader = spark.read.option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT)
    return _with_file(reader.schema(_schema(source)).json(path))


def read_drop(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A drop with its file path and, for records that do not parse, their text."""
    read = read_csv_drop if BATCH_SOURCES[source] == "csv" else read_json_drop
    return read(spark, path, source)


def drop_batch(path: str) -> str:
    """Name of the batch of a drop: drops of one day don't meet, the same drop does."""
    return f"drop-{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def land_drop(
    spark: SparkSession, path: str, source: str, lake: Lake, date: str, drop_id: str | None = None
) -> None:
    """Land one drop in the raw layer under its processing date.

    A drop is known by its path, or by ``drop_id``. Landing it again replaces its rows, good and
    bad; other drops of the day stay.
    """
    # the rows of a drop go to two folders, one for each zone
    drop = read_drop(with_settings(spark, **UNSORTED_WRITES), path, source)
    rows = batch_rows(drop, source, date)
    batch = f"drop-{drop_id}" if drop_id else drop_batch(path)
    replace_raw_batch(rows, lake, source, date, BATCH_HOUR, batch)
