"""Lake layout, partition scans and partition writes.

    <lake>/raw/zone=bronze/source=<s>/dt=<d>/hour=<h>/batch=<b>/part-*
    <lake>/raw/zone=dead_letter/source=<s>/dt=<d>/hour=<h>/batch=<b>/part-*
    <lake>/silver/domain=<domain>/...
    <lake>/gold/kpi=<kpi>/...

Tables in the wide form lie beside those in silver_wide and gold_wide.

Each date of a table, and each batch that was landed again or rolled, is one version folder named by the last commit
(`commits`); readers here follow it. Micro-batches of a stream and dates that were written in the plain layout
(dt=<d>/part-*) count as long as no commit names them.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.operators.shape import empty, storage_type
from shoreline.session import MB, with_settings
from shoreline.sources import commits
from shoreline.sources.commits import Folder

#: Marks of the batches that are whole.
LANDED = "_landed"
RAW_PARTITIONS = ["zone", "source", "dt", "hour", "batch"]
# Upper bound of rows per raw file; about 128 MB at a few hundred bytes per record.
RAW_ROWS_PER_FILE = 400_000
# Bytes of compressed lines that a task reads; unpacked they are about ten times as many.
PACKED_BYTES = 16 * MB
PACKED = ".gz"


@dataclass(frozen=True)
class Lake:
    """Paths of one lake."""

    root: str
    form: str = ""

    @property
    def wide(self) -> Lake:
        """The same lake with the tables in the wide form; the raw layer is shared."""
        return replace(self, form="_wide")

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    def raw_log(self, source: str, date: str) -> str:
        """Where the commits of a source's date lie; versions are folders of the raw layer."""
        return f"{self.raw}/{commits.LOG}/source={source}/dt={date}"

    def raw_zone(self, zone: str, source: str) -> str:
        return f"{self.raw}/zone={zone}/source={source}"

    def bronze(self, source: str) -> str:
        return self.raw_zone("bronze", source)

    def dead_letter(self, source: str) -> str:
        return self.raw_zone("dead_letter", source)

    def domain(self, name: str) -> str:
        return f"{self.root}/silver{self.form}/domain={name}"

    def kpi(self, name: str) -> str:
        return f"{self.root}/gold{self.form}/kpi={name}"


def _load_or_none(reader: DataFrameReader, fmt: str, path: str | list[str]) -> DataFrame | None:
    """Load a path; ``None`` when it or any file in it is missing. Other failures are raised."""
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        # the second one: a table folder into which only empty frames were written
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# --- raw layer -------------------------------------------------------------------


def raw_folders(spark: SparkSession, lake: Lake, zone: str, source: str, date: str) -> list[str] | None:
    """Folders of one zone, source and date that count, relative to the raw layer; None where no commit says
    so and the date's folder counts as it is."""
    slots = commits.current(spark, lake.raw_log(source, date))
    if slots is None:
        return None
    at = f"zone={zone}/source={source}/dt={date}"
    plain = [p for p in Folder(spark, lake.raw).glob(f"{at}/hour=*/batch=*") if slot_of(p) not in slots]
    return plain + [f for f in commits.folders_of(slots) if f"/{at}/" in f]


def raw_inputs(spark: SparkSession, lake: Lake, source: str, date: str) -> list[str]:
    """What a source's date is made of: its batches as they were landed, whether they were rolled since or not.
    A drop that was landed again counts as another one."""
    slots = commits.current(spark, lake.raw_log(source, date)) or {}
    plain = Folder(spark, lake.raw).glob(f"zone=*/source={source}/dt={date}/hour=*/batch=*")
    loose = {slot_of(p) for p in plain} - set(slots)
    return sorted(loose.union(*(slot.get("of", ()) for slot in slots.values())))


def slot_of(folder: str) -> str:
    """The slot of a batch folder: its hour and batch, in both zones."""
    return "/".join(folder.split("/")[-2:])


def _read_zone(
    spark: SparkSession, lake: Lake, zone: str, source: str, date: str, schema: str
) -> DataFrame | None:
    folders = raw_folders(spark, lake, zone, source, date)

    def load(session: SparkSession) -> DataFrame | None:
        reader = session.read.schema(schema)
        if folders is None:
            at = lake.raw_zone(zone, source)
            return _load_or_none(reader.option("basePath", at), "json", f"{at}/dt={date}")
        if not folders:
            return None
        return _load_or_none(reader, "json", [f"{lake.raw}/{f}" for f in folders])

    found = load(spark)
    if found is None or not any(name.endswith(PACKED) for name in found.inputFiles()):
        return found
    # tasks are filled by stored bytes; fewer of these keep a task's lines as many as without compression
    return load(with_settings(spark, **{"spark.sql.files.maxPartitionBytes": str(PACKED_BYTES)}))


def read_raw(
    spark: SparkSession,
    lake: Lake,
    source: str,
    date: str,
    columns: list[str] | None = None,
) -> DataFrame | None:
    """Rows of one source and date with their declared types; ``None`` without data.

    Only the files of that date are listed, and only the named fields are parsed.
    """
    known = schemas.raw_columns(source)
    wanted = {name: known[name] for name in (columns or known)}
    found = _read_zone(spark, lake, "bronze", source, date, schemas.ddl(wanted))
    return None if found is None else found.select(*wanted)


def read_raw_or_empty(
    spark: SparkSession,
    lake: Lake,
    source: str,
    date: str,
    columns: list[str] | None = None,
) -> DataFrame:
    known = schemas.raw_columns(source)
    found = read_raw(spark, lake, source, date, columns)
    return found if found is not None else empty(spark, {n: known[n] for n in (columns or known)})


def raw_lines(
    spark: SparkSession, lake: Lake, source: str, dates: list[str], zone: str = "bronze"
) -> DataFrame | None:
    """Lines of a zone's dates that count, as ``value`` and ``dt``; ``None`` without any folder."""
    folders = []
    for date in dates:
        found = raw_folders(spark, lake, zone, source, date)
        at = f"zone={zone}/source={source}/dt={date}"
        folders += ([at] if Folder(spark, lake.raw).exists(at) else []) if found is None else found
    if not folders:
        return None
    lines = spark.read.option("recursiveFileLookup", True).text([f"{lake.raw}/{f}" for f in folders])
    return lines.select("value", F.regexp_extract(F.input_file_name(), r"/dt=([^/]+)/", 1).alias("dt"))


def field_types(lines: DataFrame) -> DataFrame:
    """dt, field, type, rows of JSON lines (``value``, ``dt``): the type that holds all values of a field on a date.

    One scan: each line is parsed once, its fields are reduced per task to a type each. Values of types that
    nothing holds together make a VARIANT; lines that are no objects have no fields.
    """
    parsed = lines.select("dt", F.try_parse_json("value").alias("_line"))
    each = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_line").outer()))
    return each.where(F.col("key").isNotNull()).groupBy("dt", F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("rows"))


def type_conflicts(types: DataFrame) -> DataFrame:
    """field, type, first_date, last_date, dates of the fields that have more than one type, whether on one date or over
    dates. NULL alone (VOID) fits every type."""
    known = types.where("type <> 'VOID'").groupBy("field", "type").agg(
        F.min("dt").alias("first_date"), F.max("dt").alias("last_date"), F.count("*").alias("dates"))
    several = F.count("*").over(Window.partitionBy("field")) > 1
    return known.withColumn("_odd", several | (F.col("type") == "VARIANT")).where("_odd").drop("_odd")


def _column_type(types: list[str]) -> str:
    """The column type for the types that a field has over the dates."""
    def stored(name: str) -> str:
        # whole numbers beyond a long stay exact, other numbers are doubles
        name = re.sub(r"DECIMAL\((\d+),\s*(\d+)\)", lambda m: m[0] if m[2] == "0" else "DOUBLE", name)
        return name.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")

    found = {stored(t) for t in types if t != "VOID"}
    if found <= {"BIGINT", "DOUBLE"} and len(found) == 2:
        return "DOUBLE"
    return found.pop() if len(found) == 1 else "VARIANT" if found else "STRING"


def read_raw_inferred(spark: SparkSession, lake: Lake, source: str, date: str) -> DataFrame | None:
    """Same rows with the schema taken from all of the data, by `field_types`. A field whose values have types that nothing
    holds together is a VARIANT, so no value is lost."""
    lines = raw_lines(spark, lake, source, [date])
    if lines is None:
        return None
    found: dict[str, list[str]] = {}
    for row in field_types(lines).collect():
        found.setdefault(row.field, []).append(row.type)
    schema = ", ".join(f"`{field.replace('`', '``')}` {_column_type(types)}" for field, types in sorted(found.items()))
    return _read_zone(spark, lake, "bronze", source, date, schema) if schema else None


def read_product_orders(spark: SparkSession, lake: Lake, date: str) -> DataFrame:
    """Orders with the few columns the product view needs."""
    arrival = ["_file_path", "_source", "_ingested_at"]
    return read_raw_or_empty(
        spark, lake, "orders", date, schemas.PRODUCT_ORDER_COLUMNS + arrival
    )


def write_raw(rows: DataFrame, lake: Lake, batch: str, packed: bool = False) -> None:
    """Land JSON lines (``value`` plus the partition columns) under a batch name.

    Landing the same batch again replaces exactly that batch, so a retried
    micro-batch leaves no second copy. A mark says that it is whole; only then may it be rolled. ``packed`` is for
    batches that fill files: these are gzip files, which the row limit keeps small, and are not rolled.
    """
    (
        rows.withColumn("batch", F.lit(batch))
        .select("value", *RAW_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", RAW_ROWS_PER_FILE)
        .option("compression", "gzip" if packed else "none")
        .partitionBy(*RAW_PARTITIONS)
        .text(lake.raw)
    )
    Folder(rows.sparkSession, f"{lake.raw}/{LANDED}").create(batch, "")


def replace_raw_batch(rows: DataFrame, lake: Lake, source: str, date: str, hour: str, batch: str) -> None:
    """Land lines (``value``, ``zone``) of one source and hour as one batch, in place of all rows
    it had in either zone. One job writes both zones; one commit then puts them in place, so a failure
    leaves the batch as it was."""
    version = commits.new_version()
    _write_lines(rows.withColumns({
        "source": F.lit(source), "dt": F.lit(date), "hour": F.lit(hour), "batch": F.lit(batch),
    }), f"{lake.raw}/{version}")
    slot = f"hour={hour}/batch={batch}"
    commits.commit(rows.sparkSession, lake.raw_log(source, date), {
        slot: {"folders": written_batches(rows.sparkSession, lake, version), "of": [f"{slot}@{version}"]}})


def _write_lines(rows: DataFrame, path: str) -> None:
    lines = rows.select("value", *RAW_PARTITIONS).write.option("maxRecordsPerFile", RAW_ROWS_PER_FILE)
    lines.partitionBy(*RAW_PARTITIONS).text(path)


def written_batches(spark: SparkSession, lake: Lake, version: str) -> list[str]:
    """The batch folders of one version, relative to the raw layer."""
    return Folder(spark, lake.raw).glob(f"{version}/zone=*/source=*/dt=*/hour=*/batch=*")


DEAD_LETTER: schemas.Columns = {
    "_raw": "string",
    "_error_reason": "string",
    "_error_ts": "timestamp",
    "_kafka_topic": "string",
    "_kafka_partition": "int",
    "_kafka_offset": "bigint",
    "_file_path": "string",
}


def raw_dates(spark: SparkSession, lake: Lake, source: str, zone: str = "bronze") -> list[str]:
    """Dates of a source that have or had rows, from folder names."""
    folder = Folder(spark, lake.raw)
    found = folder.names(f"zone={zone}/source={source}") + folder.names(f"{commits.LOG}/source={source}")
    return sorted({name.removeprefix("dt=") for name in found if name.startswith("dt=")})


def read_dead_letter(spark: SparkSession, lake: Lake, source: str) -> DataFrame | None:
    """All dead letters of a source; ``None`` for a source without any date."""
    folders = []
    for date in raw_dates(spark, lake, source, "dead_letter"):
        found = raw_folders(spark, lake, "dead_letter", source, date)
        folders += [f"zone=dead_letter/source={source}/dt={date}"] if found is None else found
    if not folders:
        known = Folder(spark, lake.raw).names(f"{commits.LOG}/source={source}")
        return empty(spark, DEAD_LETTER) if known else None
    reader = spark.read.schema(schemas.ddl(DEAD_LETTER))
    found = _load_or_none(reader, "json", [f"{lake.raw}/{f}" for f in folders])
    return None if found is None else found.select(*DEAD_LETTER)


# --- table layers -----------------------------------------------------------------


def write_table(df: DataFrame, path: str, sort_by: list[str] | None = None) -> None:
    """Replace the dates present in ``df``, all at once; all other dates stay as they are."""
    version = commits.new_version()
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.option("compression", "snappy").partitionBy("dt").parquet(f"{path}/{version}")
    table = Folder(df.sparkSession, path)
    dates = [name for name in table.names(version) if name.startswith("dt=")]
    for date in dates:
        table.move(f"{version}/{date}", f"{date}/{version}")
    commits.commit(df.sparkSession, path, {d: {"folders": [f"{d}/{version}"]} for d in dates})
    table.delete(version)


def write_date(
    df: DataFrame, path: str, date: str, sort_by: list[str] | None = None,
    notes: Callable[[], dict] | None = None,
) -> None:
    """Replace one date by the rows of ``df``, which are all of that date; no rows empty it.

    The old rows count until the new ones are written whole. ``notes`` are asked for then and kept with the date.
    """
    at = f"dt={date}/{commits.new_version()}"
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.drop("dt").write.option("compression", "snappy").parquet(f"{path}/{at}")
    commits.commit(df.sparkSession, path, {
        f"dt={date}": {**(notes() if notes else {}), "folders": [at]}})


def notes_of(spark: SparkSession, path: str, date: str) -> dict | None:
    """What was noted when the date was written; None for a date that no commit names."""
    return (commits.current(spark, path) or {}).get(f"dt={date}")


def clear_date(spark: SparkSession, path: str, date: str) -> None:
    """Leave no rows of a date, if the table has that date."""
    found = read_partition(spark, path, date)
    if found is not None:
        write_date(spark.createDataFrame([], found.schema), path, date)


class Footers(NamedTuple):
    """What is known of dates of a table without reading a row: rows by date as a frame, columns, the latest audit time in
    microseconds."""

    counts: DataFrame
    columns: list[str]
    latest: int | None


def read_footers(spark: SparkSession, path: str, date: str | None = None) -> Footers | None:
    """All dates of a table or one; ``None`` unless each was written with its audit time noted.

    The count is answered by the files' footers: the scan gets the aggregation and reads no column.
    """
    slots = commits.current(spark, path) or {}
    chosen = slots if date is None else {k: v for k, v in slots.items() if k == f"dt={date}"}
    plain = [d for d in Folder(spark, path).names() if d.startswith("dt=") and d not in slots] if date is None else []
    if not chosen or plain or any("latest" not in slot for slot in chosen.values()):
        return None
    footers = spark.newSession()
    # only this reader of Parquet files hands aggregations down
    others = [f for f in footers.conf.get("spark.sql.sources.useV1SourceList").split(",") if f != "parquet"]
    footers.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = footers.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in commits.folders_of(chosen)])
    latest = max((s["latest"] for s in chosen.values() if s["latest"] is not None), default=None)
    return Footers(found.groupBy("dt").agg(F.count("*").alias("row_count")), found.columns, latest)


class MissingColumns(ValueError):
    """Files that lack columns their readers need."""


def _check_columns(found: DataFrame, columns: schemas.Columns, path: str) -> None:
    absent = [name for name in columns if name not in found.columns]
    if absent:
        raise MissingColumns(f"{path} has no column {', '.join(absent)}")


def range_folders(spark: SparkSession, path: str, last_date: str, days: int = 1) -> list[str]:
    """Folders of the last ``days`` dates up to ``last_date`` that count."""
    last = datetime.date.fromisoformat(last_date)
    wanted = [f"dt={last - datetime.timedelta(days=n)}" for n in range(days)]
    slots = commits.current(spark, path) or {}
    table = Folder(spark, path)
    plain = [d for d in wanted if d not in slots and table.exists(d)]
    return [f"{path}/{d}" for d in commits.folders_of(slots, wanted) + plain]


def read_range(
    spark: SparkSession,
    path: str,
    last_date: str,
    days: int = 1,
    columns: schemas.Columns | None = None,
) -> DataFrame | None:
    """The last ``days`` dates up to ``last_date``. Only their folders are listed, however
    many dates the table has; absent dates are skipped. Files without one of the given columns
    are refused; one footer is read for that."""
    dates = range_folders(spark, path, last_date, days)
    if not dates:
        return None
    reader = spark.read.option("basePath", path)
    if columns:
        found = _load_or_none(reader, "parquet", dates)
        if found is None:
            return None
        _check_columns(found, columns, path)
        reader = reader.schema(schemas.ddl(_stored(columns)))
    return _load_or_none(reader, "parquet", dates)


def read_partition(
    spark: SparkSession, path: str, date: str, columns: schemas.Columns | None = None
) -> DataFrame | None:
    """One date of a table, with its ``dt`` column; ``None`` when the date is absent."""
    return read_range(spark, path, date, 1, columns)


def read_all(
    spark: SparkSession, path: str, columns: schemas.Columns | None = None
) -> DataFrame | None:
    """All dates of a table."""
    slots = commits.current(spark, path)
    dates: str | list[str] = path
    if slots is not None:
        plain = [d for d in Folder(spark, path).names() if d.startswith("dt=") and d not in slots]
        dates = [f"{path}/{d}" for d in commits.folders_of(slots) + plain]
        if not dates:
            return None
    reader = spark.read.option("basePath", path)
    if columns:
        reader = reader.schema(schemas.ddl(_stored(columns)))
    return _load_or_none(reader, "parquet", dates)


def _stored(columns: schemas.Columns) -> schemas.Columns:
    return {name: storage_type(dtype) for name, dtype in columns.items()}
