"""Serving projection and contract checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.operators.shape import conform
from shoreline.schemas import Contract


def to_serving(kpi: DataFrame, contract: Contract) -> DataFrame:
    """Serving names, order and types. A value beyond its type becomes NULL; see
    ``column_violations`` for counting those before they are lost."""
    renamed = kpi.withColumnRenamed("_aggregated_at", "aggregated_at")
    return conform(renamed, contract.columns)


def column_counters(kpi: DataFrame, contract: Contract) -> dict[tuple[str, str], Column]:
    """What is counted for each (check, column): NULLs where none are allowed, numbers beyond their
    precision, texts beyond their length. All look at the KPI frame before any cast, so a
    value that doesn't fit is not also reported as NULL."""
    given = kpi.withColumnRenamed("_aggregated_at", "aggregated_at").columns

    def value(name: str) -> Column:
        source = "_aggregated_at" if name == "aggregated_at" and name not in kpi.columns else name
        return F.col(source) if name in given else F.lit(None)

    counters = {("not_null", c): F.count_if(value(c).isNull()) for c in contract.required}
    for name, storage in contract.columns.items():
        kind, *sizes = storage.replace(")", "").split("(")
        if kind == "decimal":
            lost = value(name).isNotNull() & value(name).try_cast(storage).isNull()
            counters["numeric", name] = F.count_if(lost)
        elif kind == "varchar":
            counters["length", name] = F.count_if(F.length(value(name).cast("string")) > int(sizes[0]))
    return counters


def column_violations(kpi: DataFrame, contract: Contract) -> DataFrame:
    """All checks of single columns, counted in one pass."""
    counters = column_counters(kpi, contract)
    counted = kpi.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters.values())])
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(check).alias("check_name"), F.lit(name).alias("column_name"),
            F.col(f"c{i}").alias("violations"))
        for i, (check, name) in enumerate(counters)
    ]))
    return counted.select(rows.alias("r")).select("r.*")


def key_duplicates(df: DataFrame, contract: Contract) -> DataFrame:
    """Primary keys held by more than one row."""
    return df.groupBy(*contract.key).agg(F.count("*").alias("copies")).where("copies > 1")


def key_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Number of duplicated keys as a report row."""
    return key_duplicates(df, contract).agg(F.count("*").alias("violations")).select(
        F.lit("primary_key").alias("check_name"),
        F.lit(",".join(contract.key)).alias("column_name"),
        "violations",
    )


def violations(kpi: DataFrame, contract: Contract) -> DataFrame:
    """All checks of a KPI frame against its serving table, one row per check and column: one pass
    for the columns, one for the key."""
    serving = to_serving(kpi, contract)
    return column_violations(kpi, contract).unionByName(key_violations(serving, contract))
