"""Serving tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shoreline.operators.contracts import to_serving, violations
from shoreline.schemas import Contract

# Connections opened at once and rows per INSERT batch.
CONNECTIONS = 8
INSERT_BATCH = 10_000


class ContractViolation(ValueError):
    """Rows that the serving table would refuse."""


def existing_keys(
    spark: SparkSession, contract: Contract, date: str, url: str, properties: Mapping[str, str]
) -> DataFrame:
    """Keys already loaded for a date; the database filters them."""
    keys = ", ".join(contract.key)
    query = f"(SELECT {keys} FROM {contract.table} WHERE dt = DATE '{date}') loaded"
    return spark.read.jdbc(url, query, properties=dict(properties))


def not_loaded(df: DataFrame, loaded: DataFrame, contract: Contract) -> DataFrame:
    return df.join(loaded, list(contract.key), "left_anti").select(*contract.columns)


def rows_to_load(kpi: DataFrame, contract: Contract, loaded: DataFrame | None = None) -> DataFrame:
    """The rows that a load sends: in the serving table's form, without those whose keys are loaded."""
    rows = to_serving(kpi, contract)
    return rows if loaded is None else not_loaded(rows, loaded, contract)


def load_jdbc(
    kpi: DataFrame,
    contract: Contract,
    url: str,
    properties: Mapping[str, str],
    loaded: DataFrame | None = None,
) -> bool:
    """Append a KPI frame to its serving table; returns False when nothing is left to append.

    Rows whose keys are in ``loaded`` are skipped, so a date can be loaded twice. A
    contract violation fails the load before the first row is sent.
    """
    broken = [row.asDict() for row in violations(kpi, contract).where("violations > 0").collect()]
    if broken:
        raise ContractViolation(f"{contract.table}: {broken}")
    rows = rows_to_load(kpi, contract, loaded)
    if rows.isEmpty():
        return False
    settings = {"batchsize": str(INSERT_BATCH), "numPartitions": str(CONNECTIONS), **properties}
    rows.write.mode("append").jdbc(url, contract.table, properties=settings)
    return True
