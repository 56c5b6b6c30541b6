import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.operators import contracts
from shoreline.operators.shape import align
from shoreline.sources import serving

KPI = schemas.CONTRACTS["daily_revenue"]


def revenue(frame, rows):
    df = frame(rows, "revenue_date date,total_revenue double,total_transactions bigint,"
                     "conversion_rate_pct double,_aggregated_at timestamp,dt date")
    names = [c for c in KPI.columns if c != "aggregated_at"] + ["_aggregated_at"]
    return align(df, {c: KPI.columns.get(c, "timestamp") for c in names})


AT, DAY = "2026-04-18 01:00:00", "2026-04-17"
GOOD = ("2026-04-17", 12.345, 3, 50.0, AT, DAY)


def test_serving_names_order_and_types(frame):
    out = contracts.to_serving(revenue(frame, [GOOD]), KPI)
    assert dict(out.dtypes) == KPI.columns and out.columns == list(KPI.columns)
    row = out.first()
    assert row.total_revenue == Decimal("12.35") and row.dt == dt.date(2026, 4, 17)


def found(report):
    return {(r.check_name, r.column_name): r.violations for r in report.collect() if r.violations}


def test_violations_are_counted(frame):
    df = revenue(frame, [
        GOOD, GOOD,
        ("2026-04-16", 1e11, None, 1000.0, AT, DAY),
        (None, 1.0, 1, 999.99, AT, DAY),
    ])
    assert found(contracts.violations(df, KPI)) == {
        ("not_null", "revenue_date"): 1,
        ("not_null", "total_transactions"): 1,
        ("primary_key", "revenue_date,dt"): 1,
        ("numeric", "total_revenue"): 1,
        ("numeric", "conversion_rate_pct"): 1,
    }
    assert found(contracts.violations(revenue(frame, [GOOD]), KPI)) == {}


def test_text_length(frame):
    contract = schemas.CONTRACTS["iot_anomaly_summary"]
    df = align(frame([("x" * 51,), ("x" * 50,), (None,)], "sensor_type string"), contract.columns)
    assert found(contracts.column_violations(df.drop("aggregated_at"), contract).where("check_name = 'length'")) == {("length", "sensor_type"): 1}


@pytest.fixture
def sent(monkeypatch):
    """Catch what would go to the database; no database runs here."""
    calls = []

    def jdbc(writer, url, table, mode=None, properties=None):
        calls.append((url, table, properties, writer._df.collect()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    return calls


def test_load_sends_new_keys_only(frame, sent):
    df = revenue(frame, [GOOD, ("2026-04-16", 1.0, 1, 1.0, AT, DAY)])
    loaded = frame([("2026-04-16", DAY)], "revenue_date date,dt date")
    assert serving.load_jdbc(df, KPI, "jdbc:x", {"user": "u"}, loaded)
    (url, table, properties, rows), = sent
    assert (url, table, properties["user"]) == ("jdbc:x", "kpi_daily_revenue", "u")
    assert int(properties["numPartitions"]) == serving.CONNECTIONS
    assert [str(r.revenue_date) for r in rows] == ["2026-04-17"]
    assert list(rows[0].asDict()) == list(KPI.columns)


def test_load_skips_empty_frames(frame, sent):
    assert not serving.load_jdbc(revenue(frame, []), KPI, "jdbc:x", {})
    loaded = frame([("2026-04-17", DAY)], "revenue_date date,dt date")
    assert not serving.load_jdbc(revenue(frame, [GOOD]), KPI, "jdbc:x", {}, loaded)
    assert sent == []


def test_load_refuses_broken_rows(frame, sent):
    with pytest.raises(serving.ContractViolation, match="conversion_rate_pct"):
        serving.load_jdbc(
            revenue(frame, [("2026-04-17", 1.0, 1, 12345.0, AT, DAY)]), KPI, "jdbc:x", {})
    assert sent == []


def test_existing_keys_are_asked_from_the_database(spark, monkeypatch):
    asked = {}

    def jdbc(reader, url, table, properties=None, **_):
        asked.update(url=url, table=table, properties=properties)
        return spark.range(0).select(F.lit("x").alias("revenue_date"))

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    serving.existing_keys(spark, KPI, DAY, "jdbc:x", {"user": "u"})
    assert asked["table"] == (
        "(SELECT revenue_date, dt FROM kpi_daily_revenue WHERE dt = DATE '2026-04-17') loaded")


def test_all_kpis_are_loaded(spark, frame, tmp_path, sent, monkeypatch):
    from shoreline.plans import daily
    from shoreline.sources import lake as tables
    from shoreline.sources.lake import Lake

    lake = Lake(str(tmp_path))
    tables.write_table(revenue(frame, [GOOD]), lake.kpi("daily_revenue"))
    monkeypatch.setattr(daily, "existing_keys", lambda *a: frame([], "revenue_date date,dt date"))
    done = daily.load_serving(spark, lake, DAY, "jdbc:x", {})
    assert done == {"daily_revenue": True, "user_retention": False,
                    "inventory_turnover": False, "iot_anomaly_summary": False}
    assert [call[1] for call in sent] == ["kpi_daily_revenue"]
