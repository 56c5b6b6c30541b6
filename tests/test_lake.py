import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.plans import daily, quality
from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake

DAY = "2026-04-17"


def dated(frame, rows):
    return frame(rows, "id int,v int,dt date")


def contents(spark, path):
    return sorted((r.id, r.v, str(r.dt)) for r in tables.read_all(spark, path).collect())


def test_writing_a_date_again_leaves_the_others(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(dated(frame, [(1, 1, "2026-04-17")]), path)
    tables.write_table(dated(frame, [(2, 2, "2026-04-18")]), path)
    tables.write_table(dated(frame, [(3, 3, "2026-04-17"), (4, 4, "2026-04-17")]), path, ["id"])
    assert contents(spark, path) == [
        (2, 2, "2026-04-18"), (3, 3, "2026-04-17"), (4, 4, "2026-04-17")]


def test_partition_reads(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(dated(frame, [(i, i, f"2026-04-{10 + i}") for i in range(8)]), path)
    one = tables.read_partition(spark, path, DAY)
    assert [(r.id, r.dt) for r in one.collect()] == [(7, dt.date(2026, 4, 17))]
    few = tables.read_range(spark, path, DAY, days=3)
    assert sorted(r.id for r in few.collect()) == [5, 6, 7]
    assert len(few.inputFiles()) == 3
    assert tables.read_range(spark, path, "2026-04-30", days=3) is None
    typed = tables.read_partition(spark, path, DAY, {"id": "int", "dt": "date"})
    assert tuple(typed.first()) == (7, dt.date(2026, 4, 17))
    with pytest.raises(tables.MissingColumns, match="x"):
        tables.read_partition(spark, path, DAY, {"id": "int", "x": "string", "dt": "date"})


def test_absent_data_is_none_or_empty(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert tables.read_partition(spark, lake.domain("events"), DAY) is None
    assert tables.read_raw(spark, lake, "crm", DAY) is None
    assert tables.read_raw_inferred(spark, lake, "crm", DAY) is None
    assert tables.read_all(spark, lake.kpi("daily_revenue")) is None
    assert tables.read_dead_letter(spark, lake, "crm") is None
    empty = tables.read_raw_or_empty(spark, lake, "crm", DAY)
    assert empty.count() == 0 and empty.columns == list(schemas.raw_columns("crm"))


def test_other_read_errors_are_raised(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "bad.parquet").write_text("this is no parquet")
    with pytest.raises(Exception, match="bad.parquet"):
        tables.read_all(spark, str(tmp_path / "t"))


def test_unreadable_tables_are_reported_and_do_not_stop_the_report(spark, tmp_path):
    lake = Lake(str(tmp_path))
    folder = tmp_path / "gold" / "kpi=daily_revenue" / f"dt={DAY}"
    folder.mkdir(parents=True)
    (folder / "bad.parquet").write_text("this is no parquet")
    report = {r.table_name: r for r in quality.validate_lake(spark, lake, DAY).collect()}
    assert report["daily_revenue"].status == "error" and report["daily_revenue"].error
    assert report["user_retention"].status == "missing"
    profile = {r.kpi: r.status for r in quality.verify_gold(spark, lake).collect()}
    assert profile["daily_revenue"] == "error" and profile["user_retention"] == "missing"


def raw_rows(frame, source, records, hour="00", date=DAY):
    rows = [(json.dumps(r), "bronze", source, date, hour) for r in records]
    return frame(rows, "value string,zone string,source string,dt string,hour string")


def test_raw_batches_are_replaced_not_repeated(spark, frame, tmp_path):
    lake = Lake(str(tmp_path))
    first = [{"reading_id": "1", "value": 1.5, "extra": {"x": 1}}]
    tables.write_raw(raw_rows(frame, "iot_sensors", first), lake, "b1")
    tables.write_raw(raw_rows(frame, "iot_sensors", first), lake, "b1")
    tables.write_raw(raw_rows(frame, "iot_sensors", [{"reading_id": "2"}], "05"), lake, "b2")
    tables.write_raw(raw_rows(frame, "iot_sensors", [{"reading_id": "3"}], date="2026-04-18"),
                     lake, "b3")
    got = tables.read_raw(spark, lake, "iot_sensors", DAY)
    assert sorted((r.reading_id, r.value) for r in got.collect()) == [("1", 1.5), ("2", None)]
    assert got.columns == list(schemas.raw_columns("iot_sensors"))
    inferred = tables.read_raw_inferred(spark, lake, "iot_sensors", DAY)
    assert "extra" in inferred.columns


def test_reads_plain_layout_without_batch_folder(spark, tmp_path):
    lake = Lake(str(tmp_path))
    folder = tmp_path / "raw" / "zone=bronze" / "source=crm" / f"dt={DAY}" / "hour=03"
    folder.mkdir(parents=True)
    lines = ['{"customer_id":"c1","email":"a"}', "broken", '{"customer_id":"c2"}']
    (folder / "part-00000.ndjson").write_text("\n".join(lines) + "\n")
    got = tables.read_raw(spark, lake, "crm", DAY)
    assert {r.customer_id for r in got.collect()} == {"c1", "c2", None}


@pytest.fixture
def filled(frame, tmp_path):
    """A lake with one day of every source."""
    lake = Lake(str(tmp_path / "lake"))
    at, seen = f"{DAY}T10:00:00Z", f"{DAY}T10:05:00Z"
    stream = {"_ingested_at": seen, "_kafka_partition": 0, "_kafka_offset": 1}
    data = {
        "user_events": [
            {"event_id": f"e{i}", "user_id": f"u{i % 3}", "event_type": "click", "timestamp": at}
            for i in range(9)] + [{"event_id": "e0", "user_id": "u0", "timestamp": None}],
        "clickstream": [{"request_id": "r1", "path": "/a", "timestamp": at}],
        "transactions": [
            {"txn_id": f"t{i}", "user_id": "u1", "amount": 10.0, "txn_type": "purchase",
             "status": "completed", "currency": "USD", "timestamp": at} for i in range(4)],
        "payments": [{"payment_id": "p1", "customer_id": "c1", "amount": 7.0,
                      "payment_status": "success", "transaction_fee": 0.1, "payment_date": DAY}],
        "crm": [{"customer_id": "c1", "email": "a@x"}, {"customer_id": "c2", "email": "b@x"}],
        "orders": [{"order_id": "o1", "customer_id": "c1", "product_id": "s1", "quantity": 2,
                    "total_amount": 20.0, "order_date": DAY}],
        "inventory": [{"sku": "s1", "category": "a", "warehouse": "w", "quantity_on_hand": 10,
                       "reorder_point": 3, "unit_cost": 2.0}],
        "iot_sensors": [{"reading_id": f"i{i}", "sensor_id": "x", "sensor_type": "temp",
                         "location": "l", "value": 20.0 + i % 2, "timestamp": at}
                        for i in range(20)],
    }
    for source, records in data.items():
        rows = [{"_source": source, **stream, **r} for r in records]
        tables.write_raw(raw_rows(frame, source, rows), lake, "day")
    return lake


def test_raw_files_without_lineage_are_reported(spark, frame, tmp_path):
    lake = Lake(str(tmp_path))
    tables.write_raw(raw_rows(frame, "crm", [{"customer_id": "c1", "_source": "crm"}]), lake, "b")
    report = {r.table_name: r for r in quality.validate_lake(spark, lake, DAY).collect()}
    assert (report["crm"].status, report["crm"].error) == ("error", "missing fields: _ingested_at")
    assert report["crm"].row_count == 1


def counts(ledger):
    return {(r.layer, r.table_name): r.row_count for r in ledger.collect()}


EXPECTED = {
    ("silver", "events"): 10, ("silver", "transactions"): 5, ("silver", "customers"): 2,
    ("silver", "inventory"): 1, ("gold", "daily_revenue"): 1, ("gold", "user_retention"): 1,
    ("gold", "iot_anomaly_summary"): 1, ("gold", "inventory_turnover"): 1,
}


def test_a_day_end_to_end_and_again(spark, filled):
    ledger = counts(daily.run_day(spark, filled, DAY))
    # the newer delivery of e0 has no time, or the older one wins: both have equal ingest time
    assert ledger["silver", "events"] in (9, 10)
    assert {k: v for k, v in ledger.items() if k != ("silver", "events")} == {
        k: v for k, v in EXPECTED.items() if k != ("silver", "events")}
    before = {k: tables.read_all(spark, filled.kpi(k)).drop("_aggregated_at").collect()
              for k in schemas.KPIS}
    assert counts(daily.run_day(spark, filled, DAY)) == ledger
    after = {k: tables.read_all(spark, filled.kpi(k)).drop("_aggregated_at").collect()
             for k in schemas.KPIS}
    assert before == after
    revenue = after["daily_revenue"][0]
    assert (revenue.total_revenue, revenue.total_transactions) == (47.0, 5)

    report = {(r.layer, r.table_name): (r.status, r.row_count)
              for r in quality.validate_lake(spark, filled, DAY).collect()}
    assert report["bronze", "app_logs"] == ("missing", 0)
    assert report["bronze", "user_events"] == ("ok", 10)
    assert report["gold", "daily_revenue"] == ("ok", 1)
    verdict = quality.lake_verdict(quality.validate_lake(spark, filled, DAY)).first()
    assert verdict.passed and verdict.gold_rows == 4
    assert quality.all_ok(quality.verify_gold(spark, filled)).first().passed


def test_steps_of_the_domain_tables_are_counted(spark, filled):
    steps = {}
    counts_by_table = daily.build_silver(spark, filled, DAY, steps=steps)
    assert steps["events"]["read"] == 11 and steps["events"]["unique"] == 10
    assert steps["events"]["complete"] == counts_by_table["silver", "events"]
    assert steps["customers"] == {"read": 2, "unique": 2, "complete": 2}


def test_a_wide_day(spark, filled):
    ledger = counts(daily.run_day(spark, filled, DAY, wide=True))
    assert ledger["silver", "transactions"] == 5
    # overall, no payment method, USD, no currency
    assert ledger["gold", "daily_revenue"] == 4
    report = tables.read_all(spark, filled.wide.kpi("daily_revenue"))
    overall = report.where("breakdown_type = 'overall'").first()
    assert overall.total_revenue == 47.0 and overall.conversion_rate > 0


def test_days_without_data(spark, tmp_path):
    lake = Lake(str(tmp_path / "none"))
    with pytest.raises(daily.MissingInput, match="user_events and clickstream"):
        daily.run_day(spark, lake, DAY)
    assert set(counts(daily.run_day(spark, lake, DAY, allow_missing=True)).values()) == {0}
    assert set(counts(daily.run_day(spark, lake, DAY, wide=True)).values()) == {0}
    report = quality.validate_lake(spark, lake, DAY)
    assert {(r.layer == "bronze", r.status, r.row_count) for r in report.collect()} == {
        (True, "missing", 0), (False, "ok", 0)}
    assert quality.lake_verdict(report).first().silver_to_bronze_pct is None
    assert quality.all_ok(quality.verify_gold(spark, lake)).first().passed
    nowhere = Lake(str(tmp_path / "nowhere"))
    assert not quality.all_ok(quality.verify_gold(spark, nowhere)).first().passed


def test_retention_reads_several_days(spark, frame, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for date in ("2026-04-16", DAY):
        rows = [{"event_id": f"{date}-{u}", "user_id": u, "timestamp": f"{date}T10:00:00Z",
                 "_ingested_at": f"{date}T10:00:00Z"} for u in "ab"]
        tables.write_raw(raw_rows(frame, "user_events", rows, date=date), lake, date)
        daily.build_silver(spark, lake, date, only=["events"])
    one = daily.kpi_frames(spark, lake, DAY, only=["user_retention"])["user_retention"]
    two = daily.kpi_frames(spark, lake, DAY, 2, ["user_retention"])["user_retention"]
    assert [(r.days_since_cohort, r.active_users) for r in one.collect()] == [(0, 2)]
    assert sorted((r.days_since_cohort, r.active_users) for r in two.collect()) == [(0, 2), (1, 2)]


def test_a_date_that_becomes_empty_is_emptied(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_date(dated(frame, [(1, 1, DAY)]), path, DAY)
    tables.write_date(dated(frame, [(2, 2, "2026-04-18")]), path, "2026-04-18")
    tables.write_date(dated(frame, []), path, DAY)
    assert contents(spark, path) == [(2, 2, "2026-04-18")]
    tables.clear_date(spark, path, "2026-04-18")
    tables.clear_date(spark, path, "2026-04-19")
    assert contents(spark, path) == []


def test_both_forms_side_by_side(spark, filled):
    daily.build_silver(spark, filled, DAY)
    daily.build_silver(spark, filled, DAY, wide=True)
    daily.build_gold(spark, filled, DAY)
    daily.build_gold(spark, filled, DAY, wide=True)
    revenue = tables.read_all(spark, filled.kpi("daily_revenue")).first()
    assert (revenue.total_revenue, revenue.total_transactions) == (47.0, 5)
    assert "breakdown_type" in tables.read_all(spark, filled.wide.kpi("daily_revenue")).columns


def test_one_domain_and_one_kpi(spark, filled):
    assert list(daily.build_silver(spark, filled, DAY, only=["customers"])) == [("silver", "customers")]
    assert tables.read_all(spark, filled.domain("events")) is None
    with pytest.raises(daily.MissingInput):
        daily.build_gold(spark, filled, DAY, only=["inventory_turnover"])
    daily.build_silver(spark, filled, DAY, only=["inventory"])
    counted = daily.build_gold(spark, filled, DAY, only=["inventory_turnover"])
    assert counted == {("gold", "inventory_turnover"): 1}
    with pytest.raises(ValueError, match="unknown: nothing"):
        daily.build_gold(spark, filled, DAY, only=["nothing"])


def test_previous_day_is_a_date():
    assert dt.date.fromisoformat(daily.previous_day())


def test_snappy_is_used(spark, frame, tmp_path):
    path = tmp_path / "t"
    tables.write_table(dated(frame, [(1, 1, DAY)]).withColumn("s", F.lit("x")), str(path))
    assert list(path.glob("dt=*/_versions/*/part-*.snappy.parquet"))


def test_checks_of_written_tables_read_footers_only(spark, filled):
    daily.run_day(spark, filled, DAY)
    for path in (filled.domain("events"), filled.kpi("daily_revenue")):
        found = tables.read_footers(spark, path, DAY)
        plan = found.counts._jdf.queryExecution().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan
        whole = quality._table_row(spark, "x", "t", tables.read_partition(spark, path, DAY), (), quality.AUDIT_TIMES).first()
        assert quality._table_row(spark, "x", "t", found, (), quality.AUDIT_TIMES).first() == whole
    kpi = filled.kpi("daily_revenue")
    profile = lambda found: quality.profile_kpi(spark, "k", found).first()
    assert profile(tables.read_footers(spark, kpi)) == profile(tables.read_all(spark, kpi))
    # an emptied date has no rows; without notes the data are read
    tables.clear_date(spark, kpi, DAY)
    assert tables.read_footers(spark, kpi) is None
    assert quality.verify_gold(spark, filled).where("kpi = 'daily_revenue'").first().row_count == 0


def test_types_of_fields_that_change(spark, frame, tmp_path):
    lake = Lake(str(tmp_path))
    days = {DAY: [{"a": 1, "b": None, "c": {"x": 1}}, {"a": 2.5, "b": "s", "c": {"x": 2, "y": True}}],
            "2026-04-18": [{"a": "text", "d": [1, 2]}, {"a": [1], "d": None}]}
    for date, records in days.items():
        tables.write_raw(raw_rows(frame, "crm", records, date=date), lake, date)
    lines = tables.raw_lines(spark, lake, "crm", list(days))
    types = {(r.dt, r.field): r.type for r in tables.field_types(lines).collect()}
    assert types[DAY, "c"] == "OBJECT<x: BIGINT, y: BOOLEAN>" and types[DAY, "b"] == "STRING"
    assert types["2026-04-18", "a"] == "VARIANT" and types["2026-04-18", "d"] == "ARRAY<BIGINT>"
    conflicts = {(r.field, r.first_date) for r in tables.type_conflicts(tables.field_types(lines)).collect()}
    assert conflicts == {("a", DAY), ("a", "2026-04-18")}
    first = tables.read_raw_inferred(spark, lake, "crm", DAY).orderBy("a").collect()
    assert [(r.a, r.b, r.c.x, r.c.y) for r in first] == [(1.0, None, 1, None), (2.5, "s", 2, True)]
    second = tables.read_raw_inferred(spark, lake, "crm", "2026-04-18")
    # neither value is lost
    assert sorted(second.selectExpr("to_json(a) AS a").collect()) == [('"text"',), ("[1]",)]
    assert tables.field_types(lines)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
