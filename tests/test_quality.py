import datetime as dt

from shoreline.operators import rows
from shoreline.plans import quality


def test_layer_report_states(spark, frame):
    tables = {
        "good": frame([(1, "2026-04-17 01:00:00")], "a int,_aggregated_at timestamp"),
        "old": frame([(1, "2026-04-17 02:00:00"), (2, None)], "a int,_processed_at timestamp"),
        "bare": frame([(1,)], "a int"),
        "gone": None,
    }
    report = {r.table_name: r for r in quality.layer_report(spark, "gold", tables).collect()}
    assert (report["good"].status, report["good"].row_count) == ("ok", 1)
    assert report["old"].latest == dt.datetime(2026, 4, 17, 2)
    assert (report["bare"].status, report["bare"].error) == (
        "error", "missing fields: _processed_at or _aggregated_at")
    assert (report["gone"].status, report["gone"].row_count) == ("missing", 0)
    status = quality.layer_status(quality.layer_report(spark, "gold", tables)).first()
    assert (status.total_rows, status.passed) == (4, False)


def test_bronze_requires_source_and_ingest_time(spark, frame):
    ok = frame([("s", "2026-04-17T01:00:00Z")], "_source string,_ingested_at string")
    bad = frame([("s",)], "_source string")
    report = {r.table_name: r for r in quality.bronze_report(spark, {"a": ok, "b": bad}).collect()}
    assert report["a"].status == "ok" and report["a"].latest == dt.datetime(2026, 4, 17, 1)
    assert (report["b"].status, report["b"].error) == ("error", "missing fields: _ingested_at")


DELIVERIES = [
    ("a", 1, "2026-04-17 01:00:00"), ("a", None, "2026-04-17 02:00:00"),
    ("b", 1, "2026-04-17 01:00:00"), (None, 1, "2026-04-17 01:00:00"),
    (None, 2, "2026-04-17 01:30:00"),
]


def test_dedup_accounting(frame):
    df = frame(DELIVERIES, "id string,v int,_ingested_at timestamp")
    row = quality.dedup_accounting(df, "id", ["id", "v"], ["_ingested_at"]).first()
    assert tuple(row) == (5, 3, 2, 2, 1)
    none = quality.dedup_accounting(df.limit(0), "id", ["id"], ["_ingested_at"]).first()
    assert tuple(none) == (0, 0, 0, 0, 0)


def test_row_counter_counts_in_the_write(spark, frame, tmp_path):
    df = frame(DELIVERIES, "id string,v int,_ingested_at timestamp")
    counter = quality.RowCounter()
    before = counter.watch(df, "before")
    deduped = counter.watch(rows.keep_latest(before, "id"), "deduped")
    kept = counter.watch(rows.require_fields(deduped, ["id", "v"]), "kept")
    kept.write.parquet(str(tmp_path / "out"))
    assert counter.counts() == {"before": 5, "deduped": 3, "kept": 1}


def test_profile(spark, frame):
    df = frame([(1, "2026-04-17"), (2, "2026-04-17"), (3, "2026-04-18")], "a int,dt date")
    row = quality.profile_kpi(spark, "k", df).first()
    assert (row.status, row.row_count, row.column_count, row.date_partitions) == ("ok", 3, 2, 2)
    assert quality.profile_kpi(spark, "k", None).first().status == "missing"
