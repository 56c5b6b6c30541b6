import datetime as dt
import random
from collections import defaultdict

import pytest

from compare import plan_of
from shoreline import schemas
from shoreline.operators.shape import align, empty
from shoreline.plans import gold, gold_wide

D = dt.date


def events_of(frame, rows):
    return align(frame(rows, "event_id string, user_id string, timestamp timestamp"), schemas.EVENTS)


def transactions_of(frame, rows):
    schema = ("transaction_id string, user_id string, customer_id string, amount double, "
              "transaction_fee double, timestamp timestamp")
    return align(frame(rows, schema.replace(", ", ",")), schemas.TRANSACTIONS)


def test_daily_revenue_joins_the_activity_of_the_day(frame):
    txns = transactions_of(frame, [
        ("t1", "u1", None, 10.0, None, "2024-01-01 08:00:00"),
        ("t2", "u1", None, -4.0, None, "2024-01-01 23:59:59"),
        ("p1", None, "c1", 6.0, 0.5, "2024-01-01 00:00:00"),
        ("t3", "u2", None, 1.0, None, "2024-01-02 00:00:00"),
    ])
    events = events_of(frame, [(f"e{i}", f"u{i % 2}", "2024-01-01 10:00:00") for i in range(6)]
                       + [("x", "u9", "2024-01-03 10:00:00")])
    got = {r.revenue_date: r for r in gold.daily_revenue(txns, events).collect()}
    first, second = got[D(2024, 1, 1)], got[D(2024, 1, 2)]
    assert set(got) == {D(2024, 1, 1), D(2024, 1, 2)}
    assert (first.total_revenue, first.total_transactions, first.avg_transaction_value) == (12, 3, 4)
    assert (first.unique_customers, first.total_fees) == (2, 0.5)
    assert (first.total_events, first.unique_users, first.conversion_rate_pct) == (6, 2, 50.0)
    assert (second.total_events, second.conversion_rate_pct, second.total_fees) == (None, None, None)


def test_retention_grid(frame):
    grid = gold.user_retention(events_of(frame, [
        ("1", "a", "2024-01-01 23:59:00"), ("2", "a", "2024-01-02 00:01:00"),
        ("3", "a", "2024-01-02 10:00:00"), ("4", "b", "2024-01-01 10:00:00"),
        ("5", "c", "2024-01-02 10:00:00"), ("6", None, "2023-12-01 10:00:00"),
    ]))
    got = [tuple(r) for r in gold.in_report_order(grid).collect()]
    assert got == [
        (D(2024, 1, 1), 0, 2, 2, 100.0, 2),
        (D(2024, 1, 1), 1, 2, 1, 50.0, 2),
        (D(2024, 1, 2), 0, 1, 1, 100.0, 1),
    ]


def test_retention_against_brute_force_with_a_hot_user(frame):
    rng = random.Random(3)
    data = []
    for i in range(900):
        user = "hot" if i < 300 else f"u{rng.randint(0, 40)}"
        data.append((str(i), user, f"2024-01-{rng.randint(1, 20):02d} 0{rng.randint(0, 9)}:00:00"))
    days = defaultdict(set)
    for _, user, at in data:
        days[user].add(D.fromisoformat(at[:10]))
    start = {u: min(d) for u, d in days.items()}
    active, count = defaultdict(set), defaultdict(int)
    for _, user, at in data:
        cell = (start[user], (D.fromisoformat(at[:10]) - start[user]).days)
        active[cell].add(user)
        count[cell] += 1
    expected = {c: (len(active[(c[0], 0)]), len(u), count[c]) for c, u in active.items()}
    got = {(r.cohort_date, r.days_since_cohort): (r.cohort_size, r.active_users, r.total_events)
           for r in gold.user_retention(events_of(frame, data)).collect()}
    assert got == expected


def test_windows_run_over_user_days_not_events(frame):
    """The window input is aggregated, so a user's events never meet in one task."""
    plan = plan_of(gold.user_retention(events_of(frame, [("1", "a", "2024-01-01 00:00:00")])))
    assert plan.index("Window [min") < plan.index("HashAggregate(keys=[user_id")


READING = "reading_id string, sensor_type string, location string, value double, timestamp timestamp"


def readings(frame):
    at = "2024-01-01 10:00:00"
    rows = [(f"n{i}", "temp", "here", 10.0 + i % 3, at) for i in range(60)]
    rows += [("high", "temp", "here", 500.0, at), ("low", "temp", "there", -480.0, at)]
    rows += [("one", "single", "here", 1.0, at), ("null", "temp", "here", None, at)]
    rows += [(f"c{i}", "constant", "here", 5.0, at) for i in range(5)]
    return frame(rows, READING.replace(", ", ","))


def test_z_scores_flag_both_sides_only(frame):
    scored = {r.reading_id: r for r in gold.score_readings(readings(frame)).collect()}
    assert {k for k, r in scored.items() if r.is_anomaly} == {"high", "low"}
    assert scored["high"].z_score > 3 and scored["low"].z_score < -3
    assert scored["one"].z_score is None and scored["c0"].z_score is None
    assert "null" not in scored


def test_bounds_name_the_side(frame):
    bounded = {r.reading_id: r for r in gold_wide.bounded_readings(readings(frame)).collect()}
    assert bounded["high"].anomaly_type == "above_threshold"
    assert bounded["low"].anomaly_type == "below_threshold"
    assert bounded["null"].anomaly_type == "normal" and not bounded["null"].is_anomaly
    assert bounded["one"].deviation_sigma is None


def test_sensor_summaries(frame):
    by_day = {r.sensor_type: r for r in gold.sensor_anomaly(readings(frame)).collect()}
    assert (by_day["temp"].total_readings, by_day["temp"].anomaly_count) == (62, 2)
    assert by_day["constant"].max_abs_z_score is None and by_day["constant"].anomaly_rate_pct == 0.0
    by_place = {(r.sensor_type, r.location): r
                for r in gold_wide.sensor_anomaly_by_location(readings(frame)).collect()}
    assert by_place["temp", "there"].anomaly_rate == 100.0
    assert (by_place["temp", "here"].total_readings, by_place["temp", "here"].anomaly_count) == (62, 1)


def test_sensor_plans_start_no_job_and_broadcast_a_small_baseline(spark, frame):
    rows = readings(frame)
    spark.sparkContext.setJobGroup("building", "")
    try:
        plans = [
            gold.sensor_anomaly(rows), gold_wide.sensor_anomaly_by_location(rows),
            gold.score_readings(rows), gold_wide.bounded_readings(rows),
        ]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plans[2].collect()
    assert "BroadcastHashJoin" in plan_of(plans[2])


def test_sensor_plans_read_the_readings_twice(spark, frame, tmp_path):
    readings(frame).write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    for plan in (gold.sensor_anomaly(rows), gold_wide.sensor_anomaly_by_location(rows),
                 gold.score_readings(rows), gold_wide.bounded_readings(rows)):
        plan.collect()
        assert plan_of(plan).split("== Initial Plan ==")[0].count("FileScan parquet") == 2


def test_sensor_rows_of_the_event_table(frame):
    events = align(frame([("e1", "iot_sensors", 12), ("e2", "clickstream", 5)],
                         "event_id string,event_source string,latency_ms int"), schemas.EVENTS)
    got = [tuple(r)[:3] for r in gold.readings_from_events(events).collect()]
    assert got == [("e1", "latency", 12.0)]


def wide_transactions(frame, rows):
    return frame(rows, "txn_id string,user_id string,amount double,payment_method string,"
                       "currency string,status string,payment_status string,txn_type string")


def sample_wide(frame):
    return wide_transactions(frame, [
        ("1", "a", 10.0, "card", "USD", "completed", None, "purchase"),
        ("2", "a", 20.0, None, "USD", "completed", None, "purchase"),
        ("3", "b", None, None, "EUR", "completed", None, "refund"),
        ("4", None, 5.0, "card", None, None, "success", None),
        ("5", "z", 99.0, "card", "USD", "failed", None, "purchase"),
    ])


def test_revenue_breakdown_tells_null_groups_from_totals(frame, spark):
    report = gold_wide.revenue_breakdown(sample_wide(frame), spark.range(16))
    got = {(r.breakdown_type, r.breakdown_value):
           (r.total_revenue, r.transaction_count, r.avg_transaction_value, r.unique_customers,
            r.conversion_rate) for r in report.collect()}
    assert got == {
        ("overall", "all"): (35.0, 4, 11.67, 2, 0.25),
        ("payment_method", "card"): (15.0, 2, 7.5, 1, None),
        ("payment_method", None): (20.0, 2, 20.0, 2, None),
        ("currency", "USD"): (30.0, 2, 15.0, 1, None),
        ("currency", "EUR"): (None, 1, None, 1, None),
        ("currency", None): (5.0, 1, 5.0, 0, None),
    }


def test_conversion_without_events(frame, spark):
    rows = sample_wide(frame)
    empty_events = gold_wide.revenue_breakdown(rows, spark.range(0)).where("breakdown_type='overall'")
    assert empty_events.first().conversion_rate == 0.0
    no_events = gold_wide.revenue_breakdown(rows).where("breakdown_type = 'overall'")
    assert no_events.first().conversion_rate is None


def test_retention_span_with_and_without_anonymous_rows(frame):
    events = frame([
        ("1", "a", "2024-01-01 00:00:00"), ("2", "a", "2024-01-09 00:00:00"),
        ("3", "b", "2024-01-01 00:00:00"),
        ("4", None, "2024-01-01 00:00:00"), ("5", None, "2024-02-05 00:00:00"),
    ], "event_id string,user_id string,timestamp timestamp")
    kept = gold_wide.retention_span(events).first()
    assert (kept.cohort_size, kept.retained_day_1, kept.retained_day_30) == (2, 2, 1)
    known = gold_wide.retention_span(events, drop_anonymous=True).first()
    assert (known.cohort_size, known.retained_day_1, known.retained_day_7) == (2, 1, 1)
    assert (known.retention_day_7, known.retention_day_30) == (50.0, 0.0)
    assert (known.avg_days_active, known.avg_events_per_user) == (4.0, 1.5)


def test_cohort_of_anonymous_rows_only_has_no_rate(frame):
    events = frame([("1", None, "2024-01-01 00:00:00"), ("2", None, "2024-01-03 00:00:00")],
                   "event_id string,user_id string,timestamp timestamp")
    row = gold_wide.retention_span(events).first()
    assert (row.cohort_size, row.retained_day_1, row.retention_day_1) == (0, 1, None)


STOCK = ("sku string,category string,warehouse string,quantity_on_hand int,reorder_point int,"
         "unit_cost double,units_sold bigint,orders_count bigint")


def test_stock_turnover_shares_the_cost_equally(frame):
    stock = frame([
        ("1", "a", "w1", 10, 20, 2.0, 30, 3), ("2", "a", "w1", 0, 5, 2.0, None, None),
        ("3", "a", "w2", 0, None, 9.0, 0, 0), ("4", "b", "w1", 5, 1, 1.0, None, None),
    ], STOCK)
    got = {(r.category, r.warehouse): r
           for r in gold_wide.stock_turnover(stock, sample_wide(frame)).collect()}
    # purchases sum up to 129; three groups, 43 each
    first, second, third = got["a", "w1"], got["a", "w2"], got["b", "w1"]
    assert (first.turnover_ratio, first.days_of_supply, first.reorder_alert) == (2.15, 10.0, True)
    assert (second.turnover_ratio, second.days_of_supply, second.reorder_alert) == (0.0, 999.0, False)
    assert (third.turnover_ratio, third.units_sold, third.days_of_supply) == (8.6, None, 999.0)
    assert gold_wide.stock_turnover(stock).where("turnover_ratio <> 0").count() == 0


def test_inventory_turnover(frame):
    stock = align(frame([
        ("1", "a", 10, 20, 2.0, 5, 50.0, "low_stock"), ("2", "a", 0, None, 2.0, 5, 10.0, "out_of_stock"),
    ], "sku string,category string,quantity_on_hand int,reorder_point int,unit_cost double,"
       "total_quantity_sold bigint,total_sales_value double,stock_status string"), schemas.INVENTORY)
    row = gold.inventory_turnover(stock).first()
    assert tuple(row) == ("a", 2, 10, 10, 60.0, 0.25, 20.0, 1, 1, 50.0, 50.0)


@pytest.mark.parametrize("build", [
    lambda s: gold.daily_revenue(empty(s, schemas.TRANSACTIONS), empty(s, schemas.EVENTS)),
    lambda s: gold.user_retention(empty(s, schemas.EVENTS)),
    lambda s: gold.inventory_turnover(empty(s, schemas.INVENTORY)),
    lambda s: gold.sensor_anomaly(gold.readings_from_events(empty(s, schemas.EVENTS))),
    lambda s: gold_wide.revenue_breakdown(empty(s, schemas.WIDE_DOMAINS["transactions"])),
    lambda s: gold_wide.retention_span(empty(s, schemas.WIDE_DOMAINS["events"])),
    lambda s: gold_wide.stock_turnover(empty(s, schemas.WIDE_DOMAINS["inventory"])),
    lambda s: gold_wide.sensor_anomaly_by_location(
        gold.readings_from_raw(empty(s, schemas.PAYLOADS["iot_sensors"]))),
])
def test_empty_input_gives_an_empty_kpi(spark, build):
    assert build(spark).count() == 0


def test_empty_sensor_kpi_has_its_schema(spark):
    kpi = gold.sensor_anomaly(gold.readings_from_events(empty(spark, schemas.EVENTS)))
    assert dict(kpi.dtypes) == schemas.SENSOR_DAY


def test_kpi_columns_match_the_serving_contracts(spark):
    kpis = {
        "daily_revenue": gold.daily_revenue(
            empty(spark, schemas.TRANSACTIONS), empty(spark, schemas.EVENTS)),
        "user_retention": gold.user_retention(empty(spark, schemas.EVENTS)),
        "inventory_turnover": gold.inventory_turnover(empty(spark, schemas.INVENTORY)),
        "iot_anomaly_summary": gold.sensor_anomaly(
            gold.readings_from_events(empty(spark, schemas.EVENTS))),
    }
    for name, kpi in kpis.items():
        served = [*kpi.columns, "aggregated_at", "dt"]
        assert served == list(schemas.CONTRACTS[name].columns)
