import datetime as dt

from compare import plan_of
from shoreline import schemas
from shoreline.operators.shape import align, empty
from shoreline.plans import silver, silver_wide

DAY = "2026-04-17"


def raw(spark, frame, source, rows, schema):
    return align(frame(rows, schema), schemas.raw_columns(source))


def test_events_merge_both_sources(spark, frame):
    users = raw(spark, frame, "user_events", [
        ("e1", "u1", "2026-04-17 10:00:00", "2026-04-17 10:01:00"),
    ], "event_id string, user_id string, timestamp timestamp, _ingested_at timestamp")
    clicks = raw(spark, frame, "clickstream", [
        ("r1", "/home", 200, "2026-04-17 11:00:00", "2026-04-17 11:01:00"),
    ], "request_id string, path string, status_code int, timestamp timestamp, _ingested_at timestamp")
    out = silver.events(users, clicks, DAY)
    assert out.columns == list(schemas.DOMAINS["events"])
    rows = {r.event_id: r for r in out.collect()}
    assert rows["e1"].event_source == "user_events" and rows["e1"].path is None
    assert rows["r1"].event_source == "clickstream"
    assert (rows["r1"].page_url, rows["r1"].request_id, rows["r1"].user_id) == ("/home", "r1", None)
    assert rows["r1"].dt == dt.date(2026, 4, 17)


def test_newer_incomplete_row_replaces_older_complete_one(spark, frame):
    users = raw(spark, frame, "user_events", [
        ("e1", "u1", "2026-04-17 10:00:00", "2026-04-17 10:01:00"),
        ("e1", "u1", None, "2026-04-17 10:02:00"),
        (None, "u2", "2026-04-17 10:00:00", "2026-04-17 10:01:00"),
        ("e2", "u2", "2026-04-17 10:00:00", "2026-04-17 10:01:00"),
    ], "event_id string, user_id string, timestamp timestamp, _ingested_at timestamp")
    out = silver.events(users, empty(spark, schemas.raw_columns("clickstream")), DAY)
    assert [r.event_id for r in out.collect()] == ["e2"]


def test_keys_collide_across_sources_only_in_the_per_domain_form(spark, frame):
    schema = "event_id string, user_id string, timestamp timestamp, _ingested_at timestamp"
    users = raw(spark, frame, "user_events", [
        ("x", "u1", "2026-04-17 10:00:00", "2026-04-17 10:01:00")], schema)
    clicks = raw(spark, frame, "clickstream", [
        ("x", "/p", "2026-04-17 10:00:00", "2026-04-17 10:05:00")],
        "request_id string, path string, timestamp timestamp, _ingested_at timestamp")
    assert [r.event_source for r in silver.events(users, clicks, DAY).collect()] == ["clickstream"]
    assert silver_wide.events(users, clicks, DAY).count() == 2


def test_payment_dates_become_timestamps(spark, frame):
    pays = raw(spark, frame, "payments", [
        ("p1", 5.0, "2026-04-17", "2026-04-17 10:00:00"),
        ("p2", 5.0, "17/04/2026", "2026-04-17 10:00:00"),
        ("p3", None, "2026-04-17", "2026-04-17 10:00:00"),
    ], "payment_id string, amount double, payment_date string, _ingested_at timestamp")
    txns = empty(spark, schemas.raw_columns("transactions"))
    out = silver.transactions(txns, pays, DAY).collect()
    assert [(r.transaction_id, r.timestamp) for r in out] == [("p1", dt.datetime(2026, 4, 17))]
    wide = silver_wide.transactions(None, pays, DAY)
    assert sorted(r.txn_id for r in wide.collect()) == ["p1", "p2"]


CRM = "customer_id string, email string, _ingested_at timestamp"
ORDERS = "order_id string, customer_id string, total_amount double, order_date string"


def people(spark, frame):
    return raw(spark, frame, "crm", [
        ("c1", "a@x", "2026-04-17 10:00:00"), ("c1", "b@x", "2026-04-17 11:00:00"),
        ("c2", None, "2026-04-17 10:00:00"), (None, "n@x", "2026-04-17 10:00:00"),
    ], CRM)


def purchases(spark, frame):
    return raw(spark, frame, "orders", [
        ("o1", "c1", 10.0, "2026-01-02"), ("o2", "c1", 20.0, "2026-03-01"),
        ("o2", "c1", 20.0, "2026-03-01"), ("o3", "c9", 1.0, "2026-01-01"),
        ("o4", None, 1.0, "2026-01-01"),
    ], ORDERS)


def test_customers_get_totals_or_zeros(spark, frame):
    out = silver.customers(people(spark, frame), purchases(spark, frame), DAY)
    got = {r.customer_id: (r.email, r.total_orders, r.total_order_value, r.latest_order_date,
                           r.avg_order_value) for r in out.collect()}
    assert got == {"c1": ("b@x", 3, 50.0, "2026-03-01", 50 / 3), "c2": (None, 0, 0.0, None, 0.0)}
    assert out.columns == list(schemas.DOMAINS["customers"])


def test_customers_with_deduplicated_orders(spark, frame):
    out = silver.customers(people(spark, frame), purchases(spark, frame), DAY, dedup_orders=True)
    assert {r.customer_id: r.total_orders for r in out.collect()} == {"c1": 2, "c2": 0}


def test_order_totals_use_hash_aggregation(spark, frame):
    plan = plan_of(silver.customers(people(spark, frame), purchases(spark, frame), DAY))
    assert "SortAggregate" not in plan


def test_wide_customers_and_fallbacks(spark, frame):
    crm, orders = people(spark, frame), purchases(spark, frame)
    both = {r.customer_id: (r.total_orders, r.total_spent)
            for r in silver_wide.customers(crm, orders, DAY).collect()}
    assert both == {"c1": (3, 50.0)}
    only_crm = silver_wide.customers(crm, None, DAY).collect()
    assert [(r.customer_id, r.total_orders, r.total_spent) for r in only_crm] == [("c1", 0, 0.0)]
    only_orders = silver_wide.customers(None, orders, DAY)
    assert only_orders.columns == ["customer_id", "total_orders", "total_spent", "_source",
                                   "_processed_at", "dt"]
    assert {r.customer_id for r in only_orders.collect()} == {"c1", "c9", None}
    assert silver_wide.customers(None, None, DAY) is None


def test_inventory(spark, frame):
    stock = raw(spark, frame, "inventory", [
        ("s1", 5, 10, "2026-04-17 10:00:00"), ("s2", 0, None, "2026-04-17 10:00:00"),
        ("s3", 50, 10, "2026-04-17 10:00:00"),
    ], "sku string, quantity_on_hand int, reorder_point int, _ingested_at timestamp")
    lines = raw(spark, frame, "orders", [
        ("o1", "s1", 2, 4.0), ("o2", "s1", 3, 6.0), ("o3", "zz", 1, 1.0),
    ], "order_id string, product_id string, quantity int, total_amount double")
    out = silver.inventory(stock, lines, DAY)
    assert out.columns == list(schemas.DOMAINS["inventory"])
    assert {r.sku: (r.total_quantity_sold, r.total_orders, r.total_sales_value, r.stock_status)
            for r in out.collect()} == {
        "s1": (5, 2, 10.0, "low_stock"), "s2": (0, 0, 0.0, "out_of_stock"),
        "s3": (0, 0, 0.0, "in_stock"),
    }
    wide = {r.sku: (r.orders_count, r.units_sold)
            for r in silver_wide.inventory(stock, lines, DAY).collect()}
    assert wide == {"s1": (2, 5), "s2": (None, None), "s3": (None, None)}
    bare = {(r.orders_count, r.units_sold) for r in silver_wide.inventory(stock, None, DAY).collect()}
    assert bare == {(0, 0)}
    assert silver_wide.inventory(None, lines, DAY) is None
    assert silver_wide.events(None, None, DAY) is None


def test_conform_to_declared_domain_schema(spark, frame):
    from shoreline.operators.shape import conform

    wide = silver_wide.customers(people(spark, frame), purchases(spark, frame), DAY)
    typed = conform(wide, schemas.WIDE_DOMAINS["customers"])
    assert dict(typed.dtypes) == schemas.WIDE_DOMAINS["customers"]


def test_domain_types_are_the_declared_ones(spark):
    empty_of = {s: empty(spark, schemas.raw_columns(s)) for s in schemas.PAYLOADS}
    built = {
        "events": silver.events(empty_of["user_events"], empty_of["clickstream"], DAY),
        "transactions": silver.transactions(empty_of["transactions"], empty_of["payments"], DAY),
        "customers": silver.customers(empty_of["crm"], empty_of["orders"], DAY),
        "inventory": silver.inventory(empty_of["inventory"], empty_of["orders"], DAY),
    }
    for domain, df in built.items():
        assert dict(df.dtypes) == schemas.DOMAINS[domain]
