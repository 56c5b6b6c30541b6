import json

from shoreline import schemas
from shoreline.operators import envelope
from shoreline.sources import drops
from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake

DAY = "2026-04-17"


def test_csv_drop(spark, tmp_path):
    names = list(schemas.PAYLOADS["orders"])
    (tmp_path / "orders.csv").write_text(
        ",".join(names) + "\n"
        'o1,c1,p1,2,10.5,21.0,0,done,2026-04-01,"1, Main St"\n'
        "o2,c2,p2,two,10.5,21.0,0,done,2026-04-01,x\n")
    lake = Lake(str(tmp_path / "lake"))
    drops.land_drop(spark, str(tmp_path / "orders.csv"), "orders", lake, DAY)
    row, = tables.read_raw(spark, lake, "orders", DAY).collect()
    assert (row.order_id, row.quantity, row.shipping_address) == ("o1", 2, "1, Main St")
    assert row._source == "orders" and row._file_path.endswith("orders.csv")
    bad, = tables.read_dead_letter(spark, lake, "orders").collect()
    assert bad._error_reason == "malformed_record" and bad._raw.startswith("o2,")


def test_json_array_drop_keeps_nested_fields_and_can_be_repeated(spark, tmp_path):
    people = [
        {"customer_id": "c1", "email": "a", "preferences":
            {"newsletter": True, "sms_alerts": False, "preferred_channel": "email"}},
        {"customer_id": "c2", "email": None},
    ]
    (tmp_path / "crm.json").write_text(json.dumps(people, indent=2))
    lake = Lake(str(tmp_path / "lake"))
    for _ in range(2):
        drops.land_drop(spark, str(tmp_path / "crm.json"), "crm", lake, DAY)
    got = {r.customer_id: r for r in tables.read_raw(spark, lake, "crm", DAY).collect()}
    assert len(got) == 2 and tables.read_raw(spark, lake, "crm", DAY).count() == 2
    assert got["c1"].preferences.preferred_channel == "email"
    assert got["c1"]._ingested_at is not None


def test_batch_envelope_columns(spark, tmp_path):
    (tmp_path / "crm.json").write_text(json.dumps([{"customer_id": "c1"}]))
    drop = drops.read_drop(spark, str(tmp_path / "crm.json"), "crm")
    row = envelope.with_batch_envelope(drop, "crm").first()
    assert json.loads(row._raw) == {"customer_id": "c1"}
    assert row._job == envelope.BATCH_JOB and row._file_path.endswith("crm.json")


def crm(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_two_drops_of_a_day_and_a_repaired_one(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    names = ",".join(schemas.PAYLOADS["orders"])
    def order(key, quantity):
        return f"{key},c1,p1,{quantity},10.5,21.0,0,done,2026-04-01,x\n"
    morning = crm(tmp_path, "morning.csv", names + "\n" + order("o1", 2) + order("o2", "two"))
    evening = crm(tmp_path, "evening.csv", names + "\n" + order("o3", 1))
    for path in (morning, evening):
        drops.land_drop(spark, path, "orders", lake, DAY)
    found = lambda: sorted(r.order_id for r in tables.read_raw(spark, lake, "orders", DAY).collect())
    assert found() == ["o1", "o3"] and tables.read_dead_letter(spark, lake, "orders").count() == 1
    (tmp_path / "morning.csv").write_text(names + "\n" + order("o1", 2) + order("o2", 2))
    drops.land_drop(spark, morning, "orders", lake, DAY)
    assert found() == ["o1", "o2", "o3"] and tables.read_dead_letter(spark, lake, "orders").count() == 0


def test_a_named_drop_may_move(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for name in ("a.json", "b.json"):
        path = crm(tmp_path, name, json.dumps([{"customer_id": name}]))
        drops.land_drop(spark, path, "crm", lake, DAY, drop_id="crm-1")
    assert [r.customer_id for r in tables.read_raw(spark, lake, "crm", DAY).collect()] == ["b.json"]


def test_rows_of_a_drop_are_not_sorted_by_zone(spark, tmp_path, monkeypatch):
    names = list(schemas.PAYLOADS["orders"])
    (tmp_path / "orders.csv").write_text(",".join(names) + "\no1,c1,p1,2,10.5,21.0,0,done,2026-04-01,x\n")
    landed = []
    monkeypatch.setattr(drops, "replace_raw_batch", lambda rows, *_: landed.append(rows))
    drops.land_drop(spark, str(tmp_path / "orders.csv"), "orders", Lake(str(tmp_path / "lake")), DAY)
    session = landed[0].sparkSession
    landed[0].createOrReplaceTempView("landed_rows")
    session.sql(f"CREATE TABLE zones (value string, zone string) USING text PARTITIONED BY (zone) LOCATION '{tmp_path}/zones'")
    plan = session.sql("EXPLAIN INSERT INTO zones SELECT value, zone FROM landed_rows").first()[0]
    session.sql("DROP TABLE zones")
    assert "WriteFiles" in plan and "Sort" not in plan
