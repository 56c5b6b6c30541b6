"""Commits and rolling: failures and races leave whole data, files get few."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shoreline.sources import commits, drops
from shoreline.sources import lake as tables
from shoreline.sources.commits import Folder
from shoreline.sources.lake import Lake
from shoreline.streaming import ingest, rolling
from shoreline.streaming.records import file_records

DAY = "2026-04-17"


def dated(frame, rows):
    return frame(rows, "id int,v int,dt date")


def contents(spark, path):
    return sorted((r.id, r.v, str(r.dt)) for r in tables.read_all(spark, path).collect())


def failing(df):
    """The frame, with a last row that can't be computed."""
    return df.withColumn("v", F.when(F.col("id") == 9, F.raise_error("broken")).otherwise(F.col("v")).cast("int"))


def test_a_failed_write_changes_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_date(dated(frame, [(1, 1, DAY), (2, 2, DAY)]), path, DAY)
    with pytest.raises(Exception, match="broken"):
        tables.write_date(failing(dated(frame, [(3, 3, DAY), (9, 9, DAY)])), path, DAY)
    with pytest.raises(Exception, match="broken"):
        tables.write_table(failing(dated(frame, [(3, 3, DAY), (9, 9, DAY)])), path)
    assert contents(spark, path) == [(1, 1, DAY), (2, 2, DAY)]
    assert tables.read_partition(spark, path, DAY).count() == 2


def test_a_failed_commit_changes_nothing(spark, frame, tmp_path, monkeypatch):
    """The job has ended; the driver dies before the switch."""
    path = str(tmp_path / "t")
    tables.write_date(dated(frame, [(1, 1, DAY)]), path, DAY)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            tables.write_date(dated(frame, [(3, 3, DAY)]), path, DAY)
    assert contents(spark, path) == [(1, 1, DAY)]
    # what it left is cleared once it is old
    assert commits.vacuum(spark, path, 3600) == []
    assert len(commits.vacuum(spark, path, 3600, now=time.time() + 7200)) == 1
    assert contents(spark, path) == [(1, 1, DAY)]


def test_a_reader_keeps_the_rows_it_began_with(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_date(dated(frame, [(1, 1, DAY)]), path, DAY)
    before = tables.read_all(spark, path)
    tables.write_date(dated(frame, [(2, 2, DAY)]), path, DAY)
    assert [r.id for r in before.collect()] == [1] and contents(spark, path) == [(2, 2, DAY)]
    # a plain reader of the folder sees no superseded rows
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(path)


def test_plain_dates_count_until_they_are_written_anew(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    old = dated(frame, [(1, 1, DAY), (2, 2, "2026-04-18")])
    old.write.partitionBy("dt").parquet(path)
    assert contents(spark, path) == [(1, 1, DAY), (2, 2, "2026-04-18")]
    tables.write_date(dated(frame, [(3, 3, DAY)]), path, DAY)
    assert contents(spark, path) == [(2, 2, "2026-04-18"), (3, 3, DAY)]
    assert sorted(r.id for r in tables.read_range(spark, path, "2026-04-18", 2).collect()) == [2, 3]


def test_writers_that_meet_both_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create = Folder.create
    met = []

    def slow(self, name, text):
        if not met:
            met.append(1)
            commits.commit(spark, path, {"dt=b": {"folders": ["b"]}})
        return create(self, name, text)

    monkeypatch.setattr(Folder, "create", slow)
    assert commits.commit(spark, path, {"dt=a": {"folders": ["a"]}}) == 2
    assert set(commits.current(spark, path)) == {"dt=a", "dt=b"}


def test_a_failed_drop_leaves_both_zones(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    head = ",".join(["order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "discount", "status",
                     "order_date", "shipping_address"])

    def land(*orders):
        lines = [f"{o},c1,p1,{q},10.5,21.0,0,done,2026-04-01,x" for o, q in orders]
        (tmp_path / "orders.csv").write_text("\n".join([head, *lines]) + "\n")
        drops.land_drop(spark, str(tmp_path / "orders.csv"), "orders", lake, DAY)

    def found():
        good = tables.read_raw(spark, lake, "orders", DAY).collect()
        return sorted(r.order_id for r in good), tables.read_dead_letter(spark, lake, "orders").count()

    land(("o1", 1), ("o2", "two"))
    assert found() == (["o1"], 1)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            land(("o3", 1), ("o4", "four"), ("o5", "five"))
    assert found() == (["o1"], 1)
    land(("o3", 1))
    assert found() == (["o3"], 0)
    assert rolling.vacuum_raw(spark, lake, "orders", DAY, 0, now=time.time() + 10)
    assert found() == (["o3"], 0)


def event(n, minute):
    return json.dumps({"event_id": f"e{n}", "user_id": "u", "event_type": "view", "timestamp": f"{DAY}T01:{minute:02d}:00Z"})


def files(lake):
    from pathlib import Path

    return len([p for p in Path(lake.raw).rglob("part-*") if "_versions" not in str(p)])


def start(spark, tmp_path, lake, policy):
    records = file_records(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    ingest.start_raw_ingest(records, lake, str(tmp_path / "cp"), available_now=True, policy=policy).awaitTermination()


def test_small_files_are_rolled(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    folder = tmp_path / "in" / "topic=events.user"
    folder.mkdir(parents=True)
    for i in range(4):
        (folder / f"{i}.txt").write_text("\n".join([event(i, i), event(10 + i, i), "bad"]) + "\n")
    start(spark, tmp_path, lake, rolling.RollPolicy(age=1e9, idle=1e9))

    def found():
        rows = tables.read_raw(spark, lake, "user_events", DAY).collect()
        return sorted(r.event_id for r in rows), sum(
            tables.read_dead_letter(spark, lake, s).count() for s in ("user_events",))

    before = found()
    assert before == (sorted([f"e{i}" for i in (0, 1, 2, 3, 10, 11, 12, 13)]), 4)
    hours = rolling.batches(spark, lake, "user_events", DAY)
    assert len(hours["hour=01"]) == 4
    inputs = tables.raw_inputs(spark, lake, "user_events", DAY)
    now = max(b.last for b in hours["hour=01"])
    assert rolling.roll(spark, lake, "user_events", DAY, rolling.RollPolicy(idle=100), now + 99) == 0
    assert rolling.roll(spark, lake, "user_events", DAY, rolling.RollPolicy(idle=100), now + 101) == 4
    bad_date = tables.raw_dates(spark, lake, "user_events", "dead_letter")[-1]
    rolling.roll(spark, lake, "user_events", bad_date, rolling.RollPolicy(idle=0))
    assert found() == before
    assert [len(b.sizes) for b in rolling.batches(spark, lake, "user_events", DAY)["hour=01"]] == [1]
    assert tables.raw_inputs(spark, lake, "user_events", DAY) == inputs
    # a late batch joins the rolled file; one that is not whole stays out
    (folder / "late.txt").write_text(event(20, 5) + "\n")
    start(spark, tmp_path, lake, rolling.RollPolicy(age=0))
    assert [len(b.sizes) for b in rolling.batches(spark, lake, "user_events", DAY)["hour=01"]] == [1]
    assert "e20" in found()[0] and len(tables.raw_inputs(spark, lake, "user_events", DAY)) == len(inputs) + 1
    rolling.vacuum_raw(spark, lake, "user_events", DAY, 0, now=time.time() + 10)
    assert "e20" in found()[0] and files(lake) < 6


def test_parts_are_filled_and_full_ones_stay(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    line = json.dumps({"event_id": "x" * 500})
    rows = spark.range(400).select(
        F.lit(line).alias("value"), F.lit("bronze").alias("zone"), F.lit("crm").alias("source"), F.lit(DAY).alias("dt"),
        F.lit("00").alias("hour"))
    for i in range(3):
        tables.write_raw(rows.repartition(5), lake, f"b{i}")
    policy = rolling.RollPolicy(part_bytes=100_000, idle=0)
    total = sum(sum(b.sizes) for b in rolling.batches(spark, lake, "crm", DAY)["hour=00"])
    assert rolling.roll(spark, lake, "crm", DAY, policy) == 15
    after = [s for b in rolling.batches(spark, lake, "crm", DAY)["hour=00"] for s in b.sizes]
    assert sum(after) == total and len(after) <= 2 * -(-total // policy.part_bytes) and max(after) <= policy.part_bytes + 600
    assert tables.read_raw(spark, lake, "crm", DAY).count() == 1200
    assert rolling.roll(spark, lake, "crm", DAY, policy) == 0


def test_a_batch_that_is_not_whole_is_not_rolled(spark, frame, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = frame([("{}", "bronze", "crm", DAY, "00")], "value string,zone string,source string,dt string,hour string")
    for name in "abc":
        tables.write_raw(rows, lake, name)
    Folder(spark, lake.raw).delete("_landed/c")
    assert rolling.roll(spark, lake, "crm", DAY, rolling.RollPolicy(idle=0)) == 2
    assert tables.read_raw(spark, lake, "crm", DAY).count() == 3


def test_compressed_batches_are_small_and_read_in_small_tasks_but_not_rolled(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    line = F.to_json(F.struct(F.concat(F.lit("customer-"), F.col("id")).alias("customer_id"), F.lit("crm").alias("_source")))
    rows = spark.range(20_000).select(
        line.alias("value"), F.lit("bronze").alias("zone"), F.lit("crm").alias("source"), F.lit(DAY).alias("dt"),
        F.lit("00").alias("hour"))
    plain = Lake(str(tmp_path / "plain"))
    tables.write_raw(rows, plain, "a")
    for name in "ab":
        tables.write_raw(rows, lake, name, packed=True)
    stored = [sum(f.stat().st_size for f in Path(x.raw).rglob("batch=a/part-*")) for x in (lake, plain)]
    assert 5 * stored[0] < stored[1]
    found = tables.read_raw(spark, lake, "crm", DAY)
    assert found.count() == 40_000 and found.select("customer_id").distinct().count() == 20_000
    assert found.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") == str(tables.PACKED_BYTES)
    assert found.sparkSession.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert tables.read_raw(spark, plain, "crm", DAY).sparkSession is spark
    assert rolling.roll(spark, lake, "crm", DAY, rolling.RollPolicy(idle=0)) == 0
    tables.write_raw(rows, lake, "c")
    tables.write_raw(rows, lake, "d")
    assert rolling.roll(spark, lake, "crm", DAY, rolling.RollPolicy(idle=0)) > 0
    assert tables.read_raw(spark, lake, "crm", DAY).count() == 80_000
