import json
import os

from pyspark.sql import functions as F

from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake
from shoreline.streaming import dedup, ingest
from shoreline.streaming.records import file_records

DAY = "2026-04-17"


def drop(root, topic, name, lines):
    folder = root / f"topic={topic}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def event(i, at=f"{DAY}T01:02:03Z"):
    return json.dumps({"event_id": f"e{i}", "user_id": "u", "timestamp": at})


def run(spark, tmp_path):
    records = file_records(spark, str(tmp_path / "in"))
    query = ingest.start_raw_ingest(
        records, Lake(str(tmp_path / "lake")), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()


def test_ingest_splits_routes_and_resumes(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drop(tmp_path / "in", "events.user", "a.txt", [event(1), "broken", "[1]", event(2)])
    drop(tmp_path / "in", "logs.app", "a.txt", [
        json.dumps({"log_id": "l1", "level": "INFO", "message": "m", "timestamp": f"{DAY}T05:00:00Z"})
    ])
    drop(tmp_path / "in", "strange", "a.txt", ['{"a":1}'])
    run(spark, tmp_path)
    users = tables.read_raw(spark, lake, "user_events", DAY)
    assert sorted(r.event_id for r in users.collect()) == ["e1", "e2"]
    assert users.first()._kafka_topic == "events.user" and users.first()._source == "user_events"
    assert tables.read_raw(spark, lake, "app_logs", DAY).first().log_id == "l1"
    assert list((tmp_path / "lake/raw/zone=bronze/source=user_events").glob(f"dt={DAY}/hour=01"))
    assert (tmp_path / "lake/raw/zone=bronze/source=unknown").exists()
    bad = tables.read_dead_letter(spark, lake, "user_events")
    assert sorted((r._raw, r._error_reason) for r in bad.collect()) == [
        ("[1]", "not_an_object"), ("broken", "malformed_json")]

    run(spark, tmp_path)
    assert tables.read_raw(spark, lake, "user_events", DAY).count() == 2
    drop(tmp_path / "in", "events.user", "b.txt", [event(3)])
    run(spark, tmp_path)
    assert sorted(r.event_id for r in tables.read_raw(spark, lake, "user_events", DAY).collect()) == [
        "e1", "e2", "e3"]


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    """The commit of a batch is lost; the restart writes the same batch again."""
    lake = Lake(str(tmp_path / "lake"))
    drop(tmp_path / "in", "events.user", "a.txt", [event(1), '{"no":"time"}', "bad"])
    run(spark, tmp_path)
    for commit in (tmp_path / "cp" / "commits").iterdir():
        commit.unlink()
    run(spark, tmp_path)
    whole = spark.read.text(lake.raw)
    assert whole.count() == 3
    assert whole.where("zone = 'bronze'").count() == 2


def test_console_run(spark, tmp_path):
    drop(tmp_path / "in", "events.user", "a.txt", [event(1)])
    query = ingest.start_console(file_records(spark, str(tmp_path / "in")))
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 1
    assert query.exception() is None


def dedup_run(spark, tmp_path, salts):
    schema = "event_id string, user_id string, timestamp timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    kept = dedup.first_delivery(stream, "event_id", salts=salts)
    out = str(tmp_path / f"out{salts}")
    query = (kept.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / f"cp{salts}"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sorted((r.event_id, str(r.timestamp)) for r in spark.read.parquet(out).collect())


def test_dedup_within_the_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batches = [
        [("a", "10:00:00"), ("a", "10:00:01"), ("b", "10:00:02"), (None, "10:00:02")] * 3,
        [("a", "10:00:20"), ("c", "10:10:00")],
        # the late filter follows the watermark one batch behind
        [("c", "10:10:01")],
        # far behind the watermark: too late
        [("d", "10:00:00"), ("c", "10:10:05")],
    ]
    for i, rows in enumerate(batches):
        lines = [json.dumps({"event_id": e, "user_id": "u", "timestamp": f"{DAY}T{t}Z"})
                 for e, t in rows]
        file = folder / f"{i}.json"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    plain = dedup_run(spark, tmp_path, salts=1)
    salted = dedup_run(spark, tmp_path, salts=8)
    assert [e for e, _ in plain] == ["a", "b", "c"]
    assert [e for e, _ in salted] == ["a", "b", "c"]


def test_hot_key_is_reduced_in_parallel(spark, tmp_path):
    hot = spark.range(0, 4000, numPartitions=8).select(
        F.lit("hot").alias("event_id"), F.lit("u").alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("timestamp"),
    )
    hot.write.json(str(tmp_path / "in"))
    assert len(dedup_run(spark, tmp_path, salts=8)) == 1


def test_two_ingests_and_a_reset_checkpoint_keep_all_rows(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    def ingest_from(folder, checkpoint):
        ingest.start_raw_ingest(
            file_records(spark, str(tmp_path / folder)), lake, str(tmp_path / checkpoint), available_now=True
        ).awaitTermination()
    drop(tmp_path / "a", "events.user", "a.txt", [event(1), event(2)])
    drop(tmp_path / "b", "events.user", "b.txt", [event(3)])
    ingest_from("a", "cpA")
    ingest_from("b", "cpB")
    ingest_from("b", "cpB")
    found = lambda: sorted(r.event_id for r in tables.read_raw(spark, lake, "user_events", DAY).collect())
    assert found() == ["e1", "e2", "e3"]
    # a lost checkpoint delivers again: nothing is lost, and keep-latest drops the second copy
    ingest_from("a", "cpA-new")
    assert sorted(set(found())) == ["e1", "e2", "e3"]
