"""Late rows and silent sources over several micro-batches."""

from __future__ import annotations

import datetime
import json

from shoreline.sources import lake as tables
from shoreline.sources.lake import Lake
from shoreline.streaming import ingest
from shoreline.streaming.lateness import MICRO, Heard, Lateness, ProgressLog, advanced, watermark
from shoreline.streaming.records import file_records

DAY = "2026-04-17"
UTC = datetime.timezone.utc


def event(n, time):
    return json.dumps({"event_id": f"e{n}", "user_id": "u", "timestamp": f"{DAY}T{time}Z"})


def test_late_rows_are_kept_apart_by_source(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for topic in ("events.user", "clicks.web"):
        (tmp_path / "in" / f"topic={topic}").mkdir(parents=True)

    def arrive(name, **topics):
        for topic, lines in topics.items():
            (tmp_path / "in" / f"topic={topic.replace('_', '.')}" / name).write_text("\n".join(lines) + "\n")
        running = ingest.start_raw_ingest(
            file_records(spark, str(tmp_path / "in")), lake, str(tmp_path / "cp"), available_now=True, lateness=Lateness())
        running.awaitTermination()
        return ProgressLog(spark, lake, f"ingest-{running.id}").before()

    def found():
        late = tables.read_dead_letter(spark, lake, "user_events")
        return (sorted(r.event_id for r in tables.read_raw(spark, lake, "user_events", DAY).collect()),
                [] if late is None else sorted((json.loads(r._raw).get("event_id"), r._error_reason) for r in late.collect()))

    # nothing is late within the first batch, however mixed up
    arrive("a.txt", events_user=[event(1, "10:00:00"), event(2, "09:00:00")])
    assert found() == (["e1", "e2"], [])
    # 30 seconds behind the latest one of the batches before is still in time; a time far ahead moves nothing
    progress = arrive("b.txt", events_user=[
        event(3, "09:59:30"), event(4, "09:59:29.999999"), event(1, "09:00:00"), event(5, "10:05:00"),
        json.dumps({"event_id": "e6", "timestamp": "2999-01-01T00:00:00Z"})])
    assert found()[0] == ["e1", "e2", "e3", "e5"]
    assert found()[1] == [("e1", "late_record"), ("e4", "late_record")]
    assert progress["user_events"].latest == round(datetime.datetime(2026, 4, 17, 10, 5, tzinfo=UTC).timestamp() * MICRO)
    # another source has its own time; rows without one are never late
    progress = arrive("c.txt", clicks_web=[json.dumps({"request_id": "r", "timestamp": f"{DAY}T08:00:00Z"})],
                      events_user=[json.dumps({"event_id": "e7"})])
    assert tables.read_raw(spark, lake, "clickstream", DAY).count() == 1 and len(found()[1]) == 2
    assert set(progress) == {"user_events", "clickstream"}


def test_a_retried_batch_decides_as_before(spark, tmp_path):
    log = ProgressLog(spark, Lake(str(tmp_path)), "x")
    assert log.before() == {}
    log.note(0, {"a": Heard(10, 1)})
    log.note(1, {"a": Heard(20, 2)})
    log.note(1, {"a": Heard(99, 9)})
    assert log.before(1) == {"a": Heard(10, 1)} and log.before() == {"a": Heard(20, 2)}


def test_progress_never_goes_back():
    seen = {"at": 7, "rows_0": 2, "latest_0": 5, "rows_1": 1, "latest_1": None, "rows_2": 0, "latest_2": None}
    assert advanced({"a": Heard(9, 1), "c": Heard(3, 1)}, seen, ["a", "b", "c"]) == {
        "a": Heard(9, 7), "b": Heard(None, 7), "c": Heard(3, 1)}


def test_a_silent_source_does_not_hold_back_the_watermark():
    def at(seconds):
        return datetime.datetime.fromtimestamp(seconds, UTC)

    progress = {"a": Heard(1000 * MICRO, 5000 * MICRO), "slow": Heard(100 * MICRO, 4950 * MICRO)}
    assert watermark(progress, now=at(5000)) == at(70)
    assert watermark(progress, now=at(5010)) == at(70)
    assert watermark(progress, now=at(5011)) == at(970)
    # when all are silent the last one heard of counts
    assert watermark(progress, now=at(9999)) == at(970)
    assert watermark({}, now=at(1)) is None
    assert watermark({"a": Heard(None, 5000 * MICRO)}, now=at(5000)) is None
