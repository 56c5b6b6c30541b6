import json

import pytest
from pyspark.sql import functions as F

from shoreline.operators import envelope
from shoreline.streaming.records import collection_records

AT = "2026-04-18 01:02:03"


def land(spark, lines, topic="events.user"):
    records = collection_records(spark, lines, topic)
    at = F.lit(AT).cast("timestamp")
    return envelope.stream_rows(records, ingested_at=at).collect()


def test_good_record_keeps_payload_and_gains_lineage(spark):
    line = '{"event_id":"1","n":1.50,"deep":{"x":[1,2]},"timestamp":"2024-01-02T03:04:05Z"}'
    row, = land(spark, [line])
    assert (row.zone, row.source, row.dt, row.hour) == ("bronze", "user_events", "2024-01-02", "03")
    record = json.loads(row.value)
    assert record == {
        **json.loads(line),
        "_source": "user_events",
        "_kafka_topic": "events.user",
        "_kafka_partition": 0,
        "_kafka_offset": 0,
        "_job": envelope.STREAM_JOB,
        "_ingested_at": "2026-04-18T01:02:03.000000Z",
        "_raw": line,
    }
    assert '"n":1.50' in row.value


def test_envelope_keys_win_over_payload_keys(spark):
    row, = land(spark, ['{"_source":"fake","_raw":1,"a":1}'])
    record = json.loads(row.value)
    assert record["_source"] == "user_events" and record["a"] == 1
    assert record["_raw"] == '{"_source":"fake","_raw":1,"a":1}'
    assert row.value.count('"_source":') == 1


def test_empty_object_and_pretty_printed_object(spark):
    empty, pretty = land(spark, ["{ }", '{\n\t"a": 1\n}\n'])
    assert json.loads(empty.value)["_raw"] == "{ }"
    assert "\n" not in pretty.value and json.loads(pretty.value)["a"] == 1


@pytest.mark.parametrize("line, reason", [
    ("", "empty"),
    ("   ", "empty"),
    ('{"a":', "malformed_json"),
    ("not json", "malformed_json"),
    ('{"a":1} trailing', "malformed_json"),
    ('{"a":1}{"b":2}', "malformed_json"),
    ('{"a":1},{"b":2}', "malformed_json"),
    ('{"a":1}],[{"b":2}', "malformed_json"),
    ("[1,2]", "not_an_object"),
    ('"text"', "not_an_object"),
    ("null", "not_an_object"),
    ("3", "not_an_object"),
])
def test_bad_lines_go_to_dead_letter(spark, line, reason):
    row, = land(spark, [line])
    assert (row.zone, row.dt, row.hour) == ("dead_letter", "2026-04-18", "01")
    record = json.loads(row.value)
    assert record["_error_reason"] == reason and record["_raw"] == line
    assert record["_error_ts"] == "2026-04-18T01:02:03.000000Z"


def test_null_value_is_rejected(spark):
    row, = land(spark, [None])
    assert row.zone == "dead_letter"


def test_repeated_payload_key_keeps_the_last_value(spark):
    row, = land(spark, ['{"a":1,"a":2}'])
    assert row.zone == "bronze" and json.loads(row.value)["a"] == 2


@pytest.mark.parametrize("payload", ['{"a":1}', '{"timestamp":null}', '{"timestamp":"soon"}'])
def test_missing_event_time_falls_back_to_ingest_time(spark, payload):
    row, = land(spark, [payload])
    assert (row.zone, row.dt, row.hour) == ("bronze", "2026-04-18", "01")


def test_unmapped_topic(spark):
    row, = land(spark, ['{"a":1}'], topic="nobody.knows")
    assert row.source == "unknown"


def test_good_and_bad_add_up(spark):
    lines = ['{"a":1}', "x", "[]", "{}"]
    parsed = envelope.parse_records(collection_records(spark, lines, "t"))
    assert envelope.accepted(parsed).count() == 2
    assert envelope.rejected(parsed).count() == 2
