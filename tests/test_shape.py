import datetime as dt

from pyspark.sql import functions as F

from shoreline import schemas
from shoreline.operators import shape


def test_align_orders_pads_and_overrides(frame):
    df = frame([("x", 1)], "b string, a int")
    out = shape.align(df, {"a": "int", "b": "string", "c": "double"}, b="'y'")
    assert out.columns == ["a", "b", "c"]
    assert out.dtypes[2] == ("c", "double")
    assert tuple(out.first()) == (1, "y", None)


def test_conform_turns_misfits_into_null(frame):
    df = frame([("7", "2024-02-30", "1e2")], "n string, d string, x string")
    out = shape.conform(df, {"n": "int", "d": "date", "x": "double", "v": "varchar(3)"}).first()
    assert tuple(out) == (7, None, 100.0, None)


def test_cast_times_parses_text_only(frame):
    df = frame([("2024-01-01T00:00:00Z", "bad", "2024-01-01")],
               "timestamp string, _ingested_at string, other string")
    out = shape.cast_times(df).first()
    assert out.timestamp == dt.datetime(2024, 1, 1)
    assert out._ingested_at is None and out.other == "2024-01-01"


def test_rename_only_if_target_is_free(frame):
    df = frame([("r", "e")], "request_id string, event_id string")
    assert shape.rename_if_free(df, "request_id", "event_id").columns == df.columns
    one = df.select("request_id")
    assert shape.rename_if_free(one, "request_id", "event_id").columns == ["event_id"]


def test_select_existing_keeps_order(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert shape.select_existing(df, ["c", "x", "a"]).columns == ["c", "a"]


def test_stack_by_name_widens_void(spark, frame):
    left = frame([(1.5,)], "x double")
    right = spark.range(1).select(F.lit(None).alias("x"), F.lit("r").alias("tag"))
    out = shape.stack_by_name(left, right)
    assert dict(out.dtypes) == {"x": "double", "tag": "string"}
    assert out.count() == 2


def test_empty_has_the_declared_columns(spark):
    out = shape.empty(spark, schemas.SENSOR_DAY)
    assert out.count() == 0 and out.columns == list(schemas.SENSOR_DAY)


def test_stamp(frame):
    out = shape.stamp(frame([(1,)], "a int"), "2026-04-17").first()
    assert out.dt == dt.date(2026, 4, 17) and out._processed_at is not None
