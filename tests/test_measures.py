import pytest
from pyspark.sql import functions as F

from shoreline.functions import measures
from shoreline.functions.temporal import calendar_days, event_bucket, parse_timestamp


def value(df, column):
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("on_hand, reorder, default, strict", [
    (0, 5, "low_stock", "out_of_stock"),
    (0, None, "out_of_stock", "out_of_stock"),
    (0, -1, "out_of_stock", "out_of_stock"),
    (5, 5, "low_stock", "low_stock"),
    (6, 5, "in_stock", "in_stock"),
    (None, 5, "in_stock", "in_stock"),
])
def test_stock_status(frame, on_hand, reorder, default, strict):
    df = frame([(on_hand, reorder)], "q int, r int")
    assert value(df, measures.stock_status("q", "r")) == default
    assert value(df, measures.stock_status("q", "r", out_of_stock_first=True)) == strict


def test_divisions_by_zero_are_null(frame):
    df = frame([(1, 0)], "a int, b int")
    assert value(df, measures.ratio("a", "b")) is None
    assert value(df, measures.percent("a", "b")) is None
    assert value(df, measures.z_score("a", "b", "b")) is None


def test_turnover_and_coverage(frame):
    df = frame([(30, 10), (0, 10), (5, 0), (5, None)], "sold int, hand int")
    got = [tuple(r) for r in df.select(
        measures.unit_turnover("sold", "hand"), measures.coverage_days("hand", "sold")
    ).collect()]
    assert got == [(3.0, 10.0), (0.0, 999.0), (0.0, 0.0), (0.0, None)]


def test_coverage_without_sales_figure(frame):
    df = frame([(None, 10)], "sold int, hand int")
    assert value(df, measures.coverage_days("hand", "sold")) == 999.0


def test_line_total(frame):
    df = frame([(3, 10.0, 15)], "q int, p double, d int")
    assert value(df, measures.line_total("q", "p", "d")) == 25.5


def test_anomaly_side(frame):
    df = frame([(0.0,), (5.0,), (11.0,), (None,)], "v double")
    got = [r[0] for r in df.select(measures.anomaly_side("v", F.lit(1.0), F.lit(10.0))).collect()]
    assert got == ["below_threshold", "normal", "above_threshold", "normal"]


def test_times(frame):
    df = frame([("2024-01-01T23:59:00Z", "2024-01-02 00:01:00", "nonsense")],
               "a string, b string, c string")
    a, b = parse_timestamp("a"), parse_timestamp("b")
    assert value(df, calendar_days(b, a)) == 1
    assert value(df, parse_timestamp("c")) is None
    bucket = event_bucket(parse_timestamp("c"), a)
    assert (value(df, bucket["dt"]), value(df, bucket["hour"])) == ("2024-01-01", "23")
