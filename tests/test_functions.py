import datetime as dt

import pytest
from pyspark.sql import functions as F

from fogline.functions import temporal as tm
from fogline.functions import text as tx


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def values(spark, ddl, data, column):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], ddl).select(column).collect()]


@pytest.mark.parametrize(
    "first,last,start,end",
    [
        ("2026-01-05", "2026-01-05", dt.datetime(2026, 1, 5, 8), dt.datetime(2026, 1, 6, 8)),
        ("2026-03-08", "2026-03-08", dt.datetime(2026, 3, 8, 8), dt.datetime(2026, 3, 9, 7)),
        ("2026-11-01", "2026-11-01", dt.datetime(2026, 11, 1, 7), dt.datetime(2026, 11, 2, 8)),
    ],
)
def test_pacific_range(spark, first, last, start, end):
    lo, hi = tm.pacific_range_to_utc(first, last)
    assert (one(spark, lo), one(spark, hi)) == (start, end)


def test_pacific_range_needs_both_dates():
    assert tm.pacific_range_to_utc(None, "2026-01-01") == (None, None)
    with pytest.raises(ValueError):
        tm.pacific_range_to_utc("2026-02-30", "2026-03-01")


def test_pacific_parts(spark):
    ts = F.lit("2026-06-24 06:59:59.000001").cast("timestamp")
    assert one(spark, tm.pacific_date(ts)) == dt.date(2026, 6, 23)
    assert one(spark, tm.pacific_tod_us(ts)) == tm.tod_us("23:59:59") + 1
    assert one(spark, tm.pacific_tod_text(ts)) == "23:59:59.000001"
    assert one(spark, tm.utc_to_pacific_date_text(ts)) == "2026-06-23"
    assert tm.tod_us("23:59") == (23 * 60 + 59) * 60_000_000


def test_floating_times_by_source(spark):
    text = F.lit("2026-07-01T01:30:00.000")
    assert one(spark, tm.local_text_to_utc(text, tm.PACIFIC)) == dt.datetime(2026, 7, 1, 8, 30)
    assert one(spark, tm.text_to_utc(text)) == dt.datetime(2026, 7, 1, 1, 30)
    assert values(spark, "v string", ["", "x", None, "2026-13-01"], tm.text_to_utc(F.col("v"))) == [None] * 4
    # Ambiguous autumn hour: the earlier offset.
    assert one(spark, tm.local_text_to_utc(F.lit("2026-11-01T01:30:00"), tm.PACIFIC)) == dt.datetime(2026, 11, 1, 8, 30)


def test_snapshot_names(spark):
    names = [
        "raw/TripUpdates/muni/2026-06-23/2026-06-23T10-11-12.000345Z.pb",
        "2026-06-23T10-11-12.5Z.pb",
        "raw/TripUpdates/muni/2026-06-23/latest.pb",
        None,
    ]
    assert values(spark, "v string", names, tm.snapshot_ts_from_path(F.col("v"))) == [
        dt.datetime(2026, 6, 23, 10, 11, 12, 345), dt.datetime(2026, 6, 23, 10, 11, 12, 500000), None, None,
    ]


def test_past_dates(spark):
    """Whole days before the pinned one; the day itself, later days and what is no date do not count."""
    pinned = F.lit("2031-03-01").cast("date")
    expected = {"2031-02-28": True, "2031-03-01": False, "2031-03-02": False, "1999-12-31": True, "2031-02-29": False, "soon": False, " 2030-01-01": True}
    assert values(spark, "v string", list(expected), tm.is_past_date(F.col("v"), pinned)) == list(expected.values())
    assert values(spark, "v string", [None], tm.is_past_date(F.col("v"), pinned)) == [False]


def test_service_dates(spark):
    fallback = F.lit("2026-06-23").cast("date")
    assert values(spark, "v string", ["20260102", "bad", None, ""], tm.yyyymmdd_or(F.col("v"), fallback)) == [
        dt.date(2026, 1, 2), *[dt.date(2026, 6, 23)] * 3,
    ]


def test_lookback_dates():
    assert tm.lookback_dates("2026-03-01", 10) == (dt.date(2026, 2, 20), dt.date(2026, 3, 1))
    assert tm.lookback_dates("2026-03-01", 1) == (dt.date(2026, 3, 1),) * 2
    with pytest.raises(ValueError):
        tm.lookback_dates("2026-03-01", 0)


@pytest.mark.parametrize("interval,expected", [(0, [1, 1, 1, 1]), (60, [1, 1, 1, 1]), (90, [1, 0, 1, 0]), (180, [1, 0, 0, 1])])
def test_slots(spark, interval, expected):
    stamps = [dt.datetime(1970, 1, 1, 0, m, 30) for m in range(4)]
    got = values(spark, "v timestamp", stamps, tm.on_slot(F.col("v"), interval))
    assert got == [bool(e) for e in expected]


def test_seconds_between_keeps_fractions(spark):
    a, b = F.lit("2026-01-01 00:00:01.5").cast("timestamp"), F.lit("2026-01-01").cast("timestamp")
    assert one(spark, tm.seconds_between(a, b)) == 1.5
    assert one(spark, tm.floor_hour(a)) == dt.datetime(2026, 1, 1)


def test_names_and_categories(spark):
    assert values(spark, "v string", ["golden GATE", "x", ""], tx.capitalize_first(F.col("v"))) == ["Golden gate", "X", ""]
    assert values(spark, "v string", ["St. Mary's", None], tx.normalise_name(F.col("v"))) == ["st. marys", None]
    assert values(spark, "v string", [" a ", "  ", "", None], tx.category_or_unknown(F.col("v"))) == ["a", "Unknown", "Unknown", "Unknown"]
    assert values(spark, "v string", ["53.0", "53", " 53.5", "none", "", None, "abc", "1e2"], tx.normalise_boundary_id(F.col("v"))) == ["53", "53", "53.5", None, None, None, "abc", "100"]
    assert values(spark, "v string", ["trip-stops", "9a", "__", ""], tx.sanitise_identifier(F.col("v"), "transit")) == ["trip_stops", "x_9a", "transit", "transit"]
    assert one(spark, tx.agency_mappings(F.lit(" muni:SF , ,bart: BA"))) == {"muni": "SF", "bart": "BA"}
    assert one(spark, tx.strip_bom(F.lit("﻿{}"))) == "{}"
    assert one(spark, tx.last_path_part(F.lit("a/b/c.pb"))) == "c.pb"


def labels(spark, ddl, expected, column):
    assert values(spark, ddl, list(expected), column) == list(expected.values())


def test_labels(spark):
    delays = {None: "N/A", 0.0: "0.0 min on time", 0.49: "0.0 min on time", -0.49: "0.0 min on time", 30.0: "0.5 min late",
              -30.0: "0.5 min early", 66.0: "1.1 min late", -600.0: "10.0 min early", 36000.0: "600.0 min late"}
    labels(spark, "v double", delays, tx.delay_label(F.col("v")))
    labels(spark, "v double", {None: "N/A", 0.0: "0.0%", 0.5: "0.5%", 33.33: "33.3%", 99.96: "100.0%"}, tx.percent_label(F.col("v")))
    labels(spark, "v double", {None: "N/A", 0.0: "$0", 999.4: "$999", 12000.0: "$12,000", 7654321.0: "$7,654,321"}, tx.currency_label(F.col("v")))
    labels(spark, "v bigint", {None: "N/A", 0: "0", 12: "12", 45678: "45,678"}, tx.count_label(F.col("v")))
    labels(spark, "v bigint", {None: "0 listings", 0: "0 listings", 1: "1 listing", 2: "2 listings", 3210: "3,210 listings"}, tx.listing_label(F.col("v")))
    labels(spark, "v date", {dt.date(2030, 12, 25): "Dec 25, 2030", dt.date(2031, 2, 7): "Feb 7, 2031", None: "today"}, tx.date_label(F.col("v")))


def test_byte_labels(spark):
    sizes = {0: "0.0 B", 7: "7.0 B", 1000: "1000.0 B", 2048: "2.0 KB", 2560: "2.5 KB", 3 * 2**20: "3.0 MB", 2**30 + 2**29: "1.5 GB", 2**41: "2.0 TB", 2**52: "4.0 PB"}
    labels(spark, "v bigint", sizes, tx.bytes_label(F.col("v")))


def test_json_cells(spark):
    df = spark.createDataFrame([((1, "a"),), (None,)], "v struct<x:int,y:string>")
    assert [r[0] for r in df.select(tx.json_cell(F.col("v"))).collect()] == ['{"x":1,"y":"a"}', ""]
