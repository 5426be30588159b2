"""Bucket starts against Python's calendar, for all units, column types and session zones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.operators import aggregations as A

MOMENTS = [
    dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(1970, 1, 1), dt.datetime(1999, 12, 31, 23, 0, 1),
    dt.datetime(2000, 2, 29, 12, 30, 15), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 15, 59),
    dt.datetime(2024, 12, 30, 0, 0), dt.datetime(2026, 6, 28, 23, 59, 59),
]


def start(moment, unit):
    day = moment.replace(hour=0, minute=0, second=0)
    return {
        "second": moment,
        "minute": moment.replace(second=0),
        "hour": moment.replace(minute=0, second=0),
        "day": day,
        "week": day - dt.timedelta(days=day.weekday()),
        "month": day.replace(day=1),
        "quarter": day.replace(month=(day.month - 1) // 3 * 3 + 1, day=1),
        "year": day.replace(month=1, day=1),
    }[unit]


def ms(moment):
    return (moment - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("unit", list(A.UNIT_MS))
def test_units(spark, zone, unit):
    df = spark.createDataFrame([(ms(m), m.isoformat(" ")) for m in MOMENTS], "ms bigint, s string").select(
        F.timestamp_millis("ms").alias("ltz"), F.col("s").cast("timestamp_ntz").alias("ntz"), F.substring("s", 1, 10).cast("date").alias("d")
    )
    for column in ("ltz", "ntz", "d"):
        if column == "d" and unit in ("second", "minute", "hour"):
            continue
        tree = A.date_histogram(column, unit, name="k", min_doc_count=1, format="yyyy-MM-dd HH:mm:ss")
        rows = A.aggregate(df, None, tree).buckets("k").collect()
        expected = sorted({start(m, unit) for m in MOMENTS})
        assert [r["k"] for r in rows] == [ms(e) for e in expected], column
        assert [r["doc_count"] for r in rows] == [sum(start(m, unit) == e for m in MOMENTS) for e in expected]
        if zone == "UTC":
            assert [r["k_text"] for r in rows] == [str(e) for e in expected]


@pytest.mark.parametrize("unit, buckets", [("hour", 24 * 60), ("day", 60), ("week", 9), ("month", 3), ("quarter", 2), ("year", 2)])
def test_gaps_are_filled_across_clock_changes(spark, zone, unit, buckets):
    first, last = dt.datetime(2023, 12, 25, 0), dt.datetime(2024, 2, 22, 23)
    df = spark.createDataFrame([(ms(first),), (ms(last),)], "ms bigint").select(F.timestamp_millis("ms").alias("t"))
    rows = A.aggregate(df, None, A.date_histogram("t", unit)).buckets("t").collect()
    assert len(rows) == buckets and sum(r["doc_count"] for r in rows) == 2
    assert rows[0]["t"] == ms(start(first, unit)) and rows[-1]["t"] == ms(start(last, unit))
    assert [r["t"] for r in rows] == sorted({r["t"] for r in rows})
