"""Column functions on edge values."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import evaluate, utc
from hourboard.functions import hours, times, urls

X = "x string"


def col():
    return F.col("x")


@pytest.mark.parametrize(
    "url, key, expected",
    [
        ("http://h/p?a=1|2&b=3", "b", "3"),  # character illegal in a URL
        ("http://h/p?a=1&a=2", "a", "1"),  # first one wins
        ("http://h/p?a=&b=3", "a", ""),
        ("http://h/p?b=3", "a", None),
        ("http://h/p", "a", None),
        ("http://h/p?mediumId=3&id=4", "id", "4"),  # suffix of another key
        ("http://h/p?mediumId=3", "id", None),
        ("http://h/p?b=1&a=2#top", "a", "2"),
        ("http://h/p?a=x%20y", "a", "x%20y"),
        ("http://h/p?a=b=c", "a", "b=c"),
        ("http://h/p?a.b=1&axb=2", "a.b", "1"),  # key taken literally
        ("", "a", None),
        (None, "a", None),
    ],
)
def test_query_param(spark, url, key, expected):
    assert evaluate(spark, [url], X, urls.query_param(col(), key)) == [expected]


def test_query_param_decoded(spark):
    made = ["h?a=x%20y", "h?a=a+b", "h?a=%zz", "h?b=1"]
    assert evaluate(spark, made, X, urls.query_param(col(), "a", decode=True)) == [
        "x y",
        "a b",
        None,
        None,
    ]


@pytest.mark.parametrize(
    "url, path",
    [
        ("https://h/tracking?a=1", "/tracking"),
        ("https://h/tracking/?a=1", "/tracking/"),
        ("https://h/tracking#x", "/tracking"),
        ("https://h/a/tracking", "/a/tracking"),
        ("https://h?x=/tracking", "/tracking"),  # the host runs up to the first slash
        ("/tracking?a=1", None),
        ("https://host", "t"),  # without a slash the pattern takes the host's last letter
        (None, None),
    ],
)
def test_url_path(spark, url, path):
    got = evaluate(spark, [url], X, urls.url_path(col()), urls.path_equals(col(), "/tracking"))
    assert got[0][0] == path
    assert bool(got[0][1]) == (path == "/tracking")


def test_param_equals(spark):
    made = ["h?networkId=1", "h?networkId=10", "h?a=1&networkId=1#x", "h?xnetworkId=1", "h?a=1"]
    assert evaluate(spark, made, X, urls.param_equals(col(), "networkId", "1")) == [
        True,
        False,
        True,
        False,
        False,
    ]


def test_safe_int(spark):
    expected = {
        "12": 12,
        "+5": 5,
        "-7": -7,
        "12.7": None,
        "": None,
        "abc": None,
        "0x1F": 31,
        "-0X00000000000000000001f": -31,
        "0x": None,
        "0xZZ": None,
        "0x1F\n": None,
        "0x7FFFFFFFFFFFFFFF": 2**63 - 1,
        "0xFFFFFFFFFFFFFFFF": None,
        "0x1FFFFFFFFFFFFFFFF": None,
        "9223372036854775807": 2**63 - 1,
        "9223372036854775808": None,
        "12345678901234567890": None,
        None: None,
    }
    assert evaluate(spark, list(expected), X, urls.safe_int(col())) == list(expected.values())


ZONES = ["UTC", "Asia/Tokyo", "America/New_York"]


@pytest.fixture(params=ZONES)
def zone(spark, request):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", previous)


# The last two lie in and after the spring gap of New York.
MOMENTS = ["2025-03-22 15:37:01", "2025-03-22 14:59:59.999999", "2025-03-09 02:30:00",
           "2025-03-09 07:05:00"]


@pytest.mark.parametrize("ntz", [True, False])
def test_local_time_in_any_session_zone(spark, zone, ntz):
    frame = spark.createDataFrame([(m,) for m in MOMENTS], "m string")
    ts = F.col("m").cast("timestamp_ntz") if ntz else F.to_timestamp(F.concat("m", F.lit("Z")))
    local = times.local_ts(F.col("ts"), ntz)
    bucket = times.hour_bucket(F.col("ts"), ntz)
    rows = frame.select("m", ts.alias("ts")).select(
        "m",
        times.business_date(local).alias("day"),
        times.hhmm(local).alias("hm"),
        times.minute_of_day(local).alias("minute"),
        times.yesterday(F.col("ts"), ntz).alias("yesterday"),
        times.utc_wall(bucket, ntz).cast("string").alias("bucket"),
    )
    for row in rows.collect():
        moment = dt.datetime.fromisoformat(row["m"])
        wall = moment + dt.timedelta(hours=9)
        assert row["day"] == wall.date()
        assert row["hm"] == wall.strftime("%H:%M")
        assert row["minute"] == wall.hour * 60 + wall.minute
        assert row["yesterday"] == wall.date() - dt.timedelta(days=1)
        assert row["bucket"] == moment.strftime("%Y-%m-%d %H:00:00")


@pytest.mark.parametrize("ntz", [True, False])
def test_day_window_ends(spark, zone, ntz):
    day = dt.date(2025, 3, 22)
    kept = {
        "2025-03-21 14:59:59.999999": False,
        "2025-03-21 15:00:00": True,
        "2025-03-22 14:59:59": True,
        "2025-03-22 14:59:59.5": False,
        "2025-03-22 15:00:00": False,
    }
    frame = spark.createDataFrame([(m,) for m in kept], "m string")
    ts = F.col("m").cast("timestamp_ntz") if ntz else F.to_timestamp(F.concat("m", F.lit("Z")))
    frame = frame.select("m", ts.alias("ts"))
    one = frame.select(times.day_window(F.col("ts"), ntz, day, day)).collect()
    assert [row[0] for row in one] == list(kept.values())
    # In a range every day loses the same last fraction of a second.
    three = times.day_window(
        F.col("ts"), ntz, day - dt.timedelta(days=1), day + dt.timedelta(days=1)
    )
    assert [row[0] for row in frame.select(three).collect()] == [False, True, True, False, True]
    late = times.day_window(F.col("ts"), ntz, day, day, start_hour=22, end_hour=23)
    assert [row[0] for row in frame.select(late).collect()] == [False, False, True, False, False]


def test_utc_dates():
    day = dt.date(2025, 3, 22)
    assert times.utc_dates(day, day) == (dt.date(2025, 3, 21), day)


def test_yesterday_jst():
    assert times.yesterday_jst(utc("2025-03-23 12:00:00")) == dt.date(2025, 3, 22)
    assert times.yesterday_jst(utc("2025-03-22 15:15:00")) == dt.date(2025, 3, 22)
    assert times.yesterday_jst(utc("2025-03-22 14:59:59")) == dt.date(2025, 3, 21)


def test_date_range(spark):
    frame = spark.createDataFrame(
        [
            (dt.date(2024, 2, 28), dt.date(2024, 3, 1)),
            (dt.date(2024, 2, 28), dt.date(2024, 2, 28)),
            (dt.date(2024, 3, 1), dt.date(2024, 2, 28)),
            (None, dt.date(2024, 2, 28)),
        ],
        "first date, last date",
    )
    rows = frame.select(times.date_range(F.col("first"), F.col("last"))).collect()
    assert [len(row[0]) for row in rows] == [3, 1, 0, 0]
    assert rows[0][0][1] == dt.date(2024, 2, 29)


def test_is_valid_date(spark):
    good = ["2025-03-22", "2025-01-01", "2025-12-31", "2024-02-29"]
    bad = ["", "invalid", "2025/03/22", "2025-3-22", "2025-03-32", "2025-13-01", "2025-02-30"]
    bad += ["2025-03-22\n", " 2025-03-22", "0999-01-01", None]
    got = evaluate(spark, good + bad, X, times.is_valid_date(col()))
    assert got == [True] * len(good) + [False] * len(bad)


@pytest.mark.parametrize(
    "fmt, expected",
    [
        ("YYYY-MM-DD", "2025-03-22"),
        ("YYYY/MM/DD", "2025/03/22"),
        ("YYYY-MM-DD HH:mm:ss", "2025-03-22 15:30:45"),
        ("MM/DD/YYYY", "03/22/2025"),
        ("DD.MM.YYYY", "22.03.2025"),
        ("DD of MM, it's HH o'clock", "22 of 03, it's 15 o'clock"),
        ("DD DD", "22 DD"),  # only the first use of a token counts
        ("", ""),
    ],
)
def test_format_date(spark, fmt, expected):
    moment = F.lit("2025-03-22 15:30:45").cast("timestamp")
    assert spark.range(1).select(times.format_date(moment, fmt)).first()[0] == expected


def test_pad_hour(spark):
    padded = evaluate(spark, [0, 9, 23, 123], "x int", times.pad_hour(col()))
    assert padded == ["00", "09", "23", "123"]


ODD_HOURS = ["", "9:00", "09:00", "09:0", "09:00 ", "09:000", "23:59", "24:00", "00:00", "00:0",
             "2", "23:", "23:60", "09:5x", "abc", "１０:００", "\n", "09:00\n", "1", "10", "99:99"]


def test_minute_rank_of_odd_texts(spark):
    ranks = evaluate(spark, ODD_HOURS, X, hours.minute_rank(col()))
    assert ranks == [hours.text_rank(text) for text in ODD_HOURS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789:; ~x", max_size=7), min_size=150, max_size=200))
def test_minute_rank_of_any_text(spark, texts):
    ranks = evaluate(spark, texts, X, hours.minute_rank(col()))
    assert ranks == [hours.text_rank(text) for text in texts]


def test_rank_order_is_text_order(spark):
    frame = spark.createDataFrame([(text,) for text in ODD_HOURS], "opening string").crossJoin(
        spark.createDataFrame([(text,) for text in ODD_HOURS], "closing string")
    )
    minutes = spark.createDataFrame(
        [(m, hours.minute_text(m)) for m in (0, 1, 59, 60, 539, 540, 599, 600, 1380, 1439)],
        "minute int, hm string",
    )
    opening = hours.hour_text(F.col("opening"), "08:00")
    closing = hours.hour_text(F.col("closing"), "19:30")
    by_text = hours.in_business_hours(
        F.col("hm"), F.col("opening"), F.col("closing"), "08:00", "19:30"
    )
    by_rank = (F.col("minute") >= hours.minute_rank(opening)) & (
        F.col("minute") < hours.minute_rank(closing)
    )
    assert frame.crossJoin(minutes).where(by_text != by_rank).count() == 0


#: By zone: a day, its first and last moment in UTC, and how many hours it has.
ODD_DAYS = [
    ("America/New_York", dt.date(2024, 3, 10), "2024-03-10 05:00:00", "2024-03-11 03:59:59", 23),
    ("America/New_York", dt.date(2024, 11, 3), "2024-11-03 04:00:00", "2024-11-04 04:59:59", 25),
    ("Australia/Adelaide", dt.date(2024, 4, 7), "2024-04-06 13:30:00", "2024-04-07 14:29:59", 25),
    ("Asia/Kathmandu", dt.date(2024, 1, 5), "2024-01-04 18:15:00", "2024-01-05 18:14:59", 24),
    ("America/Santiago", dt.date(2024, 9, 8), "2024-09-08 04:00:00", "2024-09-09 02:59:59", 23),  # has no midnight
]


@pytest.mark.parametrize("ntz", [True, False])
@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
@pytest.mark.parametrize("zone, day, first, last, hours", ODD_DAYS)
def test_days_of_other_zones(spark, zone, day, first, last, hours, session, ntz):
    """Every minute and the seconds around the ends of a day, against the zone's rules in Python."""
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        opens, closes = utc(first), utc(last)
        moments = [opens + dt.timedelta(minutes=n) for n in range(-90, 27 * 60)]
        moments += [opens - dt.timedelta(seconds=1), closes, closes + dt.timedelta(seconds=1)]
        if ntz:
            frame = spark.createDataFrame([(m.replace(tzinfo=None),) for m in moments], "ts timestamp_ntz")
        else:
            frame = spark.createDataFrame([(m,) for m in moments], "ts timestamp")
        ts = F.col("ts")
        local = times.local_ts(ts, ntz, zone)
        rows = frame.select(
            times.utc_wall(ts, ntz).cast("string").alias("utc"),
            times.day_window(ts, ntz, day, day, zone=zone).alias("inside"),
            times.day_window(ts, ntz, day, day + dt.timedelta(days=1), zone=zone).alias("two"),
            local.cast("string").alias("local"),
            times.utc_wall(times.hour_bucket(ts, ntz, zone), ntz).cast("string").alias("hour"),
            times.yesterday(ts, ntz, zone).alias("yesterday"),
        ).collect()
        buckets = set()
        for row in rows:
            moment = utc(row.utc)
            there = moment.astimezone(ZoneInfo(zone))
            assert row.local == there.strftime("%Y-%m-%d %H:%M:%S")
            assert row.inside == (opens <= moment <= closes) == (there.date() == day)
            assert row.two == (day <= there.date() <= day + dt.timedelta(days=1))
            assert utc(row.hour) == moment - dt.timedelta(minutes=there.minute, seconds=there.second)
            assert row.yesterday == there.date() - dt.timedelta(days=1) == times.yesterday_in(zone, moment)
            if row.inside:
                buckets.add(row.hour)
        assert len(buckets) == hours
        assert times.utc_dates(day, day, zone) == (opens.date(), closes.date())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
