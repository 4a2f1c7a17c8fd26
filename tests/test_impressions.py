"""The impression query on hand-made logs, and against a plain Python count."""

import datetime as dt
import random
from collections import defaultdict
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from helpers import DAY, requests_of, signage_of, track
from hourboard.functions import times
from hourboard.operators import signage as signage_ops
from hourboard.plans.impressions import hourly_impressions, with_business_date

NOON = "2025-03-22 03:00:00"  # 12:00 in Tokyo


def run(spark, rows, *signage, **options):
    frame = hourly_impressions(
        requests_of(spark, rows), signage_of(spark, *signage), DAY, **options
    )
    return frame.collect()


def test_shape_of_a_group(spark):
    rows = run(spark, [("2025-03-22 10:05:00", track()), ("2025-03-22 10:59:59", track())])
    assert [row.asDict() for row in rows] == [
        {
            "timestamp_hourly": dt.datetime(2025, 3, 22, 10),
            "mediumId": 2,
            "storeId": 618,
            "device_id": "d1",
            "programId": 90,
            "sequence": 11,
            "creativeId": 245,
            "deliveryId": 1314,
            "imp": 2,
            "cnt": 2,
        }
    ]


def test_other_requests_are_left_out(spark):
    others = [
        track(path="/tracking/"),
        track(path="/x/tracking"),
        track(event="start"),
        track(event=None),
        track(send_ts=""),
        track(send_ts=None),
        track(networkId="2"),
        track(networkId="10"),
        track(networkId="01"),
        "not a url",
        None,
    ]
    rows = [(NOON, url) for url in others]
    assert run(spark, rows) == []
    assert [row["cnt"] for row in run(spark, rows + [(NOON, track())])] == [1]


def test_missing_and_unparsable_keys_are_groups(spark):
    urls = [track(device=None), track(device=""), track(mediumId="x"), track(mediumId=None)]
    rows = run(spark, [(NOON, url) for url in urls])
    found = sorted((str(row["device_id"]), str(row["mediumId"]), row["cnt"]) for row in rows)
    assert found == [("", "2", 1), ("None", "2", 1), ("d1", "None", 2)]


OPENING_CASES = [
    ("10:15", "20:45", "10:15", True),  # opening itself counts
    ("10:15", "20:45", "10:14", False),
    ("10:15", "20:45", "20:44", True),
    ("10:15", "20:45", "20:45", False),  # closing does not
    (None, None, "09:00", True),
    ("", "", "20:59", True),
    ("", "", "21:00", False),
    ("", "22:00", "21:30", True),
    ("9:00", "21:00", "10:00", False),  # unpadded text sorts after every minute
    ("18:00", "02:00", "19:00", False),  # past midnight never matches
    ("18:00", "02:00", "01:00", False),
    ("20:00", "24:00", "23:59", True),
]


@pytest.mark.parametrize("limit", [signage_ops.BROADCAST_LIMIT_BYTES, 0])
def test_opening_hours(spark, limit):
    rows, listings = [], []
    for number, (opening, closing, tokyo, _) in enumerate(OPENING_CASES):
        moment = dt.datetime.fromisoformat(f"2025-03-22 {tokyo}:30") - dt.timedelta(hours=9)
        rows.append((str(moment), track(device=f"d{number}")))
        listings.append((f"d{number}", opening, closing))
    counted = run(spark, rows, *listings, broadcast_limit_bytes=limit)
    assert {row["device_id"] for row in counted} == {
        f"d{number}" for number, case in enumerate(OPENING_CASES) if case[3]
    }


def test_default_hours_apply_to_unlisted_devices_too(spark):
    rows = [("2025-03-21 23:30:00", track()), ("2025-03-21 23:30:00", track(device=None))]  # 08:30
    assert run(spark, rows) == []
    assert len(run(spark, rows, default_opening="08:00")) == 2


def test_cnt_includes_plays_out_of_hours(spark):
    rows = run(
        spark,
        [("2025-03-22 03:10:00", track()), ("2025-03-22 03:40:00", track())],
        ("d1", "12:30", "13:00"),
    )
    assert [(row["imp"], row["cnt"]) for row in rows] == [(1, 2)]


def test_every_listing_counts(spark):
    listings = [("d1", "10:00", "11:00"), ("d1", "12:00", "13:00"), ("d1", "12:00", "13:00")]
    rows = run(spark, [(NOON, track()), (NOON, track(device="d2"))], *listings)
    assert {(r["device_id"], r["imp"], r["cnt"]) for r in rows} == {("d1", 2, 3), ("d2", 1, 1)}


def test_null_listing_matches_nothing(spark):
    rows = run(spark, [(NOON, track(device=None))], (None, "00:00", "00:01"))
    assert [(row["imp"], row["cnt"]) for row in rows] == [(1, 1)]


def test_window_of_hours(spark):
    rows = [(f"2025-03-22 {hour:02}:30:00", track()) for hour in range(0, 9)]  # 09:30..17:30
    hit = run(spark, rows, start_hour=11, end_hour=12)
    assert sorted(row["timestamp_hourly"].hour for row in hit) == [2, 3]


def test_business_date(spark):
    rows = [("2025-03-21 15:30:00", track()), ("2025-03-22 14:30:00", track())]
    frame = hourly_impressions(
        requests_of(spark, rows), signage_of(spark, ("d1", "00:00", "24:00")), DAY
    )
    assert {row["dt"] for row in with_business_date(frame).collect()} == {DAY}


def counted_in_python(rows, listings, first, last):
    """The query's definition, row by row."""
    groups = defaultdict(lambda: [0, 0])
    for moment, url in rows:
        wall = dt.datetime.fromisoformat(moment) + dt.timedelta(hours=9)
        query = parse_qs(urlsplit(url).query, keep_blank_values=True)
        if not (first <= wall.date() <= last) or query["event"] != ["complete"]:
            continue
        device = query.get("device_id", [None])[0]
        hm = wall.strftime("%H:%M")
        hits = [listing for listing in listings if listing[0] == device and device is not None]
        for _, opening, closing in hits or [(None, None, None)]:
            group = groups[moment[:13], device, query["creativeId"][0]]
            group[0] += (opening or "09:00") <= hm < (closing or "21:00")
            group[1] += 1
    return {key: tuple(value) for key, value in groups.items() if value[0]}


@pytest.fixture
def session_zone(spark, request):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", previous)


@pytest.mark.parametrize(
    "limit, ntz, session_zone",
    [
        (signage_ops.BROADCAST_LIMIT_BYTES, True, "America/New_York"),
        (signage_ops.BROADCAST_LIMIT_BYTES, False, "Asia/Tokyo"),
        (0, True, "UTC"),
        (0, False, "America/New_York"),
    ],
    indirect=["session_zone"],
)
def test_random_log_with_hot_device_and_listings(spark, limit, ntz, session_zone):
    """A third of requests and of listings on one device, another third without a device."""
    draw = random.Random(7)
    texts = [None, "", "9:00", "24:00", "00:00", "2"]
    texts += [f"{draw.randrange(24):02}:{draw.randrange(60):02}" for _ in range(20)]
    devices = ["hot", None] + [f"d{n}" for n in range(20)]
    weights = [10, 10] + [0.5] * 20
    listings = [
        (draw.choices(devices, weights)[0], draw.choice(texts), draw.choice(texts))
        for _ in range(120)
    ]
    rows = []
    for _ in range(3000):
        moment = dt.datetime(2025, 3, 21, 12) + dt.timedelta(seconds=draw.randrange(3 * 86400))
        url = track(
            device=draw.choices(devices, weights)[0],
            creativeId=str(draw.randrange(4)),
            event=draw.choice(["complete", "complete", "start"]),
        )
        rows.append((str(moment), url))
    last = DAY + dt.timedelta(days=1)
    frame = hourly_impressions(
        requests_of(spark, rows, ntz),
        signage_of(spark, *listings),
        DAY,
        last,
        broadcast_limit_bytes=limit,
    )
    hour = times.utc_wall(F.col("timestamp_hourly"), ntz).cast("string")
    frame = frame.withColumn("hour", F.substring(hour, 1, 13))
    actual = {
        (r["hour"], r["device_id"], str(r["creativeId"])): (r["imp"], r["cnt"])
        for r in frame.collect()
    }
    assert actual == counted_in_python(rows, listings, DAY, last)


def test_repeated_listings_do_not_multiply_rows(spark):
    """As many joined rows as plays, though one device is listed 30,000 times in 90 ways."""
    minute = F.concat(F.lit("1"), F.expr("id % 10"), F.lit(":0"), F.expr("id % 9"))
    listings = spark.range(30_000).select(
        F.lit("d1").alias("fully_device_id"),
        minute.alias("opening_time"),
        F.lit("20:00").alias("closing_time"),
    )
    devices = signage_ops.device_hours(listings)
    plays = spark.range(1000).select(F.lit("d1").alias("device_id"), F.lit(1080).alias("minute"))
    for broadcast in (True, False):
        joined = signage_ops.join_hours(plays, devices, broadcast)
        total = joined.select(
            signage_ops.listing_weight().alias("rows"),
            signage_ops.open_weight(devices).alias("open"),
        ).agg(F.count("*"), F.sum("rows"), F.sum("open"))
        open_listings = listings.where("opening_time <= '18:00'").count()
        assert tuple(total.first()) == (1000, 1000 * 30_000, 1000 * open_listings)


def test_only_busy_devices_are_dealt_over_several_salts(spark):
    """Half of the plays are of one device, an eighth of another; the table is repeated for these alone."""
    device = F.expr("CASE WHEN id % 2 = 0 THEN 'd1' WHEN id % 8 = 1 THEN 'd2' ELSE 'd' || (id % 1999) END")
    plays = spark.range(40_000).select(device.alias("device_id"), F.lit(600).alias("minute"), "id")
    stored, busy = signage_ops.find_busy(plays)
    assert stored.count() == 40_000
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [name for name, _ in busy][:1] == ["d1"] and {name for name, _ in busy} <= {"d1", "d2"}
    assert dict(busy)["d1"] in (tasks // 2, tasks // 2 + 1)
    frame = spark.range(2000).select(
        F.concat(F.lit("d"), "id").alias("device"),
        F.lit(1).cast("bigint").alias("listings"),
        F.lit(0).alias("opens"),
        F.lit(1440).alias("closes"),
        F.lit(None).cast("array<bigint>").alias("open_by_minute"),
    )
    joined = signage_ops.join_hours(plays, signage_ops.DeviceHours(frame, 1, 540, 1260), broadcast=False)
    assert joined.count() == joined.select("id").distinct().count() == 40_000
    assert joined.where("listings is null").count() == 0
    salts = {row["device_id"]: row["n"] for row in joined.groupBy("device_id").agg(F.count_distinct("salt").alias("n")).collect()}
    assert salts["d1"] == dict(busy)["d1"]
    assert all(n == 1 for name, n in salts.items() if name not in dict(busy))


@pytest.mark.parametrize("size", [2**20, 2**40])
def test_salted_join_keeps_every_row(spark, size):
    frame = spark.range(200).select(
        F.concat(F.lit("d"), "id").alias("device"),
        F.lit(1).cast("bigint").alias("listings"),
        F.lit(0).alias("opens"),
        F.lit(1440).alias("closes"),
        F.lit(None).cast("array<bigint>").alias("open_by_minute"),
    )
    devices = signage_ops.DeviceHours(frame, size, 540, 1260)
    device = F.expr("CASE id % 3 WHEN 0 THEN 'd7' WHEN 1 THEN 'd' || id % 400 END")
    plays = spark.range(6000).select(device.alias("device_id"), F.lit(600).alias("minute"), "id")
    joined = signage_ops.join_hours(plays, devices, broadcast=False)
    assert joined.count() == joined.select("id").distinct().count() == 6000
    expected = plays.join(frame, F.col("device_id") == F.col("device")).count()
    assert joined.where("listings = 1").count() == expected
    spread = joined.where("device_id IS NULL").select("salt").distinct().count()
    assert spread > 1000
    # The counting after the join must not lean on the shuffle by device.
    counted = joined.groupBy("device_id", "minute").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(device_id#" in plan.split("SortMergeJoin")[0]
