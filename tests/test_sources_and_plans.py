"""Sources, and what the physical plans must look like."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from helpers import requests_of, signage_of, track
from hourboard.checks.queries import REGISTRY
from hourboard.plans.impressions import hourly_impressions
from hourboard.scratch import scratch_path
from hourboard.sources import readers

DATA = "/root/testdata/sf0.001"
D21, D22 = dt.date(2025, 3, 21), dt.date(2025, 3, 22)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_log(spark, tmp_path):
    """A log as it may be stored: more fields than needed, partitioned by UTC date."""
    rows = [(f"2025-03-{day} 03:10:00", track()) for day in range(18, 26)]
    log = requests_of(spark, rows).select(
        "timestamp",
        F.struct(
            F.lit("GET").alias("requestMethod"),
            F.col("httpRequest.requestUrl").alias("requestUrl"),
            F.lit(200).alias("status"),
        ).alias("httpRequest"),
        F.lit("x").alias("insertId"),
        F.to_date("timestamp").alias("log_dt"),
    )
    path = str(tmp_path / "log")
    log.write.partitionBy("log_dt").parquet(path)
    return path


def test_scan_reads_only_what_it_needs(spark, stored_log, capsys):
    log = readers.read_requests(spark, stored_log, "parquet", "log_dt")
    frame = hourly_impressions(log, signage_of(spark, ("d1", "", "")), D21, D22, log_date="log_dt")
    frame.explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(
        r"ReadSchema: struct<timestamp:timestamp,httpRequest:struct<requestUrl:string>>", plan
    )
    assert "GreaterThanOrEqual(timestamp,2025-03-20 15:00:00.0)" in plan
    assert "LessThanOrEqual(timestamp,2025-03-22 14:59:59.0)" in plan
    assert "StringContains(httpRequest.requestUrl,/tracking)" in plan
    assert re.search(r"PartitionFilters: \[.*log_dt#\d+ >= 2025-03-20", plan)
    assert frame.count() == 2


def test_broadcast_plan_shuffles_plays_once(spark):
    plan = plan_of(queries()["hourly_impressions"](spark, DATA))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    plays, _, signage = plan.partition("BroadcastExchange")
    assert plays.count("Exchange hashpartitioning(timestamp_hourly") == 1
    assert plays.count("Exchange") == 1
    assert "partial_sum" in plays
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_shuffled_plan_counts_first_and_salts(spark):
    plan = plan_of(queries()["hourly_impressions_shuffled"](spark, DATA))
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
    assert re.search(r"Exchange hashpartitioning\(device_id#\d+, salt#\d+", plan)
    # Counts per minute are stored; after that the plays are shuffled once, for the join and the counting.
    counting, _, joining = plan.partition("SortMergeJoin")
    assert "partial_sum" in counting and "Exchange" not in counting
    assert joining.count("hashpartitioning(device_id#") == 1 and "hashpartitioning(timestamp_hourly" not in joining
    assert "plays#" in joining


def test_no_query_runs_python(spark):
    slow = ("Python", "MapInPandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin")
    loads = ("replace", "append", "empty", "day_counts", "run_log", "run_summary", "versioned")
    for name, query in REGISTRY.items():
        if name.startswith(loads):
            continue
        plan = plan_of(query(spark, DATA))
        assert not [word for word in slow if word in plan], name


def test_read_requests_formats(spark, stored_log, tmp_path):
    log = readers.read_requests(spark, stored_log, "parquet")
    assert log.columns == ["timestamp", "httpRequest"]
    log.write.json(str(tmp_path / "json"))
    assert readers.read_requests(spark, str(tmp_path / "json"), "json").count() == 8
    table = f"r_{uuid.uuid4().hex[:8]}"
    log.write.saveAsTable(table)
    assert readers.read_requests(spark, table).schema["httpRequest"].dataType.simpleString() == (
        "struct<requestUrl:string>"
    )
    spark.sql(f"DROP TABLE {table}")


def test_broken_json_is_an_error(spark, tmp_path):
    good = '{"timestamp": "2025-03-22T00:00:00Z", "httpRequest": {"requestUrl": "u"}, "day": "2025-03-22"}'
    (tmp_path / "log.json").write_text(good + "\n")
    log = readers.read_requests(spark, str(tmp_path), "json", log_date="day")
    assert [(r.httpRequest.requestUrl, r.day) for r in log.collect()] == [("u", dt.date(2025, 3, 22))]
    (tmp_path / "log.json").write_text(good + '\n{"timestamp": "2025\n')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        readers.read_requests(spark, str(tmp_path), "json").collect()


def test_csv_log(spark, tmp_path):
    (tmp_path / "log.csv").write_text("status,requestUrl,timestamp\n200,http://x/t?a=1,2025-03-22T01:00:00Z\n")
    log = readers.read_requests(spark, str(tmp_path), "csv")
    assert log.schema["httpRequest"].dataType.simpleString() == "struct<requestUrl:string>"
    assert log.selectExpr("unix_seconds(timestamp)", "httpRequest.requestUrl").collect() == [(1742605200, "http://x/t?a=1")]


JSON_LOG = """\
{"timestamp": "2025-03-22 03:00:00", "httpRequest": {"requestUrl": "u1", "status": 200}, "day": "2025-03-22"}
{"timestamp": "2025-03-22T12:00:00.5+09:00", "httpRequest": {"requestUrl": "u2"}}

{"timestamp": "2025-03-22 12:00:00 Asia/Tokyo", "httpRequest": {"requestUrl": "u3"}, "day": null}
{"timestamp": "2025-03-22", "httpRequest": {"requestUrl": "u4"}}
{"httpRequest": {"requestUrl": "u5"}}
{"timestamp": "2025-03-2
GET /tracking
{"timestamp": "12:00:00", "httpRequest": {"requestUrl": "v1"}}
{"timestamp": 1742612400, "httpRequest": {"requestUrl": "v2"}}
{"timestamp": "2025-03-22T03:00:00Z", "httpRequest": "v3"}
{"timestamp": "2025-03-22T03:00:00Z", "httpRequest": {"requestUrl": "v4"}, "day": "today"}
[]
"""
SECONDS = {"u1": 1742612400, "u2": 1742612400, "u3": 1742612400, "u4": 1742601600, "u5": None}


@pytest.fixture(params=["UTC", "Asia/Tokyo", "America/St_Johns"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def seconds_of(requests):
    return {row[0]: row[1] for row in requests.selectExpr("httpRequest.requestUrl", "unix_seconds(timestamp)").collect()}


def test_broken_json_records_are_put_aside(spark, tmp_path, zone):
    (tmp_path / "log.json").write_text(JSON_LOG)
    source = str(tmp_path / "log.json")
    landed = readers.land_requests(spark, source, "json", str(tmp_path / "landed"), "day", max_rejects=7)
    assert (landed.accepted, landed.rejected) == (5, 7)
    assert seconds_of(landed.requests) == SECONDS
    assert {r.httpRequest.requestUrl: r.day for r in landed.requests.collect()}["u1"] == dt.date(2025, 3, 22)
    found = {row.record: row.reason for row in landed.rejects.collect()}
    lines = JSON_LOG.splitlines()
    reasons = [readers.NO_RECORD] * 2 + [readers.NO_TIME] * 2 + [readers.NO_RECORD, readers.NO_DAY, readers.NO_RECORD]
    assert found == dict(zip(lines[6:], reasons))
    assert all(row.file.endswith("log.json") for row in landed.rejects.collect())
    counts = {row.reason: row.rejected for row in readers.reject_counts(landed.rejects).collect()}
    assert counts == {readers.NO_RECORD: 4, readers.NO_TIME: 2, readers.NO_DAY: 1}
    with pytest.raises(readers.RejectedRecords, match="7 of 12 records"):
        readers.land_requests(spark, source, "json", str(tmp_path / "again"), "day", max_rejects=6)
    with pytest.raises(Exception, match="Malformed record"):
        readers.read_requests(spark, source, "json").collect()


def test_landed_logs_without_broken_records_or_any(spark, tmp_path):
    (tmp_path / "good.json").write_text(JSON_LOG.splitlines()[0])
    (tmp_path / "none.json").write_text("\n\n")
    good = readers.land_requests(spark, str(tmp_path / "good.json"), "json", str(tmp_path / "a"))
    assert (good.accepted, good.rejected, good.rejects.count()) == (1, 0, 0)
    none = readers.land_requests(spark, str(tmp_path / "none.json"), "json", str(tmp_path / "b"))
    assert (none.accepted, none.rejected, none.requests.count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="text format"):
        readers.land_requests(spark, "x", "parquet", str(tmp_path / "c"))


def test_broken_csv_records_are_put_aside(spark, tmp_path, zone):
    lines = ["200,http://x,2025-03-22 03:00:00", "200,http://x", "1,2,3,4", "200,http://y,noon", '200,"a,b",2025-03-22T12:00:00+09:00']
    (tmp_path / "log.csv").write_text("\n".join(["status,requestUrl,timestamp", *lines]))
    landed = readers.land_requests(spark, str(tmp_path / "log.csv"), "csv", str(tmp_path / "landed"), max_rejects=3)
    assert seconds_of(landed.requests) == {"http://x": 1742612400, "a,b": 1742612400}
    assert {row.record: row.reason for row in landed.rejects.collect()} == dict(
        zip(lines[1:4], [readers.NO_RECORD, readers.NO_RECORD, readers.NO_TIME])
    )
    with pytest.raises(Exception, match="Malformed record"):
        readers.read_requests(spark, str(tmp_path / "log.csv"), "csv").select("timestamp").collect()


def test_text_logs_do_not_depend_on_the_session_zone(spark, zone):
    """Registered queries over text logs give in every zone what they give in UTC."""
    for name in ("text_log_times", "stored_log_accepted"):
        found = sorted(map(str, queries()[name](spark, DATA).collect()))
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert found == sorted(map(str, queries()[name](spark, DATA).collect()))
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sheet_with_further_columns_in_another_order(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text("memo,closing_time,fully_device_id,opening_time\nm,20:00,d1,09:30\n,,d2,\n")
    rows = [tuple(row) for row in readers.read_signage_csv(spark, str(sheet)).collect()]
    assert rows == [("d1", "09:30", "20:00"), ("d2", None, None)]
    sheet.write_text("fully_device_id,opening_time\nd1,09:30\n")
    with pytest.raises(Exception, match="closing_time"):
        readers.read_signage_csv(spark, str(sheet)).collect()


def test_signage_sheet(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text(
        "fully_device_id,opening_time,closing_time\nd1,09:30,20:00\nd2,,\n\"d,3\",9:00,24:00\n"
    )
    rows = [tuple(row) for row in readers.read_signage_csv(spark, str(sheet)).collect()]
    assert rows == [("d1", "09:30", "20:00"), ("d2", None, None), ("d,3", "9:00", "24:00")]
    table = f"s_{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # importing again replaces the copy
        assert readers.import_signage(spark, str(sheet), table).count() == 3
    assert readers.read_signage(spark, table).columns == [
        "fully_device_id",
        "opening_time",
        "closing_time",
    ]
    spark.sql(f"DROP TABLE {table}")


def test_sql(spark):
    assert readers.run_sql(spark, "SELECT 1 AS one").collect() == [(1,)]
    assert readers.run_sql(spark, "SELECT 1 AS one WHERE false").collect() == []
    row = readers.run_sql(
        spark,
        "SELECT :value AS test_value, :text AS test_text",
        {"value": 42, "text": "it's; -- test"},
    ).first()
    assert (row["test_value"], row["test_text"]) == (42, "it's; -- test")


def test_scratch_is_where_the_session_says(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(base) and one != two
