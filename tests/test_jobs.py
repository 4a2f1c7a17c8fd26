"""Daily run, range, reprocessing, their arguments, run log and summary."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import requests_of, signage_of, track, utc
from hourboard import jobs
from hourboard.__main__ import main
from hourboard.functions import times
from hourboard.jobs import ArgumentError, ImpressionJob, run_summary
from hourboard.schemas import RUN_LOG_SCHEMA
from hourboard.sources import readers

D20, D21, D22 = (dt.date(2025, 3, day) for day in (20, 21, 22))


def log_of(spark, *days):
    """A play at noon of each Tokyo day, and one late in its evening."""
    rows = []
    for day in days:
        rows += [(f"{day} 03:10:00", track()), (f"{day} 11:10:00", track(creativeId="7"))]
    return requests_of(spark, rows)


@pytest.fixture
def job(spark):
    table = f"j_{uuid.uuid4().hex[:8]}"
    yield ImpressionJob(
        spark, log_of(spark, D20, D21, D22), signage_of(spark, ("d1", "10:00", "22:00")), table
    )
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def entries(log):
    return [tuple(row) for row in log.orderBy("process_date").collect()]


def stored(job):
    return dict(job.spark.table(job.table).groupBy("dt").count().collect())


def failing_on(job, day):
    """The job's log, broken on one day."""
    local = times.business_date(times.local_ts(F.col("timestamp"), ntz=False))
    bad = F.raise_error(F.lit("bad log")).cast("string")
    url = F.when(local == F.lit(day), bad).otherwise(F.col("httpRequest.requestUrl"))
    return job.requests.select("timestamp", F.struct(url.alias("requestUrl")).alias("httpRequest"))


def test_run_and_reprocess(job):
    log = job.run("2025-03-21")
    assert log.schema == RUN_LOG_SCHEMA
    assert entries(log) == [(D21, True, 2, None)]
    assert entries(job.reprocess("2025-03-21")) == [(D21, True, 2, None)]
    assert stored(job) == {D21: 2}


def test_run_without_date_loads_yesterday(job, monkeypatch):
    monkeypatch.setattr(times, "yesterday_jst", lambda: D22)
    assert entries(job.run()) == [(D22, True, 2, None)]


def test_empty_day_succeeds(job):
    assert entries(job.run("2025-03-25")) == [(dt.date(2025, 3, 25), True, 0, None)]
    assert stored(job) == {}


def test_failure_is_logged(job):
    job.run("2025-03-21")
    job.requests = failing_on(job, D21)
    ((day, success, rows, error),) = entries(job.run("2025-03-21"))
    assert (day, success, rows) == (D21, False, None)
    assert "bad log" in error
    assert stored(job) == {D21: 2}


def test_range(job):
    assert entries(job.run_range("2025-03-20", "2025-03-22")) == [
        (D20, True, 2, None),
        (D21, True, 2, None),
        (D22, True, 2, None),
    ]
    assert stored(job) == {D20: 2, D21: 2, D22: 2}
    assert entries(job.run_range("2025-03-21")) == [(D21, True, 2, None)]


def test_range_is_one_pass(job, monkeypatch):
    loads = []
    load = ImpressionJob._load
    monkeypatch.setattr(
        ImpressionJob, "_load", lambda self, *span: loads.append(span) or load(self, *span)
    )
    job.run_range("2025-03-20", "2025-03-22")
    assert loads == [(D20, D22)]


def test_one_bad_day_does_not_stop_the_range(job):
    job.requests = failing_on(job, D21)
    log = job.run_range("2025-03-20", "2025-03-22")
    assert [entry[:3] for entry in entries(log)] == [
        (D20, True, 2),
        (D21, False, None),
        (D22, True, 2),
    ]
    assert stored(job) == {D20: 2, D22: 2}
    assert tuple(run_summary(log).first()) == (False, D20, D22, 4, [D21])


def test_a_failed_range_is_halved_and_keeps_its_error(job, monkeypatch):
    job.requests = failing_on(job, D21)
    loads = []
    load = ImpressionJob._load
    monkeypatch.setattr(
        ImpressionJob, "_load", lambda self, *span: loads.append(span) or load(self, *span)
    )
    job.run_range("2025-03-20", "2025-03-22")
    assert loads == [(D20, D22), (D20, D21), (D20, D20), (D21, D21), (D22, D22)]
    assert [(first, last) for first, last, _ in job.range_errors] == [(D20, D22), (D20, D21)]
    assert all("bad log" in message for *_, message in job.range_errors)


def test_a_broken_record_of_a_text_log_fails_all_days_at_once(job, monkeypatch, tmp_path):
    job.requests.write.json(str(tmp_path / "log"))
    (tmp_path / "log" / "more.json").write_text('{"timestamp": "2025-03-\n')
    loads = []
    load = ImpressionJob._load
    monkeypatch.setattr(
        ImpressionJob, "_load", lambda self, *span: loads.append(span) or load(self, *span)
    )
    job.requests = readers.read_requests(job.spark, str(tmp_path / "log"), "json")
    log = entries(job.run_range("2025-03-20", "2025-03-22"))
    assert [entry[:3] for entry in log] == [(day, False, None) for day in (D20, D21, D22)]
    assert all("Malformed record" in entry[3] for entry in log) and len(loads) == 1
    landed = readers.land_requests(job.spark, str(tmp_path / "log"), "json", str(tmp_path / "landed"), max_rejects=1)
    job.requests = landed.requests
    assert [entry[:3] for entry in entries(job.run_range("2025-03-20", "2025-03-22"))] == [
        (day, True, 2) for day in (D20, D21, D22)
    ]


def test_what_cannot_be_analysed_is_tried_once(job, monkeypatch):
    loads = []
    load = ImpressionJob._load
    monkeypatch.setattr(
        ImpressionJob, "_load", lambda self, *span: loads.append(span) or load(self, *span)
    )
    job.signage = job.signage.drop("opening_time")
    log = job.run_range("2025-03-20", "2025-03-22")
    assert [entry[:3] for entry in entries(log)] == [(day, False, None) for day in (D20, D21, D22)]
    assert len(loads) == 1


def test_summary(spark):
    def summary(*rows):
        return tuple(run_summary(spark.createDataFrame(list(rows), RUN_LOG_SCHEMA)).first())

    assert summary((D22, True, 3, None)) == (True, D22, D22, 3, None)
    assert summary((D22, True, 0, None)) == (True, D22, D22, 0, None)
    assert summary((D22, False, None, "Test error")) == (False, D22, D22, 0, [D22])
    assert summary((D22, False, None, "e"), (D20, False, None, "e"), (D21, True, 5, None)) == (
        False,
        D20,
        D22,
        5,
        [D20, D22],
    )


@pytest.mark.parametrize(
    "value, day",
    [
        ("2025-03-20", D20),
        ("2025-03-20T23:30:00Z", D20),
        ("2025-03-21T08:30:00+09:00", D20),
        ("2025/03/20", D20),
        ("03/20/2025", D20),
        ("2025-03", dt.date(2025, 3, 1)),
        ("2025", dt.date(2025, 1, 1)),
        (D20, D20),
        (utc("2025-03-20 23:30:00"), D20),
    ],
)
def test_lenient_dates(value, day):
    assert jobs.run_date(value) == day


def test_run_date_arguments(monkeypatch):
    monkeypatch.setattr(times, "yesterday_jst", lambda: D20)
    assert jobs.run_date() == D20
    assert jobs.run_date("") == D20
    for bad in ("invalid-date", "2025-02-30", "2025-13-01"):
        with pytest.raises(ArgumentError, match=f"Invalid date parameter: {bad}"):
            jobs.run_date(bad)


def test_run_dates_arguments():
    assert jobs.run_dates("2025-03-20") == (D20, D20)
    assert jobs.run_dates("2025-03-20", "2025-03-22") == (D20, D22)
    with pytest.raises(ArgumentError, match="Missing startDate parameter"):
        jobs.run_dates(None, "2025-03-22")
    with pytest.raises(ArgumentError, match="startDate=2025-03-20, endDate=x"):
        jobs.run_dates("2025-03-20", "x")
    with pytest.raises(ArgumentError, match="is after end date"):
        jobs.run_dates("2025-03-22", "2025-03-20")


def test_reprocess_arguments():
    assert jobs.reprocess_date("2025-03-20") == D20
    for missing in (None, ""):
        with pytest.raises(ArgumentError, match="Missing date parameter"):
            jobs.reprocess_date(missing)
    for bad in ("2025/03/20", "2025-3-20", "2025-02-30", "2025-03-20\n", "20250320"):
        with pytest.raises(ArgumentError, match="Expected format: YYYY-MM-DD"):
            jobs.reprocess_date(bad)


def test_command_line(spark, tmp_path, capsys):
    log = log_of(spark, D20, D21).withColumn("log_dt", F.to_date("timestamp"))
    log.write.partitionBy("log_dt").parquet(str(tmp_path / "log"))
    sheet = tmp_path / "signage.csv"
    sheet.write_text("fully_device_id,opening_time,closing_time\nd1,10:00,22:00\n")
    table = f"cli_{uuid.uuid4().hex[:8]}"
    source = f"--requests {tmp_path / 'log'} --requests-format parquet --log-date log_dt"
    where = f"{source} --signage {sheet} --signage-format csv --table default.{table}".split()

    assert main(["run", *where, "--date", "2025-03-20"], spark) == 0
    assert main(["run-range", *where, "--start-date", "2025-03-20", "--end-date", "2025-03-22"],
                spark) == 0
    lines = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert [line.get("row_count") for line in lines] == [2, None, 2, 2, 0, None]
    assert lines[-1]["total_row_count"] == 4
    assert main(["reprocess", *where, "--date", "2025/03/20"], spark) == 1
    log.select("timestamp", "httpRequest").write.json(str(tmp_path / "text"))
    (tmp_path / "text" / "part-x.json").write_text("broken\n")
    text = f"--requests {tmp_path / 'text'} --requests-format json --signage {sheet} --signage-format csv --table default.{table}".split()
    capsys.readouterr()
    assert main(["run", *text, "--date", "2025-03-20"], spark) == 1
    assert main(["run", *text, "--date", "2025-03-20", "--max-rejects", "0"], spark) == 1
    assert "1 of 5 records are broken" in capsys.readouterr().err
    assert main(["run", *text, "--date", "2025-03-20", "--max-rejects", "1"], spark) == 0
    assert '"rejected":1,"example":"broken"' in capsys.readouterr().err
    assert main(["run", *where, "--environment", "test"], spark) == 1
    assert "Unknown environment: test" in capsys.readouterr().err
    spark.sql(f"DROP TABLE {table}")
