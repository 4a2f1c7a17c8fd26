"""Late requests: new files of a log, the days they touch, and loading these days again."""

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from hourboard.__main__ import main
from hourboard.jobs import ImpressionJob
from hourboard.sinks.versions import VersionedStore
from hourboard.sources import arrivals, readers
from hourboard.sources.arrivals import ArrivalIndex
from helpers import requests_of, signage_of, track
from test_jobs import entries, log_of
from test_target import D20, D21, D22, D23


@pytest.fixture
def index(spark, tmp_path):
    return ArrivalIndex(spark, str(tmp_path / "index"))


def write(spark, place, *rows):
    requests_of(spark, list(rows)).coalesce(1).write.mode("append").parquet(place)


def test_only_days_of_new_files_are_found(spark, index, tmp_path):
    place = str(tmp_path / "log")
    write(spark, place, ("2025-03-19 15:00:00", track()), ("2025-03-20 15:00:00", track()))
    (first,) = index.update(place, "parquet")
    assert (first.files, first.plays) == (1, {D20: 1, D21: 1})
    assert index.update(place, "parquet") == []
    # Plays only, and none in the last fraction of a second of a day, which is of no day.
    write(
        spark, place, ("2025-03-21 15:00:00", track()), ("2025-03-21 16:00:00", track()),
        ("2025-03-22 15:00:00", track(event="start")), ("2025-03-23 14:59:59.5", track()),
    )
    write(spark, place, ("2025-03-20 14:59:59", track()))
    (second,) = index.update(place, "parquet")
    assert (second.files, second.plays) == (2, {D20: 1, D22: 2})
    assert index.pending() == {first.name, second.name}
    assert dict(index.days({first.name, second.name}).collect()) == {D20: 2, D21: 1, D22: 2}
    index.settle({first.name})
    assert index.pending() == {second.name} and index.files().count() == 3


def test_many_files_are_read_in_batches(spark, index, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "FILES_AT_ONCE", 2)
    place = str(tmp_path / "log")
    for day in range(18, 23):
        write(spark, place, (f"2025-03-{day} 03:00:00", track()))
    found = index.update(place, "parquet")
    assert [arrival.files for arrival in found] == [2, 2, 1]
    assert sum(len(arrival.plays) for arrival in found) == 5 and index.update(place, "parquet") == []


def test_an_update_that_dies_finds_the_files_again(spark, index, tmp_path, monkeypatch):
    place = str(tmp_path / "log")
    write(spark, place, ("2025-03-20 03:00:00", track()))
    with monkeypatch.context() as patched:
        patched.setattr(arrivals, "plays_per_day", lambda requests, zone: requests.select(F.raise_error(F.lit("no"))))
        with pytest.raises(Exception, match="no"):
            index.update(place, "parquet")
    assert index.pending() == set() and index.files().count() == 0
    assert [arrival.plays for arrival in index.update(place, "parquet")] == [{D20: 1}]


def test_a_changed_file_counts_as_new(spark, index, tmp_path):
    place = str(tmp_path / "log")
    write(spark, place, ("2025-03-20 03:00:00", track()))
    index.update(place, "parquet")
    (file,) = (tmp_path / "log").glob("*.parquet")
    other = str(tmp_path / "other")
    write(spark, other, ("2025-03-21 03:00:00", track()), ("2025-03-21 04:00:00", track()))
    (new,) = (tmp_path / "other").glob("*.parquet")
    shutil.copy(new, file)
    os.utime(file, (2_000_000_000, 2_000_000_000))
    for crc in (tmp_path / "log").glob(".*.crc"):
        crc.write_bytes((tmp_path / "other" / f".{new.name}.crc").read_bytes())
    assert [arrival.plays for arrival in index.update(place, "parquet")] == [{D21: 2}]


def test_days_are_loaded_in_runs(spark, monkeypatch):
    loads = []
    monkeypatch.setattr(ImpressionJob, "_load_span", lambda self, *span: loads.append(span) or [])
    job = ImpressionJob(spark, None, None, "t")
    job.run_days([D22, D20, D23, D20, dt.date(2025, 2, 28), dt.date(2025, 3, 1)])
    assert loads == [(dt.date(2025, 2, 28), dt.date(2025, 3, 1)), (D20, D20), (D22, D23)]
    assert job.run_days([]).collect() == []


def test_late_days_are_loaded_and_settled(spark, index, tmp_path, monkeypatch):
    place, store = str(tmp_path / "log"), VersionedStore(spark, str(tmp_path / "store"))
    log_of(spark, D20, D21, D22).write.parquet(place)
    job = ImpressionJob(spark, readers.read_requests(spark, place, "parquet"), signage_of(spark, ("d1", "", "")), "", store=store)
    index.update(place, "parquet")
    assert [entry[:3] for entry in entries(job.run_late(index))] == [(D20, True, 2), (D21, True, 2), (D22, True, 2)]
    assert index.pending() == set() and entries(job.run_late(index)) == []
    write(spark, place, ("2025-03-21 05:00:00", track(mediumId="77")))
    index.update(place, "parquet")
    job.requests = readers.read_requests(spark, place, "parquet")
    signage, job.signage = job.signage, job.signage.drop("opening_time")
    assert [entry[:2] for entry in entries(job.run_late(index))] == [(D21, False)]
    assert len(index.pending()) == 1  # a failed day stays pending
    job.signage = signage
    assert [entry[:3] for entry in entries(job.run_late(index))] == [(D21, True, 3)]
    assert store.count_days(D20, D22) == {D20: 2, D21: 3, D22: 2} and index.pending() == set()


def test_command_line(spark, tmp_path, capsys):
    place = str(tmp_path / "log")
    log_of(spark, D20).write.json(place)
    (tmp_path / "s.csv").write_text("fully_device_id,opening_time,closing_time\nd1,,\n")
    args = (
        f"run-late --index {tmp_path}/index --store {tmp_path}/store --requests {place} --requests-format json "
        f"--signage {tmp_path}/s.csv --signage-format csv"
    ).split()
    assert main(args, spark) == 0
    log_of(spark, D21).write.mode("append").json(place)
    assert main(args, spark) == 0
    days = [json.loads(line).get("process_date") for line in capsys.readouterr().out.splitlines()]
    assert [day for day in days if day] == ["2025-03-20", "2025-03-21"]
    assert VersionedStore(spark, f"{tmp_path}/store").count_days(D20, D21) == {D20: 2, D21: 2}
