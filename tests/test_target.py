"""Replacing, clearing, appending and counting days of a stored table."""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourboard.schemas import TARGET_COLUMNS, target_schema
from hourboard.sinks import target
from hourboard.sinks.environments import Environment, get_environment

D20, D21, D22, D23 = (dt.date(2025, 3, day) for day in (20, 21, 22, 23))


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    target.ensure_table(spark, name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def day_rows(spark, *days, imp=1):
    """24 hourly rows for each Tokyo day."""
    rows = []
    for day in days:
        start = dt.datetime.combine(day, dt.time.min) - dt.timedelta(hours=9)
        for hour in range(24):
            moment = start + dt.timedelta(hours=hour)
            rows.append((moment, 2, 618, f"d{hour % 3}", 90, 11, 245 - hour, 1314, imp, 20, day))
    return spark.createDataFrame(rows, target_schema())


def state(spark, table):
    """Rows and distinct hours, of the whole table."""
    hours = F.countDistinct("timestamp_hourly")
    return tuple(spark.table(table).agg(F.count("*"), hours).first())


def load(spark, table, *days):
    for day in days:
        target.replace_days(spark, table, day_rows(spark, day), day, day)


def test_schema(spark, table):
    assert spark.table(table).schema == target_schema()
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["dt"]
    target.ensure_table(spark, table)  # already there: left alone


@pytest.mark.parametrize(
    "order", [(D20, D21, D22), (D20, D21, D22, D21), (D22, D21, D20), (D21, D22, D20, D22, D20)]
)
def test_days_in_any_order_and_again(spark, table, order):
    load(spark, table, *order)
    assert state(spark, table) == (72, 72)


def test_range_again(spark, table):
    for _ in range(2):
        counts = target.replace_days(spark, table, day_rows(spark, D20, D21, D22), D20, D22)
        assert counts == {D20: 24, D21: 24, D22: 24}
    assert state(spark, table) == (72, 72)


def test_new_rows_replace_old(spark, table):
    load(spark, table, D20, D21)
    target.replace_days(spark, table, day_rows(spark, D21, imp=5).limit(3), D21, D21)
    imps = dict(spark.table(table).groupBy("dt").agg(F.sum("imp")).collect())
    assert imps == {D20: 24, D21: 15}


def test_empty_day_clears_only_that_day(spark, table):
    load(spark, table, D20, D21, D22)
    nothing = day_rows(spark, D21).where("imp < 0")
    assert target.replace_days(spark, table, nothing, D21, D21) == {D21: 0}
    assert state(spark, table) == (48, 48)
    assert target.replace_days(spark, table, nothing, D21, D21) == {D21: 0}


def test_gap_inside_a_range_is_cleared(spark, table):
    load(spark, table, D20, D21, D22, D23)
    counts = target.replace_days(spark, table, day_rows(spark, D20, D22), D20, D22)
    assert counts == {D20: 24, D21: 0, D22: 24}
    assert target.count_days(spark, table, D20, D23) == {D20: 24, D21: 0, D22: 24, D23: 24}


@pytest.mark.parametrize("stray", [D20, None])
def test_rows_of_other_days_are_refused(spark, table, stray):
    load(spark, table, D20)
    rows = day_rows(spark, D20, D21, imp=9)
    day = F.when(F.col("dt") == F.lit(D20), F.lit(stray).cast("date")).otherwise(F.col("dt"))
    with pytest.raises(Exception, match="outside the load"):
        target.replace_days(spark, table, rows.withColumn("dt", day), D21, D21)
    assert spark.table(table).where("imp = 9").count() == 0
    assert state(spark, table) == (24, 24)


@pytest.fixture
def placed(spark, tmp_path):
    """A table with a location of its own, with a quote in its path."""
    name, place = f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "it's")
    target.ensure_table(spark, name, location=place)
    yield name, place
    spark.sql(f"DROP TABLE {name}")


def test_cleared_days_are_gone_from_storage(spark, placed):
    table, place = placed
    load(spark, table, D20, D21)
    nothing = day_rows(spark, D21).where("imp < 0")
    assert target.replace_days(spark, table, nothing, D21, D21) == {D21: 0}
    assert spark.read.parquet(place).count() == 24
    assert target.append_rows(spark, table, day_rows(spark, D21).limit(1)) == 1
    assert target.count_days(spark, table, D20, D21) == {D20: 24, D21: 1}
    target.truncate(spark, table)
    assert state(spark, table) == (0, 0)
    load(spark, table, D22)
    assert spark.read.parquet(place).select("dt").distinct().collect() == [(D22,)]


def test_overlapping_loads_keep_each_others_days(spark, table):
    """Loads of three days, of which none ends before all have begun to write."""
    load(spark, table, D20)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda day: load(spark, table, day), [D21, D22, D23] * 3))
    assert target.count_days(spark, table, D20, D23) == dict.fromkeys((D20, D21, D22, D23), 24)
    assert state(spark, table) == (96, 96)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_append_of_an_unknown_field_is_refused(spark, table):
    record = {"timestamp_hourly": dt.datetime(2025, 3, 22), "mediumid": 2}
    with pytest.raises(ValueError, match="mediumid"):
        target.append_records(spark, table, [record])


def test_a_range_has_a_bound(spark, table):
    with pytest.raises(ValueError, match="days"):
        target.replace_days(spark, table, day_rows(spark, D20), dt.date(1900, 1, 1), dt.date(2025, 1, 1))


def test_failure_leaves_the_old_day(spark, table):
    load(spark, table, D20)
    broken = day_rows(spark, D20).withColumn("imp", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        target.replace_days(spark, table, broken, D20, D20)
    assert state(spark, table) == (24, 24)


def test_append_adds(spark, table):
    load(spark, table, D20)
    assert target.append_rows(spark, table, day_rows(spark, D20)) == 24
    assert state(spark, table) == (48, 24)


# Sample rows of the target.
SAMPLES = [
    ("2025-03-22 19:00:00", 2, 618, "36b05fbe-c2e2dcde", 90, 11, 245, 1314, 19, 19),
    ("2025-03-22 20:00:00", 7, 585, "91e158a7-dec70a8", 59, 9, 152, 1425, 17, 17),
    ("2025-03-22 20:00:00", 1, 903, "91e7a61b-dec70a8", 85, 7, 330, 1364, 18, 18),
]


@pytest.mark.parametrize("kind", [T.TimestampType(), T.TimestampNTZType()])
@pytest.mark.parametrize("zone", [None, dt.timezone.utc, dt.timezone(dt.timedelta(hours=9))])
def test_records(spark, kind, zone):
    table = f"t_{uuid.uuid4().hex[:8]}"
    target.ensure_table(spark, table, kind)
    records = []
    for moment, *rest in SAMPLES:
        stamp = dt.datetime.fromisoformat(moment)
        if zone:
            stamp = stamp.replace(tzinfo=dt.timezone.utc).astimezone(zone)
        records.append(dict(zip(TARGET_COLUMNS, [stamp, *rest])))
    assert target.append_records(spark, table, []) == 0
    assert target.append_records(spark, table, records) == 3
    assert target.count_days(spark, table, D22, D23) == {D22: 0, D23: 3}
    text = F.col("timestamp_hourly").cast("string")
    stored = spark.table(table).select(text, *TARGET_COLUMNS[1:-1]).collect()
    assert sorted(map(tuple, stored)) == sorted(SAMPLES)
    target.truncate(spark, table)
    assert target.count_days(spark, table, D23, D23) == {D23: 0}
    spark.sql(f"DROP TABLE {table}")


def test_files_of_a_day_are_clustered(spark, table):
    load(spark, table, D20)
    for file in spark.table(table).inputFiles():
        values = [row["creativeId"] for row in spark.read.parquet(file).collect()]
        assert values == sorted(values)


def test_one_overfull_group_is_spread(spark):
    """Rows equal in all cluster keys still fall into many ranges."""
    rows = spark.range(20_000).select(
        F.timestamp_seconds(F.col("id") % 24 * 3600).alias("timestamp_hourly"),
        F.lit(1).alias("mediumId"),
        F.lit(1).alias("storeId"),
        F.concat(F.lit("d"), F.col("id")).alias("device_id"),
        *[F.lit(1).alias(n) for n in ("programId", "sequence", "creativeId", "deliveryId")],
        *[F.lit(1).alias(n) for n in ("imp", "cnt")],
        F.lit(D20).alias("dt"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = target.arrange(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 8
    assert max(row["count"] for row in parts) < 2 * 20_000 / 8


def test_day_predicate_prunes_partitions(spark, table):
    load(spark, table, D20, D21)
    plan = spark.table(table).where(F.col("dt") == F.lit(D20))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_zoneless_target(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    target.ensure_table(spark, name, T.TimestampNTZType())
    assert spark.table(name).schema["timestamp_hourly"].dataType == T.TimestampNTZType()
    spark.sql(f"DROP TABLE {name}")


def test_environments():
    assert get_environment().target == "sg_reports_tmp.signage_impressions"
    assert get_environment("production").target == "sg_reports_production.signage_impressions"
    assert get_environment("staging", "lake").target == (
        "lake.sg_reports_staging.signage_impressions"
    )
    with pytest.raises(ValueError, match="Unknown environment: test"):
        get_environment("test")


def test_qualify():
    bare, lake = Environment("db"), Environment("db", catalog="lake")
    assert bare.qualify("t") == "db.t"
    assert lake.qualify("t") == "lake.db.t"
    assert lake.qualify("other.t") == "lake.other.t"
    assert lake.qualify("c.other.t") == "c.other.t"
    for bad in ("", "a.b.c.d", "a..b"):
        with pytest.raises(ValueError):
            bare.qualify(bad)
