"""Creating, replacing and counting days of the target table.

Days are Tokyo days, kept in the partition column ``dt``, each in its folder below the table's. A day
is replaced by one overwrite of its folder when the new rows are complete; nothing is deleted
beforehand, so a failed load leaves the old day in place. Loads of different days may overlap: each
stages its files in a folder of its own, and no setting of the session is touched. Two writers of one
day at a time are not told apart: an overwrite is no lock.
"""

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourboard.plans.impressions import with_business_date
from hourboard.schemas import CLUSTER_KEYS, KEYS, TARGET_COLUMNS, target_schema

#: Days a range can have: what one bitmap holds.
MAX_DAYS = 32_768


def ensure_table(
    spark: SparkSession,
    table: str,
    timestamp_type: T.DataType = T.TimestampType(),
    location: str | None = None,
) -> None:
    """Create the target (and its database) if absent."""
    *qualifier, _ = table.split(".")
    if qualifier:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted('.'.join(qualifier))}")
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}" for field in target_schema(timestamp_type)
    )
    place = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) "
        f"USING parquet PARTITIONED BY (dt){place}"
    )


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """The days ``first``..``last``; none when they are reversed."""
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def arrange(rows: DataFrame) -> DataFrame:
    """Spread rows over the files of each day by the cluster keys, and sort each file by them.

    The remaining keys only break ties, so even one overfull day or medium is cut into ranges of
    equal size.
    """
    leading = ("dt", *CLUSTER_KEYS)
    ties = [key for key in KEYS if key not in leading]
    return rows.repartitionByRange(*leading, *ties).sortWithinPartitions(*leading)


def replace_days(
    spark: SparkSession, table: str, rows: DataFrame, first: dt.date, last: dt.date
) -> dict[dt.date, int]:
    """Make the days ``first``..``last`` of the table hold exactly ``rows``; rows per day.

    A row of any other day fails the load, which then changes nothing. Every day with rows is swapped
    in by one dynamic overwrite of the table's folder; which days have none is found out during that
    write, by one bitmap for all, and they are cleared after it. Between the two commits such a day
    still has its old rows; loading it again ends in the same state. Counts are read back from the
    committed files, whose footers hold them.
    """
    days = days_between(first, last)
    if not days:
        return {}
    if len(days) > MAX_DAYS:
        raise ValueError(f"A load takes at most {MAX_DAYS} days, not {len(days)}")
    rows = only_days(rows, first, last)
    place = table_location(spark, table)
    seen = Observation()
    bit = F.bitmap_bit_position(F.datediff("dt", F.lit(first)) + 1)
    written = arrange(rows).observe(seen, F.bitmap_construct_agg(bit).alias("days"))
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(place)
    bits = seen.get.get("days") or b""
    filled = {day for n, day in enumerate(days) if n // 8 < len(bits) and bits[n // 8] >> n % 8 & 1}
    specs = " ".join(_partition(day) for day in sorted(filled))
    if specs:
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(_quoted(table))
    clear_days(spark, table, [day for day in days if day not in filled])
    return count_days(spark, table, first, last)


def only_days(rows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """``rows`` in table order; one of a day outside ``first``..``last`` fails whatever uses them."""
    day = F.col("dt")
    refused = F.raise_error(F.concat(F.lit("Row of a day outside the load: "), F.coalesce(day.cast("string"), F.lit("NULL"))))
    inside = F.when(day.between(first, last), day).otherwise(refused.cast("date")).alias("dt")
    return rows.select(*[inside if name == "dt" else name for name in TARGET_COLUMNS])


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of the table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}")
    return described.where("col_name = 'Location'").first()["data_type"]


def clear_days(spark: SparkSession, table: str, days: Iterable[dt.date]) -> None:
    """Drop the partitions of ``days``, where they exist, and their files, wherever the table lies."""
    names = {f"dt={day.isoformat()}" for day in days}
    if not names:
        return
    known = names & {row[0] for row in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()}
    specs = ", ".join(_partition(dt.date.fromisoformat(name[3:])) for name in sorted(known))
    if specs:
        spark.sql(f"ALTER TABLE {_quoted(table)} DROP IF EXISTS {specs}")
    place = spark._jvm.org.apache.hadoop.fs.Path(table_location(spark, table))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = files.listStatus(place) if files.exists(place) else ()
    for folder in folders:
        if folder.getPath().getName() in names:
            files.delete(folder.getPath(), True)
    spark.catalog.refreshTable(_quoted(table))


def _partition(day: dt.date) -> str:
    return f"PARTITION (dt = DATE '{day.isoformat()}')"


def append_rows(spark: SparkSession, table: str, rows: DataFrame) -> int:
    """Add rows to the target, whatever its days hold already; how many they were.

    They are staged in a folder of their own and their files then moved to their days, so appends of several processes
    do not touch each other's. A repeated batch is added again; :class:`~hourboard.sinks.versions.VersionedStore`
    knows batches.
    """
    place = table_location(spark, table)
    staged = f"{place.rstrip('/')}/_append-{uuid.uuid4().hex}"
    arrange(rows.select(*TARGET_COLUMNS)).write.partitionBy("dt").parquet(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [status.getPath() for status in files.listStatus(path(staged)) if status.isDirectory()]
    written = spark.read.schema(spark.table(table).schema).parquet(staged)
    count = written.count() if folders else 0
    days = []
    for folder in folders:
        day = path(place, folder.getName())
        files.mkdirs(day)
        for status in files.listStatus(folder):
            if not files.rename(status.getPath(), path(day, status.getPath().getName())):
                raise OSError(f"Cannot move {status.getPath()} to {day}")
        days.append(folder.getName().removeprefix("dt="))
    files.delete(path(staged), True)
    known = [day for day in days if day != "__HIVE_DEFAULT_PARTITION__"]
    if known:
        specs = " ".join(_partition(dt.date.fromisoformat(day)) for day in sorted(known))
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(_quoted(table))
    return count


def append_records(spark: SparkSession, table: str, records: list[Mapping[str, Any]]) -> int:
    """Add a few records at hand; none at all is no write. Naive timestamps are UTC.

    A field the table does not have is refused; one left out is NULL.
    """
    if not records:
        return 0
    kind = spark.table(table).schema["timestamp_hourly"].dataType
    fields = target_schema(kind).fields[:-1]
    unknown = {name for record in records for name in record} - {field.name for field in fields}
    if unknown:
        raise ValueError(f"Unknown fields: {', '.join(sorted(unknown))}")
    moments = [_utc(record["timestamp_hourly"], kind) for record in records]
    values = [
        (moment, *[record.get(field.name) for field in fields[1:]])
        for moment, record in zip(moments, records)
    ]
    rows = spark.createDataFrame(values, T.StructType(fields))
    return append_rows(spark, table, with_business_date(rows))


def _utc(moment: dt.datetime, kind: T.DataType) -> dt.datetime:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    naive = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return naive if isinstance(kind, T.TimestampNTZType) else moment


def truncate(spark: SparkSession, table: str) -> None:
    """Empty the target, keeping its definition. Its files go as well, wherever the table lies."""
    partitions = spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()  # one row a day
    clear_days(spark, table, [dt.date.fromisoformat(row[0].removeprefix("dt=")) for row in partitions])


def rows_per_day(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


def count_days(
    spark: SparkSession, table: str, first: dt.date, last: dt.date
) -> dict[dt.date, int]:
    """Rows of each of the days ``first``..``last``. Other partitions are not touched."""
    found = rows_per_day(spark, table).where(F.col("dt").between(first, last)).collect()
    counts = {row["dt"]: row["row_count"] for row in found}
    return {day: counts.get(day, 0) for day in days_between(first, last)}


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))
