"""Sources of the impression query.

Text logs (JSON lines, CSV) may hold broken records. :func:`request_records` reads every record and says
what is wrong with it; :func:`read_requests` fails on the first broken one; :func:`land_requests` copies the
good ones to Parquet in one scan and puts the broken ones aside, up to a limit.
"""

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourboard.functions import times
from hourboard.schemas import SIGNAGE_SCHEMA

TEXT_FORMATS = ("json", "csv")
#: What a strict read of a broken record says first.
MALFORMED = "Malformed record"
# Reasons to put a record aside.
NO_RECORD, NO_TIME, NO_DAY = "not a record", "timestamp that is none", "log date that is none"
BROKEN = "_broken_record"


def request_records(spark: SparkSession, source: str | list[str], fmt: str, log_date: str | None = None) -> DataFrame:
    """Every record of a text log, lazily: ``timestamp, httpRequest, [log_date,] reason, record, file``.

    ``reason`` is NULL for a good record, which has no ``record``. Times without an offset or zone are UTC,
    whatever the session's zone. A record without timestamp is good, and of no day. JSON is one record a line; blank lines
    are none. CSV needs a header with ``timestamp`` and ``requestUrl``; a line with more or fewer cells is broken.
    """
    if fmt == "json":
        lines = spark.read.text(source)
        fields = ["timestamp string", "httpRequest struct<requestUrl: string>", f"{BROKEN} string"]
        inside = log_date is not None and log_date not in lines.columns
        if inside:
            fields.append(f"`{log_date}` string")
        parsed = F.from_json("value", ", ".join(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
        lines = lines.where(F.trim("value") != "").select("*", "_metadata.file_path", parsed.alias("r"))
        url, day = F.col("r.httpRequest.requestUrl"), F.col("r")[log_date] if inside else log_date and F.col(log_date)
        time, broken, record = F.col("r.timestamp"), F.col(f"r.{BROKEN}"), F.col("value")
    elif fmt == "csv":
        names = spark.read.csv(source, header=True).schema
        schema = T.StructType([*names, T.StructField(BROKEN, T.StringType())])
        # All cells are parsed, for a line with too few or too many of them is only noticed then.
        options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "columnPruning": False}
        lines = spark.read.schema(schema).options(**options).csv(source, enforceSchema=False)
        lines = lines.select("*", "_metadata.file_path")
        url, day, time, broken = F.col("requestUrl"), log_date and F.col(log_date), F.col("timestamp"), F.col(BROKEN)
        record = F.coalesce(broken, F.to_csv(F.struct(*[F.col(f"`{f.name}`").cast("string") for f in names])))
    else:
        raise ValueError(f"Not a text format: {fmt}")
    texts = lines.select(
        time.alias("time"), url.alias("url"), broken.alias("broken"), record.alias("text"), "file_path",
        (day if log_date else F.lit(None)).cast("string").alias("day"),
    ).withColumns({"moment": times.instant_of(F.col("time")), "date": F.col("day").try_cast("date")})
    reason = (
        F.when(F.col("broken").isNotNull(), NO_RECORD)
        .when(F.col("time").isNotNull() & F.col("moment").isNull(), NO_TIME)
        .when(F.col("day").isNotNull() & F.col("date").isNull(), NO_DAY)
    )
    return texts.withColumn("reason", reason).select(
        F.col("moment").alias("timestamp"),
        F.struct(F.col("url").alias("requestUrl")).alias("httpRequest"),
        *([F.col("date").alias(log_date)] if log_date else []),
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("text")).alias("record"),
        F.col("file_path").alias("file"),
    )


def read_requests(
    spark: SparkSession, source: str | list[str], fmt: str | None = None, log_date: str | None = None
) -> DataFrame:
    """The request log: a catalog table, or files at a path (or several) when ``fmt`` is given.

    Only the fields the query uses (and the partition column ``log_date``) are kept; the rest of
    ``httpRequest`` is never read. A broken record of a text log fails the reading, as :func:`request_records`
    tells it.
    """
    if fmt in TEXT_FORMATS:
        records = request_records(spark, source, fmt, log_date)
        return records.select(
            _or_fail(F.col("timestamp")).alias("timestamp"), "httpRequest", *([log_date] if log_date else [])
        )
    log = spark.read.format(fmt).load(source) if fmt else spark.table(source)
    url = F.struct(F.col("httpRequest.requestUrl").alias("requestUrl")).alias("httpRequest")
    return log.select("timestamp", url, *([F.col(log_date).cast("date")] if log_date else []))


def _or_fail(value: Column) -> Column:
    text = F.concat(F.lit(f"{MALFORMED}, "), F.col("reason"), F.lit(": "), F.substring("record", 1, 200))
    return F.when(F.col("reason").isNull(), value).otherwise(F.raise_error(text).cast("timestamp"))


class RejectedRecords(ValueError):
    """More broken records than a load allows."""


@dataclass(frozen=True)
class LandedLog:
    """A text log as Parquet: ``requests`` as the query reads them, and ``rejects`` (``reason, record, file``)."""

    requests: DataFrame
    rejects: DataFrame
    accepted: int
    rejected: int


def land_requests(
    spark: SparkSession,
    source: str,
    fmt: str,
    place: str,
    log_date: str | None = None,
    max_rejects: int = 0,
) -> LandedLog:
    """Copies a text log to the folder ``place``, which must not exist, in one scan.

    Good and broken records go to partitions of their own, and within them to one per log date, if there is one. How
    many they are is read back from the files' footers, so repeated tasks do not count twice. More than ``max_rejects``
    broken ones raise :class:`RejectedRecords`; they stay in ``place`` to be looked at.

    What is landed can be loaded any number of times without parsing text, by columns and by time.
    """
    records = request_records(spark, source, fmt, log_date)
    kept = records.withColumn("rejected", F.col("reason").isNotNull())
    writer = kept.write.partitionBy("rejected", *([log_date] if log_date else []))
    writer.option("compression", "zstd").parquet(place)
    landed = spark.read.schema(kept.schema).parquet(place)
    counts = dict(landed.groupBy("rejected").agg(F.count(F.lit(1))).collect())  # two rows at most
    good, bad = counts.get(False, 0), counts.get(True, 0)
    if bad > max_rejects:
        raise RejectedRecords(f"{bad} of {good + bad} records are broken, at most {max_rejects} are allowed: {place}")
    columns = ["timestamp", "httpRequest", *([log_date] if log_date else [])]
    return LandedLog(
        landed.where("not rejected").select(*columns),
        landed.where("rejected").select("reason", "record", "file"),
        good,
        bad,
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``(reason, rejected, example)`` of the rejects of a log."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"), F.min("record").alias("example"))


def read_signage(spark: SparkSession, table: str) -> DataFrame:
    """The signage dimension from the catalog."""
    return spark.table(table).select(*SIGNAGE_SCHEMA.fieldNames())


def read_signage_csv(spark: SparkSession, path: str) -> DataFrame:
    """The signage sheet exported as CSV with a header row; empty cells read as NULL.

    Columns are found by name, in any order; further ones are left alone.
    """
    sheet = spark.read.csv(path, header=True, mode="FAILFAST")
    return sheet.select(*SIGNAGE_SCHEMA.fieldNames())


def import_signage(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Copy the sheet to a catalog table, replacing the previous copy."""
    read_signage_csv(spark, path).write.mode("overwrite").format("parquet").saveAsTable(table)
    return read_signage(spark, table)


def run_sql(
    spark: SparkSession, query: str, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Any SQL text, with ``:name`` parameters bound as values. Lazy; no rows is an empty frame."""
    return spark.sql(query, args=dict(params)) if params else spark.sql(query)
