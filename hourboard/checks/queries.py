"""Registered queries: name -> (spark, sf_dir) -> DataFrame. Each reads whole tables."""

import datetime as dt
import sys
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.checks import testbed
from hourboard.functions import hours, times, urls
from hourboard.jobs import ImpressionJob, run_summary
from hourboard.operators import counts, signage, tracking
from hourboard.plans.impressions import hourly_impressions, with_business_date
from hourboard.scratch import scratch_path
from hourboard.schemas import TARGET_COLUMNS
from hourboard.sinks import target
from hourboard.sinks.versions import VersionedStore
from hourboard.sources import readers
from hourboard.sources.arrivals import ArrivalIndex

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
ONE_DAY = dt.date(2024, 1, 10)
PARAMS = (
    "mediumId storeId device_id programId sequence creativeId deliveryId event send_ts networkId"
).split()
FORMATS = {
    "iso_day": "YYYY-MM-DD",
    "slashed": "YYYY/MM/DD",
    "iso_second": "YYYY-MM-DD HH:mm:ss",
    "month_first": "MM/DD/YYYY",
    "dotted": "DD.MM.YYYY",
}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


# --- the impression query ---


@query("hourly_impressions")
def hourly_impressions_month(spark, sf_dir):
    return hourly_impressions(
        testbed.request_log(spark, sf_dir), testbed.signage_table(spark, sf_dir), FIRST, LAST
    )


@query("hourly_impressions_day")
def hourly_impressions_day(spark, sf_dir):
    return hourly_impressions(
        testbed.request_log(spark, sf_dir), testbed.signage_table(spark, sf_dir), ONE_DAY
    )


@query("hourly_impressions_hours")
def hourly_impressions_hours(spark, sf_dir):
    return hourly_impressions(
        testbed.request_log(spark, sf_dir),
        testbed.signage_table(spark, sf_dir),
        FIRST,
        LAST,
        start_hour=8,
        end_hour=19,
        default_opening="10:00",
        default_closing="18:30",
    )


def _instant(ts):
    """The instant of a UTC wall clock, whatever the session time zone."""
    return F.to_timestamp(F.concat(ts.cast("string"), F.lit("+00:00")))


def _instants(log: DataFrame) -> DataFrame:
    return log.withColumn("timestamp", _instant(F.col("timestamp")))


@query("hourly_impressions_instants")
def hourly_impressions_instants(spark, sf_dir):
    """The log with instants, which the results keep; shown as UTC wall clock."""
    log = _instants(testbed.request_log(spark, sf_dir))
    rows = hourly_impressions(log, testbed.signage_table(spark, sf_dir), FIRST, LAST)
    return rows.withColumn("timestamp_hourly", times.utc_wall(F.col("timestamp_hourly"), ntz=False))


def _in_zone(spark, sf_dir, days: int, zone: str, first: dt.date, last: dt.date):
    """Impressions of a log moved by some days, by the days and hours of a zone."""
    log = testbed.request_log(spark, sf_dir)
    log = log.withColumn("timestamp", F.col("timestamp") + F.expr(f"INTERVAL {days} DAYS"))
    return hourly_impressions(log, testbed.signage_table(spark, sf_dir), first, last, zone=zone)


@query("hourly_impressions_new_york")
def hourly_impressions_new_york(spark, sf_dir):
    """With a day of 23 hours in the range."""
    return _in_zone(spark, sf_dir, 60, "America/New_York", dt.date(2024, 3, 5), dt.date(2024, 3, 20))


@query("hourly_impressions_adelaide")
def hourly_impressions_adelaide(spark, sf_dir):
    """With a day of 25 hours in the range, and hours that begin at half past of UTC; by their local date too."""
    rows = _in_zone(spark, sf_dir, 80, "Australia/Adelaide", dt.date(2024, 4, 1), dt.date(2024, 4, 15))
    return with_business_date(rows, "Australia/Adelaide")


@query("stored_log_impressions")
def stored_log_impressions(spark, sf_dir):
    """A log stored by UTC date and a signage table of the catalog, through the readers."""
    path = scratch_path(spark, "log")
    log = _instants(testbed.request_log(spark, sf_dir))
    days = log.withColumn("log_date", F.to_date(times.utc_wall(F.col("timestamp"), ntz=False)))
    days.repartition("log_date").write.partitionBy("log_date").parquet(path)
    name = _fresh("signage")
    place = scratch_path(spark, "signage")
    testbed.signage_table(spark, sf_dir).write.option("path", place).saveAsTable(name)
    requests = readers.read_requests(spark, path, "parquet", log_date="log_date")
    listed = readers.read_signage(spark, name)
    spark.sql(f"DROP TABLE {name}")  # analysed already; its files stay
    rows = hourly_impressions(requests, listed, FIRST, LAST, log_date="log_date")
    return rows.withColumn("timestamp_hourly", times.utc_wall(F.col("timestamp_hourly"), ntz=False))


def _landed(spark, sf_dir) -> readers.LandedLog:
    """A JSON log with broken lines, landed."""
    source = scratch_path(spark, "lines")
    testbed.request_lines(spark, sf_dir).write.text(source)
    return readers.land_requests(spark, source, "json", scratch_path(spark, "landed"), max_rejects=sys.maxsize)


@query("stored_log_accepted")
def stored_log_accepted(spark, sf_dir):
    """Impressions of what a JSON log with broken lines holds besides them."""
    rows = hourly_impressions(_landed(spark, sf_dir).requests, testbed.signage_table(spark, sf_dir), FIRST, LAST)
    return rows.withColumn("timestamp_hourly", times.utc_wall(F.col("timestamp_hourly"), ntz=False))


@query("stored_log_rejects")
def stored_log_rejects(spark, sf_dir):
    """Its broken lines and what is wrong with them."""
    return _landed(spark, sf_dir).rejects.select("reason", "record")


@query("text_log_times")
def text_log_times(spark, sf_dir):
    """The moments of a CSV log whose times have an offset, a zone or neither, as UTC wall clock."""
    source = scratch_path(spark, "sheet")
    testbed.request_sheet(spark, sf_dir).write.csv(source, header=True)
    log = readers.read_requests(spark, source, "csv")
    return log.select(
        urls.safe_int(urls.param_text(tracking.request_url(), "send_ts")).alias("event_id"),
        times.utc_wall(F.col("timestamp"), ntz=False).alias("moment"),
    )


@query("hourly_impressions_devices")
def hourly_impressions_devices(spark, sf_dir):
    return hourly_impressions(
        testbed.request_log(spark, sf_dir, testbed.WIDE_URL),
        testbed.signage_table(spark, sf_dir),
        FIRST,
        LAST,
    )


@query("hourly_impressions_shuffled")
def hourly_impressions_shuffled(spark, sf_dir):
    """As above, in the form taken when the signage table is too large to broadcast."""
    return hourly_impressions(
        testbed.request_log(spark, sf_dir, testbed.WIDE_URL),
        testbed.signage_table(spark, sf_dir),
        FIRST,
        LAST,
        broadcast_limit_bytes=0,
    )


@query("signage_fanout")
def signage_fanout(spark, sf_dir):
    return hourly_impressions(
        testbed.request_log(spark, sf_dir, testbed.WIDE_URL),
        testbed.signage_table(spark, sf_dir, testbed.LISTED_AGAIN),
        FIRST,
        LAST,
    )


@query("signage_fanout_shuffled")
def signage_fanout_shuffled(spark, sf_dir):
    return hourly_impressions(
        testbed.request_log(spark, sf_dir, testbed.WIDE_URL),
        testbed.signage_table(spark, sf_dir, testbed.LISTED_AGAIN),
        FIRST,
        LAST,
        broadcast_limit_bytes=0,
    )


# --- URLs ---


@query("url_params")
def url_params(spark, sf_dir):
    url = tracking.request_url()
    return testbed.request_log(spark, sf_dir, testbed.WIDE_URL).select(
        "timestamp", *[urls.query_param(url, key).alias(key) for key in PARAMS]
    )


@query("url_path_pages")
def url_path_pages(spark, sf_dir):
    return testbed.read(spark, sf_dir, "pages").select(
        "page_id", urls.url_path(F.col("url")).alias("path")
    )


@query("page_params")
def page_params(spark, sf_dir):
    return testbed.read(spark, sf_dir, "pages").select(
        "page_id",
        *[
            urls.query_param(F.col("url"), key, decode=True).alias(key)
            for key in ("page", "ref", "utm_source")
        ],
    )


@query("tracking_filter")
def tracking_filter(spark, sf_dir):
    log = testbed.request_log(spark, sf_dir)
    return log.where(tracking.is_tracking_url(tracking.request_url())).select(
        "timestamp", tracking.request_url().alias("url")
    )


@query("safe_cast")
def safe_cast(spark, sf_dir):
    """Trailing path segments of pages (numbers, file names); signed, long and spoilt event ids."""
    pages = testbed.read(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "/([^/?#]*)/?([?#].*)?$", 1).alias("text")
    )
    events = testbed.read(spark, sf_dir, "events").select(
        F.expr(
            """CASE event_type WHEN 'view' THEN '+' || CAST(event_id AS string)
               WHEN 'click' THEN CAST(event_id AS string) || '000000000000000'
               WHEN 'signup' THEN '-' || CAST(event_id AS string)
               WHEN 'error' THEN CAST(event_id AS string) || 'x'
               ELSE CAST(event_id AS string) END"""
        ).alias("text")
    )
    return pages.unionByName(events).select("text", urls.safe_int(F.col("text")).alias("number"))


# --- time ---


def _local(column: str = "ts"):
    return times.local_ts(F.col(column), ntz=True)


@query("day_window")
def day_window(spark, sf_dir):
    window = times.day_window(F.col("ts"), True, FIRST, LAST, start_hour=8, end_hour=19)
    return testbed.read(spark, sf_dir, "events").where(window).select("event_id", "ts")


@query("hour_bucket")
def hour_bucket(spark, sf_dir):
    events = testbed.read(spark, sf_dir, "events")
    bucketed = events.select(times.hour_bucket(F.col("ts"), ntz=True).alias("hour"), "value")
    return bucketed.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))


@query("hour_buckets_pair")
def hour_buckets_pair(spark, sf_dir):
    """Two buckets of one select, of an instant and of a zone-less time that views do not have."""
    events = testbed.read(spark, sf_dir, "events")
    local = F.when(F.col("event_type") != "view", _local())
    return events.select(
        "event_id",
        times.utc_wall(times.hour_bucket(_instant(F.col("ts")), ntz=False), ntz=False).alias("hour"),
        times.hour_bucket(local, ntz=True).alias("local_hour"),
    )


@query("local_hhmm")
def local_hhmm(spark, sf_dir):
    return testbed.read(spark, sf_dir, "events").select(
        "event_id",
        times.hhmm(_local()).alias("hm"),
        times.minute_of_day(_local()).alias("minute"),
        times.pad_hour(F.hour(_local())).alias("hh"),
    )


@query("business_date_counts")
def business_date_counts(spark, sf_dir):
    days = testbed.read(spark, sf_dir, "events").select(
        times.business_date(_local()).alias("business_date"), F.to_date("ts").alias("utc_date")
    )
    return days.groupBy("business_date", "utc_date").agg(F.count(F.lit(1)).alias("n"))


@query("yesterday_local")
def yesterday_local(spark, sf_dir):
    return testbed.read(spark, sf_dir, "events").select(
        "event_id", times.yesterday(F.col("ts"), ntz=True).alias("yesterday")
    )


@query("date_range")
def date_range(spark, sf_dir):
    """Days from a user's first purchase to their last signup; reversed spans give none."""
    spans = (
        testbed.read(spark, sf_dir, "events")
        .select("user_id", "event_type", times.business_date(_local()).alias("day"))
        .groupBy("user_id")
        .agg(
            F.min(F.when(F.col("event_type") == "purchase", F.col("day"))).alias("first"),
            F.max(F.when(F.col("event_type") == "signup", F.col("day"))).alias("last"),
        )
    )
    return spans.select(
        "user_id", F.explode(times.date_range(F.col("first"), F.col("last"))).alias("day")
    )


@query("date_format_tokens")
def date_format_tokens(spark, sf_dir):
    return testbed.read(spark, sf_dir, "events").select(
        "event_id", *[times.format_date(F.col("ts"), fmt).alias(n) for n, fmt in FORMATS.items()]
    )


@query("valid_dates")
def valid_dates(spark, sf_dir):
    """Date texts put together from order keys: bad months and days, missing padding, slashes."""
    orders = testbed.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(
            """CAST(1995 + o_orderkey % 10 AS string)
               || CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '-' END
               || CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_custkey % 14 AS string)
                  ELSE lpad(CAST(o_custkey % 14 AS string), 2, '0') END
               || '-' || lpad(CAST(o_orderkey % 33 AS string), 2, '0')"""
        ).alias("text"),
    )
    return orders.withColumn("valid", times.is_valid_date(F.col("text")))


# --- opening hours, join, counts ---


#: A device may have a third of all events, so its listings are repeated and its events dealt.
DEALS = 16


@query("business_hours_flag")
def business_hours_flag(spark, sf_dir):
    events = testbed.read(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("fully_device_id"),
        times.hhmm(_local()).alias("hm"),
        F.pmod("event_id", F.lit(DEALS)).cast("int").alias("deal"),
    )
    table = testbed.signage_table(spark, sf_dir)
    repeated = table.withColumn("deal", F.explode(F.array(*map(F.lit, range(DEALS)))))
    return events.join(repeated, ["fully_device_id", "deal"], "left").select(
        "event_id",
        hours.in_business_hours(F.col("hm"), F.col("opening_time"), F.col("closing_time")).alias(
            "in_hours"
        ),
    )


@query("signage_hours")
def signage_hours(spark, sf_dir):
    """Every listing's hours with defaults, and their ranks among the minutes of the day."""
    table = testbed.signage_table(spark, sf_dir, testbed.LISTED_AGAIN)
    opening = hours.hour_text(F.col("opening_time"), hours.DEFAULT_OPENING)
    closing = hours.hour_text(F.col("closing_time"), hours.DEFAULT_CLOSING)
    return table.select(
        "fully_device_id",
        opening.alias("opening"),
        closing.alias("closing"),
        hours.minute_rank(opening).alias("opens"),
        hours.minute_rank(closing).alias("closes"),
    )


@query("signage_left_join")
def signage_left_join(spark, sf_dir):
    """Per request, how many rows the left join makes of it and how many of them are in hours."""
    url = tracking.request_url()
    plays = testbed.request_log(spark, sf_dir, testbed.WIDE_URL).select(
        urls.safe_int(urls.param_text(url, "send_ts")).alias("event_id"),
        urls.query_param(url, "device_id").alias("device_id"),
        times.minute_of_day(_local("timestamp")).alias("minute"),
    )
    devices = signage.device_hours(
        testbed.signage_table(spark, sf_dir, testbed.LISTED_AGAIN)
    )
    fits = devices.size_bytes <= signage.BROADCAST_LIMIT_BYTES
    return signage.join_hours(plays, devices, broadcast=fits).select(
        "event_id",
        "device_id",
        signage.listing_weight().cast("bigint").alias("joined_rows"),
        signage.open_weight(devices).cast("bigint").alias("open_rows"),
    )


def _counted(spark, sf_dir) -> DataFrame:
    plays = tracking.play_keys(
        tracking.filter_tracking(
            testbed.request_log(spark, sf_dir, testbed.WIDE_URL), FIRST, LAST
        )
    )
    devices = signage.device_hours(testbed.signage_table(spark, sf_dir))
    fits = devices.size_bytes <= signage.BROADCAST_LIMIT_BYTES
    plays = plays if fits else counts.count_by_minute(plays)
    return counts.count_groups(signage.join_hours(plays, devices, fits), devices)


@query("conditional_sum_count")
def conditional_sum_count(spark, sf_dir):
    """Both measures of every group, also of those without an impression."""
    return _counted(spark, sf_dir)


@query("having_positive")
def having_positive(spark, sf_dir):
    """Groups left, and their plays, per Tokyo day after dropping groups without impressions."""
    kept = with_business_date(counts.with_impressions(_counted(spark, sf_dir)))
    return kept.groupBy("dt").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("imp").alias("imp"), F.sum("cnt").alias("cnt")
    )


# --- loading ---


def _fresh(name: str) -> str:
    return f"hourboard_{name}_{uuid.uuid4().hex[:8]}"


def _job(spark, sf_dir) -> ImpressionJob:
    return ImpressionJob(
        spark,
        testbed.request_log(spark, sf_dir),
        testbed.signage_table(spark, sf_dir),
        table=_fresh("target"),
        location=scratch_path(spark, "target"),
    )


def _content(job: ImpressionJob) -> DataFrame:
    """What the folder of the target holds. The table is dropped from the catalog; its files stay."""
    table = job.spark.table(job.table)
    columns = [F.col(name).cast(table.schema[name].dataType) for name in TARGET_COLUMNS]
    job.spark.sql(f"DROP TABLE {job.table}")
    return job.spark.read.schema(table.schema).parquet(job.location).select(*columns)


def _logged(job: ImpressionJob, log: DataFrame) -> DataFrame:
    """A run log, which needs the table no more."""
    job.spark.sql(f"DROP TABLE IF EXISTS {job.table}")
    return log


@query("replace_day_twice")
def replace_day_twice(spark, sf_dir):
    job = _job(spark, sf_dir)
    job.run_range(FIRST, LAST)
    job.run(ONE_DAY)
    job.reprocess(ONE_DAY.isoformat())
    return _content(job)


@query("replace_range_backward")
def replace_range_backward(spark, sf_dir):
    job = _job(spark, sf_dir)
    for first, last in ((21, 31), (11, 22), (1, 11)):
        job.run_range(dt.date(2024, 1, first), dt.date(2024, 1, last))
    return _content(job)


@query("empty_day_clear")
def empty_day_clear(spark, sf_dir):
    """A loaded day whose requests have since gone ends empty when it is loaded again."""
    job = _job(spark, sf_dir)
    job.run_range(FIRST, LAST)
    gone = times.business_date(_local("timestamp")) == F.lit(ONE_DAY)
    job.requests = job.requests.where(~gone)
    job.run_range(ONE_DAY - dt.timedelta(days=1), ONE_DAY + dt.timedelta(days=1))
    return _content(job)


@query("append_rows")
def append_rows(spark, sf_dir):
    """The month appended to an empty table in two parts."""
    job = _job(spark, sf_dir)
    kind = job.requests.schema["timestamp"].dataType
    target.ensure_table(spark, job.table, kind, job.location)
    for first, last in ((FIRST, ONE_DAY), (ONE_DAY + dt.timedelta(days=1), LAST)):
        rows = hourly_impressions(job.requests, job.signage, first, last)
        target.append_rows(spark, job.table, with_business_date(rows))
    return _content(job)


@query("day_counts")
def day_counts(spark, sf_dir):
    job = _job(spark, sf_dir)
    job.run_range(FIRST, LAST)
    return _content(job).groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


@query("replace_days_in_parallel")
def replace_days_in_parallel(spark, sf_dir):
    """The days of the month, loaded each by itself from several threads."""
    job = _job(spark, sf_dir)
    target.ensure_table(spark, job.table, job.requests.schema["timestamp"].dataType, job.location)
    with ThreadPoolExecutor(4) as pool:
        logs = list(pool.map(job.run, target.days_between(FIRST, LAST)))
    if not all(row["success"] for log in logs for row in log.collect()):
        raise RuntimeError("A day failed")
    return _content(job)


@query("clear_then_append")
def clear_then_append(spark, sf_dir):
    """A day cleared by a load without requests, then its first half appended."""
    job = _job(spark, sf_dir)
    job.run_range(FIRST, LAST)
    requests, job.requests = job.requests, job.requests.where("false")
    job.run(ONE_DAY)
    half = hourly_impressions(requests, job.signage, ONE_DAY, end_hour=11)
    target.append_rows(spark, job.table, with_business_date(half))
    return _content(job)


@query("truncate_and_reload")
def truncate_and_reload(spark, sf_dir):
    """A full table emptied, then its first days loaded."""
    job = _job(spark, sf_dir)
    job.run_range(FIRST, LAST)
    target.truncate(spark, job.table)
    job.run_range(FIRST, ONE_DAY)
    return _content(job)


@query("run_default")
def run_default(spark, sf_dir):
    """The run without a date, at a given moment: it loads the Tokyo day before."""
    job = _job(spark, sf_dir)
    job.run(now=dt.datetime(2024, 1, 10, 15, 0, tzinfo=dt.timezone.utc))
    return _content(job)


def _failing(spark, sf_dir) -> ImpressionJob:
    """A job on a log in which the requests of one day cannot be read."""
    job = _job(spark, sf_dir)
    url = F.col("httpRequest.requestUrl")
    broken = times.business_date(_local("timestamp")) == F.lit(ONE_DAY)
    text = F.when(broken, F.raise_error(F.lit("unreadable")).cast("string")).otherwise(url)
    job.requests = job.requests.select("timestamp", F.struct(text.alias("requestUrl")).alias("httpRequest"))
    return job


@query("run_range_partial")
def run_range_partial(spark, sf_dir):
    """The run log of a range with a day that fails."""
    job = _failing(spark, sf_dir)
    log = job.run_range(FIRST, dt.date(2024, 1, 12))
    return _logged(job, log).withColumn("error", F.regexp_extract("error", "unreadable", 0))


@query("run_summary_partial")
def run_summary_partial(spark, sf_dir):
    job = _failing(spark, sf_dir)
    return _flat(run_summary(_logged(job, job.run_range(FIRST, dt.date(2024, 1, 12)))))


@query("run_log")
def run_log(spark, sf_dir):
    job = _job(spark, sf_dir)
    return _logged(job, job.run_range(FIRST, LAST))


def _flat(summary: DataFrame) -> DataFrame:
    days = F.col("failed_dates").cast("array<string>")
    return summary.withColumn("failed_dates", F.concat_ws(",", days))


@query("run_summary")
def run_summary_range(spark, sf_dir):
    job = _job(spark, sf_dir)
    return _flat(run_summary(_logged(job, job.run_range(FIRST, LAST))))


@query("run_summary_failures")
def run_summary_failures(spark, sf_dir):
    """Summary of a log in which days with more errors than signups count as failed."""
    days = testbed.read(spark, sf_dir, "events").select(
        times.business_date(_local()).alias("process_date"), "event_type"
    )
    log = days.groupBy("process_date").agg(
        (F.count_if(F.col("event_type") == "error") <= F.count_if(F.col("event_type") == "signup"))
        .alias("success"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return _flat(run_summary(log))


# --- versions of the target ---


def _versioned(spark, sf_dir) -> ImpressionJob:
    job = _job(spark, sf_dir)
    job.store = VersionedStore(spark, job.location, job.requests.schema["timestamp"].dataType)
    return job


@query("versioned_replace")
def versioned_replace(spark, sf_dir):
    """As replace_day_twice, each load a commit."""
    job = _versioned(spark, sf_dir)
    job.run_range(FIRST, LAST)
    job.run(ONE_DAY)
    job.reprocess(ONE_DAY.isoformat())
    return job.store.read()


@query("versioned_empty_day")
def versioned_empty_day(spark, sf_dir):
    """As empty_day_clear: the days that are filled and the one that is emptied change at once."""
    job = _versioned(spark, sf_dir)
    job.run_range(FIRST, LAST)
    gone = times.business_date(_local("timestamp")) == F.lit(ONE_DAY)
    job.requests = job.requests.where(~gone)
    job.run_range(ONE_DAY - dt.timedelta(days=1), ONE_DAY + dt.timedelta(days=1))
    return job.store.read()


@query("versioned_parallel")
def versioned_parallel(spark, sf_dir):
    """All days of the month from several threads, the first ten of them by three overlapping loads."""
    job = _versioned(spark, sf_dir)
    spans = [(FIRST, ONE_DAY)] * 3 + [(day, day) for day in target.days_between(ONE_DAY, LAST)]
    with ThreadPoolExecutor(6) as pool:
        logs = list(pool.map(lambda span: job.run_range(*span), spans))
    if not all(row["success"] for log in logs for row in log.collect()):
        raise RuntimeError("A day failed")
    return job.store.read()


@query("versioned_appends")
def versioned_appends(spark, sf_dir):
    """The month appended in two batches, each of them sent twice."""
    job = _versioned(spark, sf_dir)
    for first, last in ((FIRST, ONE_DAY), (ONE_DAY + dt.timedelta(days=1), LAST)) * 2:
        rows = with_business_date(hourly_impressions(job.requests, job.signage, first, last))
        job.store.append(rows, batch=f"{first}..{last}")
    return job.store.read()


@query("versioned_counts")
def versioned_counts(spark, sf_dir):
    """Rows per day as the commits of a load and an append of other requests say."""
    job = _versioned(spark, sf_dir)
    job.run_range(FIRST, ONE_DAY)
    later = hourly_impressions(job.requests, job.signage, ONE_DAY + dt.timedelta(days=1), LAST)
    job.store.append(with_business_date(later), batch="later")
    return job.store.rows_per_day()


# --- late requests ---

#: Requests of some days that reach the log after the others.
LATE = "dayofmonth(timestamp + INTERVAL 9 HOURS) % 4 = 1 AND second(timestamp) % 3 = 0"


def _in_two_arrivals(spark, sf_dir) -> tuple[ArrivalIndex, str, Callable[[], None]]:
    """An index that knows a log without its late requests, the log's folder, and what adds these to it."""
    source = scratch_path(spark, "log")
    log = testbed.request_log(spark, sf_dir)
    log.where(f"NOT ({LATE})").write.parquet(source)
    index = ArrivalIndex(spark, scratch_path(spark, "arrivals"))
    index.update(source, "parquet")
    return index, source, lambda: log.where(LATE).write.mode("append").parquet(source)


@query("late_days")
def late_days(spark, sf_dir):
    """The days that late requests touch, and their plays."""
    index, source, arrive = _in_two_arrivals(spark, sf_dir)
    arrive()
    return index.days({arrival.name for arrival in index.update(source, "parquet")})


@query("late_reload")
def late_reload(spark, sf_dir):
    """A month loaded before its late requests arrive, and then only the days that these touch."""
    index, source, arrive = _in_two_arrivals(spark, sf_dir)
    job = _versioned(spark, sf_dir)
    job.requests = readers.read_requests(spark, source, "parquet")
    job.run_range(FIRST, LAST)
    index.settle(index.pending())
    arrive()
    index.update(source, "parquet")
    job.requests = readers.read_requests(spark, source, "parquet")
    job.run_late(index)
    return job.store.read(FIRST, LAST)


# --- sources ---


@query("signage_csv")
def signage_csv(spark, sf_dir):
    """The signage table through a CSV sheet, hours filled in."""
    path = scratch_path(spark, "sheet")
    testbed.signage_table(spark, sf_dir).write.csv(path, header=True)
    return readers.read_signage_csv(spark, path).select(
        "fully_device_id",
        hours.hour_text(F.col("opening_time"), hours.DEFAULT_OPENING).alias("opening"),
        hours.hour_text(F.col("closing_time"), hours.DEFAULT_CLOSING).alias("closing"),
    )


@query("signage_import")
def signage_import(spark, sf_dir):
    """A sheet with its columns in another order, and further ones, copied to the catalog and read."""
    path = scratch_path(spark, "sheet")
    sheet = testbed.signage_table(spark, sf_dir).select(
        F.lit("a note").alias("memo"), "closing_time", "fully_device_id", F.lit("x").alias("owner"), "opening_time"
    )
    sheet.write.csv(path, header=True)
    name = _fresh("sheet")
    rows = readers.import_signage(spark, path, name).select(
        "fully_device_id",
        hours.hour_text(F.col("opening_time"), hours.DEFAULT_OPENING).alias("opening"),
        hours.hour_text(F.col("closing_time"), hours.DEFAULT_CLOSING).alias("closing"),
    )
    copy = scratch_path(spark, "copy")
    rows.write.parquet(copy)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(copy)


@query("named_params")
def named_params(spark, sf_dir):
    events = _fresh("events")
    testbed.read(spark, sf_dir, "events").createOrReplaceTempView(events)
    found = readers.run_sql(
        spark,
        f"""SELECT event_type, count(*) AS n, :value AS test_value, :text AS test_text
            FROM {events} WHERE value >= :value AND event_type <> :text GROUP BY event_type""",
        {"value": 42, "text": "view"},
    )
    spark.catalog.dropTempView(events)  # the query is analysed already
    return found
