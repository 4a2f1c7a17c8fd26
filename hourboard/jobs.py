"""Loading days: the daily run, a range of days, reprocessing; and the log of what happened."""

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.functions import times
from hourboard.plans.impressions import hourly_impressions, with_business_date
from hourboard.schemas import RUN_LOG_SCHEMA
from hourboard.sinks import target
from hourboard.sinks.versions import VersionedStore
from hourboard.sources import readers
from hourboard.sources.arrivals import ArrivalIndex


class ArgumentError(ValueError):
    """A job argument that is missing or wrong; raised before any Spark work. Its texts are fixed."""


# The texts of the argument errors below, and the date forms a run accepts besides ISO 8601.
LENIENT_FORMATS = ("%Y/%m/%d", "%m/%d/%Y", "%Y-%m-%d", "%Y-%m", "%Y")


def parse_date(value: str | dt.date | None) -> dt.date | None:
    """The UTC day a lenient date argument names, None if it names none."""
    if isinstance(value, dt.datetime):
        return value.astimezone(dt.timezone.utc).date() if value.tzinfo else value.date()
    if isinstance(value, dt.date) or not value:
        return value or None
    try:
        return parse_date(dt.datetime.fromisoformat(value))
    except ValueError:
        pass
    for fmt in LENIENT_FORMATS:
        try:
            return dt.datetime.strptime(value, fmt).date()
        except ValueError:
            continue
    return None


def strict_date(value: str) -> dt.date | None:
    """A day written exactly ``YYYY-MM-DD``, else None."""
    if not re.fullmatch(times.DAY_PATTERN, value):
        return None
    try:
        return dt.date.fromisoformat(value)
    except ValueError:
        return None


def run_date(
    value: str | dt.date | None = None, now: dt.datetime | None = None, zone: str = times.TOKYO
) -> dt.date:
    """Day of a daily run: the one given, else yesterday in the zone."""
    if not value and zone != times.TOKYO:
        return times.yesterday_in(zone, now)
    if not value:
        return times.yesterday_jst(now) if now else times.yesterday_jst()
    day = parse_date(value)
    if day is None:
        raise ArgumentError(f"Invalid date parameter: {value}")
    return day


def run_dates(
    start: str | dt.date | None, end: str | dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """First and last day of a range run; the last defaults to the first."""
    if not start:
        raise ArgumentError("Missing startDate parameter")
    end = end or start
    first, last = parse_date(start), parse_date(end)
    if first is None or last is None:
        raise ArgumentError(f"Invalid date parameters: startDate={start}, endDate={end}")
    if first > last:
        raise ArgumentError(f"Start date ({start}) is after end date ({end})")
    return first, last


def reprocess_date(value: str | None) -> dt.date:
    """Day to load again, which has to be spelled out."""
    if not value:
        raise ArgumentError("Missing date parameter")
    day = strict_date(value)
    if day is None:
        raise ArgumentError(f"Invalid date format: {value}. Expected format: YYYY-MM-DD")
    return day


@dataclass
class ImpressionJob:
    """Loads days of ``requests`` and ``signage`` into the table ``table``, or into ``store`` if there is one.

    Each method returns the run log of its days: ``process_date``, ``success``, ``row_count``,
    ``error``. A day that fails is logged, not raised. ``options`` go to ``hourly_impressions``.
    """

    spark: SparkSession
    requests: DataFrame
    signage: DataFrame
    table: str
    location: str | None = None
    options: dict[str, Any] = field(default_factory=dict)
    store: VersionedStore | None = None
    #: First day, last day and error of each range that failed as a whole.
    range_errors: list[tuple[dt.date, dt.date, str]] = field(default_factory=list)

    def run(self, date: str | dt.date | None = None, now: dt.datetime | None = None) -> DataFrame:
        """The day given, else the local day before ``now``, which is the present if left out."""
        day = run_date(date, now, self._zone)
        return self._log(self._load_span(day, day))

    def reprocess(self, date: str | None) -> DataFrame:
        day = reprocess_date(date)
        return self._log(self._load_span(day, day))

    def run_range(
        self, start: str | dt.date | None, end: str | dt.date | None = None
    ) -> DataFrame:
        """All days in one pass over the log; a range that fails is halved, down to single days.

        What cannot be analysed fails for all days at once, without a second try, and so does a text log with
        a broken record, which every day would read again; unless it is partitioned by ``log_date``.
        """
        return self._log(self._load_span(*run_dates(start, end)))

    def run_days(self, days: Iterable[dt.date]) -> DataFrame:
        """Some days, each run of consecutive ones in one pass."""
        spans: list[tuple[dt.date, dt.date]] = []
        for day in sorted(set(days)):
            follows = spans and spans[-1][1] + dt.timedelta(days=1) == day
            spans[-1:] = [(spans[-1][0], day)] if follows else [*spans[-1:], (day, day)]
        return self._log([entry for span in spans for entry in self._load_span(*span)])

    def run_late(self, index: ArrivalIndex) -> DataFrame:
        """The days of the index' pending arrivals. What is loaded without failure settles them, else all stay pending."""
        names = index.pending()
        entries = self.run_days(row["dt"] for row in index.days(names).collect())  # one row a day
        if entries.where("not success").isEmpty():
            index.settle(names)
        return entries

    @property
    def _zone(self) -> str:
        return self.options.get("zone", times.TOKYO)

    def _load_span(self, first: dt.date, last: dt.date) -> list[tuple]:
        try:
            return [(day, True, rows, None) for day, rows in self._load(first, last).items()]
        except Exception as error:
            message, days = _message(error), target.days_between(first, last)
            if len(days) > 1:
                self.range_errors.append((first, last, message))
            broken = readers.MALFORMED in message and not self.options.get("log_date")
            if len(days) == 1 or broken or isinstance(error, AnalysisException):
                return [(day, False, None, message) for day in days]
            middle = days[(len(days) - 1) // 2]
            return self._load_span(first, middle) + self._load_span(middle + dt.timedelta(days=1), last)

    def _load(self, first: dt.date, last: dt.date) -> dict[dt.date, int]:
        kind = self.requests.schema["timestamp"].dataType
        if not self.store:
            target.ensure_table(self.spark, self.table, kind, self.location)
        rows = hourly_impressions(self.requests, self.signage, first, last, **self.options)
        rows = with_business_date(rows, self._zone)
        if self.store:
            return self.store.replace_days(rows, first, last)
        return target.replace_days(self.spark, self.table, rows, first, last)

    def _log(self, entries: list[tuple]) -> DataFrame:
        return self.spark.createDataFrame(entries, RUN_LOG_SCHEMA)


def _message(error: Exception) -> str:
    text = error.getMessage() if isinstance(error, PySparkException) else None
    return text or str(error) or type(error).__name__


def run_summary(log: DataFrame) -> DataFrame:
    """One row over a run log; ``failed_dates`` is NULL when every day succeeded."""
    failed = F.collect_list(F.when(~F.col("success"), F.col("process_date")))
    return log.agg(
        F.bool_and("success").alias("success"),
        F.min("process_date").alias("start_date"),
        F.max("process_date").alias("end_date"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("row_count"))), F.lit(0)).alias(
            "total_row_count"
        ),
        F.sort_array(failed).alias("failed"),
    ).select(
        "success",
        "start_date",
        "end_date",
        "total_row_count",
        F.when(F.size("failed") > 0, F.col("failed")).alias("failed_dates"),
    )
