"""The impression query."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourboard.functions import hours, times
from hourboard.operators import counts, signage, tracking
from hourboard.schemas import TARGET_COLUMNS, is_ntz


def hourly_impressions(
    requests: DataFrame,
    signage_table: DataFrame,
    first: dt.date,
    last: dt.date | None = None,
    start_hour: int = 0,
    end_hour: int = 23,
    default_opening: str = hours.DEFAULT_OPENING,
    default_closing: str = hours.DEFAULT_CLOSING,
    log_date: str | None = None,
    broadcast_limit_bytes: int = signage.BROADCAST_LIMIT_BYTES,
    zone: str = times.TOKYO,
) -> DataFrame:
    """Hourly impressions and completions of the days ``first``..``last`` of the zone.

    Each day is cut to ``start_hour``..``end_hour``, so a range gives what its days give one by
    one. While the folded signage table is measured to fit ``broadcast_limit_bytes`` it is
    broadcast, and the log is shuffled once, already partly counted. Beyond that, plays are counted
    per minute before they are shuffled to their device's hours.
    """
    plays = tracking.play_keys(
        tracking.filter_tracking(requests, first, last or first, start_hour, end_hour, log_date, zone), zone
    )
    devices = signage.device_hours(signage_table, default_opening, default_closing)
    fits = devices.size_bytes <= broadcast_limit_bytes
    joined = signage.join_hours(
        plays if fits else counts.count_by_minute(plays), devices, broadcast=fits
    )
    return counts.with_impressions(counts.count_groups(joined, devices))


def with_business_date(impressions: DataFrame, zone: str = times.TOKYO) -> DataFrame:
    """Target rows: the result with its local day ``dt``, in table order."""
    hour = times.local_ts(F.col("timestamp_hourly"), is_ntz(impressions, "timestamp_hourly"), zone)
    return impressions.withColumn("dt", times.business_date(hour)).select(*TARGET_COLUMNS)
