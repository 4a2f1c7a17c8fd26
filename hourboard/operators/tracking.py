"""From the request log to one narrow row per completed play."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourboard.functions import times, urls
from hourboard.schemas import INT_PARAMS, KEYS, is_ntz


def request_url() -> Column:
    return F.col("httpRequest.requestUrl")


def is_tracking_url(url: Column) -> Column:
    """A completed play on network 1, reported to ``/tracking`` with a send time."""
    return (
        urls.path_equals(url, "/tracking")
        & urls.param_equals(url, "event", "complete")
        & urls.param_equals(url, "networkId", "1")
        & (urls.param_text(url, "send_ts") != "")
    )


def filter_tracking(
    requests: DataFrame,
    first: dt.date,
    last: dt.date,
    start_hour: int = 0,
    end_hour: int = 23,
    log_date: str | None = None,
    zone: str = times.TOKYO,
) -> DataFrame:
    """Completed plays of the local days ``first``..``last``.

    ``log_date`` names the UTC date column the log is partitioned by, if it has one, so that only
    the partitions those days touch are listed.
    """
    window = times.day_window(
        F.col("timestamp"), is_ntz(requests, "timestamp"), first, last, start_hour, end_hour, zone
    )
    if log_date:
        requests = requests.where(F.col(log_date).between(*times.utc_dates(first, last, zone)))
    return requests.where(window & is_tracking_url(request_url()))


def play_keys(plays: DataFrame, zone: str = times.TOKYO) -> DataFrame:
    """The eight group keys of each play and its local minute of day."""
    ts, url = F.col("timestamp"), request_url()
    ntz = is_ntz(plays, "timestamp")
    local = times.local_ts(ts, ntz, zone)
    texts = plays.select(
        times.hour_bucket(ts, ntz, zone).alias("timestamp_hourly"),
        times.minute_of_day(local).alias("minute"),
        urls.query_param(url, "device_id").alias("device_id"),
        *[urls.param_text(url, name).alias(name) for name in INT_PARAMS],
    )
    numbers = {name: urls.safe_int(F.col(name)).alias(name) for name in INT_PARAMS}
    return texts.select(*[numbers.get(name, F.col(name)) for name in KEYS], "minute")
