import datetime as dt
from urllib.parse import urlencode

from pyspark.sql import functions as F

from hourboard.schemas import SIGNAGE_SCHEMA

DAY = dt.date(2025, 3, 22)


def utc(text):
    """Aware UTC moment from ``YYYY-MM-DD HH:MM:SS[.ffffff]``."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def track(device="d1", path="/tracking", **params):
    """URL of a completed play; ``None`` leaves a parameter out."""
    values = {
        "event": "complete",
        "send_ts": "1",
        "networkId": "1",
        "device_id": device,
        "mediumId": "2",
        "storeId": "618",
        "programId": "90",
        "sequence": "11",
        "creativeId": "245",
        "deliveryId": "1314",
        **params,
    }
    kept = {key: value for key, value in values.items() if value is not None}
    return f"https://trk.example.com{path}?{urlencode(kept)}"


def requests_of(spark, rows, ntz=False):
    """Request log of (UTC text, url) rows."""
    frame = spark.createDataFrame(rows, "moment string, requestUrl string")
    moment = F.col("moment").cast("timestamp_ntz")
    if not ntz:
        moment = F.to_timestamp(F.concat("moment", F.lit("+00:00")))
    return frame.select(moment.alias("timestamp"), F.struct("requestUrl").alias("httpRequest"))


def signage_of(spark, *rows):
    return spark.createDataFrame(list(rows), SIGNAGE_SCHEMA)


def evaluate(spark, values, schema, *columns):
    """Rows of ``columns`` over one-column data ``values``."""
    frame = spark.createDataFrame([(value,) for value in values], schema)
    return [tuple(row) if len(columns) > 1 else row[0] for row in frame.select(*columns).collect()]
