"""Request logs and signage tables derived from the driver's tables.

Each has one SQL text for both engines; ``{S}`` stands for the text type, and signage texts name
their tables in braces.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Four devices share all requests, so each is a hot key. Covers wrong path, event and network,
# empty send time, missing device and a medium that is no number.
BUSY_URL = """
    'https://trk.example.com' || CASE WHEN event_type='error' THEN '/health' ELSE '/tracking' END
    || '?event='     || CASE WHEN event_type='signup' THEN 'start' ELSE 'complete' END
    || '&networkId=' || CASE WHEN event_id%10=0 THEN '2' ELSE '1' END
    || '&send_ts='   || CASE WHEN event_id%20=3 THEN '' ELSE CAST(event_id AS {S}) END
    || CASE WHEN event_id%17=0 THEN '' ELSE '&device_id=dev-' || CAST(user_id%4 AS {S}) END
    || '&mediumId='  || CASE WHEN event_id%50=1 THEN 'x' ELSE CAST(user_id%2 AS {S}) END
    || '&storeId='   || CAST(user_id%4 AS {S}) || '&programId='  || CAST(user_id%2 AS {S})
    || '&sequence='  || CAST(user_id%2 AS {S}) || '&creativeId=' || CAST(user_id%4 AS {S})
    || '&deliveryId='|| CAST(user_id%2 AS {S})"""

# One device per user, many of them in no signage table; empty devices; longer and nested paths.
WIDE_URL = """
    'https://trk.example.com'
    || CASE event_type WHEN 'error' THEN '/tracking/' WHEN 'signup' THEN '/v1/tracking'
       ELSE '/tracking' END
    || '?device_id='  || CASE WHEN value < 3 THEN '' ELSE 'dev-' || CAST(user_id AS {S}) END
    || '&event=complete&networkId=' || CASE WHEN value > 60 THEN '10' ELSE '1' END
    || '&send_ts='    || CAST(event_id AS {S}) || '&mediumId='   || CAST(user_id%7 AS {S})
    || '&storeId='    || CAST(user_id AS {S})  || '&programId='  || CAST(event_id%3 AS {S})
    || CASE WHEN value < 10 THEN '' ELSE '&sequence=' || CAST(event_id%5 AS {S}) END
    || '&creativeId=' || CAST(user_id%11 AS {S}) || '&deliveryId=' || CAST(user_id AS {S})
    || '#' || event_type"""

# The same moment with and without an offset or zone; some are days only.
TIME_TEXT = """
    CASE event_id%7
      WHEN 0 THEN CAST(ts AS {S}) || 'Z'
      WHEN 1 THEN CAST(ts + INTERVAL 9 HOUR AS {S}) || '+09:00'
      WHEN 2 THEN CAST(ts + INTERVAL 9 HOUR AS {S}) || ' Asia/Tokyo'
      WHEN 3 THEN CAST(CAST(ts AS DATE) AS {S})
      ELSE CAST(ts AS {S}) END"""

# A line of a JSON log, for requests with a column ``url``; cut, of another format, or with a time that is none.
BROKEN_RULE = "(event_id%97=5 OR event_id%89=7 OR event_id%83=11)"
JSON_LINE = """
    CASE WHEN event_id%97=5 THEN '{{"timestamp": "2024-01-1' || CAST(event_id AS {S})
      WHEN event_id%89=7 THEN 'GET /tracking?event=complete&send_ts=' || CAST(event_id AS {S})
      ELSE '{{"severity": "INFO", "timestamp": "' || CASE WHEN event_id%83=11 THEN 'yesterday'
        WHEN event_id%2=0 THEN CAST(ts AS {S}) ELSE CAST(ts + INTERVAL 9 HOUR AS {S}) || '+09:00' END
        || '", "httpRequest": {{"requestUrl": "' || url || '", "status": 200}}}}' END"""

SUPPLIER_SIGNAGE = """
    SELECT 'dev-' || CAST(s_suppkey AS {S}) AS fully_device_id,
      CASE s_suppkey%4 WHEN 0 THEN '' WHEN 1 THEN '08:30' WHEN 2 THEN NULL ELSE '10:15' END
        AS opening_time,
      CASE s_suppkey%4 WHEN 0 THEN '22:00' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '20:45' END
        AS closing_time
    FROM {supplier}"""

# Lists suppliers' devices again with other hours, among them odd and never-open ones.
LISTED_AGAIN = (
    SUPPLIER_SIGNAGE
    + """
    UNION ALL
    SELECT 'dev-' || CAST(c_custkey AS {S}) AS fully_device_id,
      CASE c_nationkey%5 WHEN 0 THEN '9:00' WHEN 1 THEN '18:00' WHEN 2 THEN '' WHEN 3 THEN '00:00'
        ELSE '12:00' END AS opening_time,
      CASE c_nationkey%5 WHEN 0 THEN '21:00' WHEN 1 THEN '02:00' WHEN 2 THEN '19:30'
        WHEN 3 THEN '24:00' ELSE '12:01' END AS closing_time
    FROM {customer}
    UNION ALL
    SELECT 'dev-' || CAST(c_nationkey AS {S}) AS fully_device_id, '11:00' AS opening_time,
      '14:00' AS closing_time
    FROM {customer}"""
)


# Columns used of each table; declared, so that no job has to look them up.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "supplier": "s_suppkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "pages": "page_id bigint, url string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def request_log(spark: SparkSession, sf_dir: str, url: str = BUSY_URL) -> DataFrame:
    """Events as a request log.

    A stored log has its URL at hand. To match that, the URL is built once per row, as the only
    element of an array that is unnested: a plain column would be built again in every filter term
    that Catalyst moves below it.
    """
    text = F.expr(url.format(S="string")).alias("requestUrl")
    return (
        read(spark, sf_dir, "events")
        .select(F.col("ts").alias("timestamp"), F.inline(F.array(F.struct(text))))
        .select("timestamp", F.struct("requestUrl").alias("httpRequest"))
    )


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the lines (``value``) of a JSON log with broken ones among them."""
    events = read(spark, sf_dir, "events")
    with_url = events.select("*", F.inline(F.array(F.struct(F.expr(BUSY_URL.format(S="string")).alias("url")))))
    return with_url.select(F.expr(JSON_LINE.format(S="string")).alias("value"))


def request_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a CSV log with times of several forms, and more columns than needed."""
    events = read(spark, sf_dir, "events")
    url, time = F.expr(WIDE_URL.format(S="string")), F.expr(TIME_TEXT.format(S="string"))
    return events.select(F.lit(200).alias("status"), url.alias("requestUrl"), "event_id", time.alias("timestamp"))


def signage_table(spark: SparkSession, sf_dir: str, text: str = SUPPLIER_SIGNAGE) -> DataFrame:
    tables = {name: read(spark, sf_dir, name) for name in ("supplier", "customer")}
    return spark.sql(text.replace("{S}", "string"), **tables)
