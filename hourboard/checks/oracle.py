"""The registered queries as SQL that DuckDB runs on the same tables."""

from hourboard.checks import testbed
from hourboard.checks.queries import FORMATS, PARAMS

# The parameters that are numbers.
NUMBERS = ("mediumId", "storeId", "programId", "sequence", "creativeId", "deliveryId")
KEYS = (
    "timestamp_hourly, mediumId, storeId, device_id, programId, sequence, creativeId, deliveryId"
)


def _param(key: str, url: str = "url") -> str:
    return (
        f"CASE WHEN regexp_matches({url}, '[?&]{key}=') "
        f"THEN regexp_extract({url}, '[?&]{key}=([^&#]*)', 1) END"
    )


def _log(url: str) -> str:
    text = url.format(S="varchar")
    return f"req AS (SELECT ts, ts + INTERVAL 9 HOUR AS jst, {text} AS url FROM events)"


def _lines() -> str:
    line, url = (text.format(S="varchar") for text in (testbed.JSON_LINE, testbed.BUSY_URL))
    return f"""SELECT event_id, {line} AS record FROM (SELECT *, {url} AS url FROM events)
        WHERE {testbed.BROKEN_RULE}"""


def _signage(text: str) -> str:
    return f"signage AS ({text.format(S='varchar', supplier='supplier', customer='customer')})"


ACCEPTED = _log(testbed.BUSY_URL)[:-1] + f" WHERE NOT {testbed.BROKEN_RULE})"
BUSY, WIDE = _log(testbed.BUSY_URL), _log(testbed.WIDE_URL)
ONCE, AGAIN = _signage(testbed.SUPPLIER_SIGNAGE), _signage(testbed.LISTED_AGAIN)

IS_TRACKING = f"""regexp_extract(url, '//[^/]+([^?#]+)', 1) = '/tracking'
    AND {_param("event")} = 'complete' AND {_param("send_ts")} <> ''
    AND {_param("networkId")} = '1'"""


def _in_hours(opening: str = "09:00", closing: str = "21:00") -> str:
    return (
        f"hm >= COALESCE(NULLIF(opening_time, ''), '{opening}') "
        f"AND hm < COALESCE(NULLIF(closing_time, ''), '{closing}')"
    )


def _within(clock: str, first: str, last: str, start: int, end: int) -> str:
    return (
        f"{clock} BETWEEN TIMESTAMP '{first} {start:02}:00:00' "
        f"AND TIMESTAMP '{last} {end:02}:59:59' AND CAST({clock} AS TIME) "
        f"BETWEEN TIME '{start:02}:00:00' AND TIME '{end:02}:59:59'"
    )


def _groups(
    log: str,
    signage: str,
    first: str = "2024-01-01",
    last: str = "2024-01-31",
    start: int = 0,
    end: int = 23,
    opening: str = "09:00",
    closing: str = "21:00",
    hour: str = "date_trunc('hour', ts)",
) -> str:
    """CTEs up to ``grp``: every group with both measures."""
    numbers = ", ".join(
        f"TRY_CAST({_param(key)} AS BIGINT) AS {key}" for key in NUMBERS
    )
    return f"""WITH {log}, {signage},
      plays AS (
        SELECT {hour} AS timestamp_hourly, {numbers},
          {_param("device_id")} AS device_id, strftime(jst, '%H:%M') AS hm
        FROM req WHERE {IS_TRACKING} AND {_within("jst", first, last, start, end)}),
      grp AS (
        SELECT {KEYS},
          CAST(sum(CASE WHEN {_in_hours(opening, closing)} THEN 1 ELSE 0 END) AS BIGINT) AS imp,
          count(*) AS cnt
        FROM plays LEFT JOIN signage ON device_id = fully_device_id
        GROUP BY {KEYS})
    """


def _zoned(days: int, change: str, before: str, after: str) -> str:
    """The busy log moved by some days, local time by the offsets before and after a change."""
    log = _log(testbed.BUSY_URL).replace("FROM events", f"FROM (SELECT * REPLACE (ts + INTERVAL {days} DAY AS ts) FROM events)")
    local = f"ts + CASE WHEN ts < TIMESTAMP '{change}' THEN INTERVAL '{before}' ELSE INTERVAL '{after}' END"
    return log.replace("ts + INTERVAL 9 HOUR", local)


NEW_YORK = _zoned(60, "2024-03-10 07:00:00", "-5 hours", "-4 hours")
ADELAIDE = _zoned(80, "2024-04-06 16:30:00", "10 hours 30 minutes", "9 hours 30 minutes")


def _impressions(*args, **kwargs) -> str:
    return _groups(*args, **kwargs) + f"SELECT {KEYS}, imp, cnt FROM grp WHERE imp > 0"


DT = "CAST(timestamp_hourly + INTERVAL 9 HOUR AS DATE)"
TARGET = _groups(BUSY, ONCE) + f"SELECT {KEYS}, imp, cnt, {DT} AS dt FROM grp WHERE imp > 0"
JST_DAY = "CAST(ts + INTERVAL 9 HOUR AS DATE)"
STRFTIME = {"YYYY": "%Y", "MM": "%m", "DD": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}


def _strftime(fmt: str) -> str:
    for token, directive in STRFTIME.items():
        fmt = fmt.replace(token, directive)
    return fmt


ORACLE: dict[str, str] = {
    "hourly_impressions": _impressions(BUSY, ONCE),
    "hourly_impressions_day": _impressions(BUSY, ONCE, "2024-01-10", "2024-01-10"),
    "hourly_impressions_hours": _impressions(
        BUSY, ONCE, start=8, end=19, opening="10:00", closing="18:30"
    ),
    "hourly_impressions_instants": _impressions(BUSY, ONCE),
    "hourly_impressions_new_york": _impressions(NEW_YORK, ONCE, "2024-03-05", "2024-03-20"),
    "hourly_impressions_adelaide": _groups(
        ADELAIDE, ONCE, "2024-04-01", "2024-04-15", hour="ts - (jst - date_trunc('hour', jst))"
    )
    + f"""SELECT {KEYS}, imp, cnt, CAST(timestamp_hourly + CASE WHEN timestamp_hourly < TIMESTAMP '2024-04-06 16:30:00'
        THEN INTERVAL '10 hours 30 minutes' ELSE INTERVAL '9 hours 30 minutes' END AS DATE) AS dt
        FROM grp WHERE imp > 0""",
    "stored_log_impressions": _impressions(BUSY, ONCE),
    "stored_log_accepted": _impressions(ACCEPTED, ONCE),
    "stored_log_rejects": f"""SELECT CASE WHEN event_id%97=5 OR event_id%89=7 THEN 'not a record'
          ELSE 'timestamp that is none' END AS reason, record FROM ({_lines()})""",
    "text_log_times": """SELECT event_id,
          CASE WHEN event_id%7=3 THEN date_trunc('day', ts) ELSE ts END AS moment FROM events""",
    "hourly_impressions_devices": _impressions(WIDE, ONCE),
    "hourly_impressions_shuffled": _impressions(WIDE, ONCE),
    "signage_fanout": _impressions(WIDE, AGAIN),
    "signage_fanout_shuffled": _impressions(WIDE, AGAIN),
    "url_params": f"""WITH {WIDE}
        SELECT ts AS timestamp, {", ".join(f"{_param(key)} AS {key}" for key in PARAMS)}
        FROM req""",
    "url_path_pages": """SELECT page_id,
        NULLIF(regexp_extract(url, '//[^/]+([^?#]+)', 1), '') AS path FROM pages""",
    "page_params": f"""SELECT page_id, {", ".join(
        f"url_decode({_param(key)}) AS {key}" for key in ("page", "ref", "utm_source"))}
        FROM pages""",
    "tracking_filter": f"WITH {BUSY} SELECT ts AS timestamp, url FROM req WHERE {IS_TRACKING}",
    "safe_cast": """WITH texts AS (
          SELECT regexp_extract(url, '/([^/?#]*)/?([?#].*)?$', 1) AS text FROM pages
          UNION ALL
          SELECT CASE event_type WHEN 'view' THEN '+' || CAST(event_id AS varchar)
               WHEN 'click' THEN CAST(event_id AS varchar) || '000000000000000'
               WHEN 'signup' THEN '-' || CAST(event_id AS varchar)
               WHEN 'error' THEN CAST(event_id AS varchar) || 'x'
               ELSE CAST(event_id AS varchar) END
          FROM events)
        SELECT text, TRY_CAST(text AS BIGINT) AS number FROM texts""",
    "day_window": f"""SELECT event_id, ts FROM events
        WHERE {_within("(ts + INTERVAL 9 HOUR)", "2024-01-01", "2024-01-31", 8, 19)}""",
    "hour_bucket": "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1",
    "hour_buckets_pair": """SELECT event_id, date_trunc('hour', ts) AS hour,
        CASE WHEN event_type <> 'view' THEN date_trunc('hour', ts + INTERVAL 9 HOUR) END
          AS local_hour FROM events""",
    "local_hhmm": """SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%H:%M') AS hm,
        CAST(hour(ts + INTERVAL 9 HOUR) * 60 + minute(ts) AS INTEGER) AS minute,
        strftime(ts + INTERVAL 9 HOUR, '%H') AS hh FROM events""",
    "business_date_counts": f"""SELECT {JST_DAY} AS business_date, CAST(ts AS DATE) AS utc_date,
        count(*) AS n FROM events GROUP BY 1, 2""",
    "yesterday_local": f"SELECT event_id, CAST({JST_DAY} - 1 AS DATE) AS yesterday FROM events",
    "date_range": f"""WITH spans AS (
          SELECT user_id, min(CASE WHEN event_type = 'purchase' THEN {JST_DAY} END) AS first,
            max(CASE WHEN event_type = 'signup' THEN {JST_DAY} END) AS last
          FROM events GROUP BY user_id),
        days AS (
          SELECT user_id, unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP),
            INTERVAL 1 DAY)) AS day
          FROM spans WHERE first <= last)
        SELECT user_id, CAST(day AS DATE) AS day FROM days""",
    "date_format_tokens": f"""SELECT event_id, {", ".join(
        f"strftime(ts, '{_strftime(fmt)}') AS {name}" for name, fmt in FORMATS.items())}
        FROM events""",
    "valid_dates": """WITH texts AS (
          SELECT o_orderkey, CAST(1995 + o_orderkey % 10 AS varchar)
               || CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '-' END
               || CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_custkey % 14 AS varchar)
                  ELSE lpad(CAST(o_custkey % 14 AS varchar), 2, '0') END
               || '-' || lpad(CAST(o_orderkey % 33 AS varchar), 2, '0') AS text
          FROM orders)
        SELECT o_orderkey, text, regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
          AND TRY_CAST(text AS DATE) IS NOT NULL AS valid FROM texts""",
    "business_hours_flag": f"""WITH {ONCE}, ev AS (
          SELECT event_id, 'dev-' || CAST(user_id AS varchar) AS device_id,
            strftime(ts + INTERVAL 9 HOUR, '%H:%M') AS hm FROM events)
        SELECT event_id, {_in_hours()} AS in_hours
        FROM ev LEFT JOIN signage ON device_id = fully_device_id""",
    "signage_hours": f"""WITH {AGAIN}, filled AS (
          SELECT fully_device_id, COALESCE(NULLIF(opening_time, ''), '09:00') AS opening,
            COALESCE(NULLIF(closing_time, ''), '21:00') AS closing FROM signage),
        minutes AS (
          SELECT strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * range, '%H:%M') AS hm
          FROM range(1440)),
        ranks AS (
          SELECT text, CAST(count(hm) AS INTEGER) AS n
          FROM (SELECT opening AS text FROM filled UNION SELECT closing FROM filled)
          LEFT JOIN minutes ON hm < text GROUP BY text)
        SELECT fully_device_id, opening, closing, o.n AS opens, c.n AS closes
        FROM filled JOIN ranks o ON opening = o.text JOIN ranks c ON closing = c.text""",
    "signage_left_join": f"""WITH {WIDE}, {AGAIN}, plays AS (
          SELECT TRY_CAST({_param("send_ts")} AS BIGINT) AS event_id,
            {_param("device_id")} AS device_id, strftime(jst, '%H:%M') AS hm FROM req)
        SELECT event_id, device_id, count(*) AS joined_rows,
          CAST(sum(CASE WHEN {_in_hours()} THEN 1 ELSE 0 END) AS BIGINT) AS open_rows
        FROM plays LEFT JOIN signage ON device_id = fully_device_id
        GROUP BY event_id, device_id""",
    "conditional_sum_count": _groups(WIDE, ONCE) + f"SELECT {KEYS}, imp, cnt FROM grp",
    "having_positive": _groups(WIDE, ONCE)
    + f"""SELECT {DT} AS dt, count(*) AS kept, CAST(sum(imp) AS BIGINT) AS imp,
        CAST(sum(cnt) AS BIGINT) AS cnt FROM grp WHERE imp > 0 GROUP BY 1""",
    "replace_day_twice": TARGET,
    "replace_range_backward": TARGET,
    "empty_day_clear": TARGET + f" AND {DT} <> DATE '2024-01-10'",
    "append_rows": TARGET,
    "replace_days_in_parallel": TARGET,
    "late_days": f"""WITH {BUSY} SELECT CAST(jst AS DATE) AS dt, count(*) AS plays FROM req
        WHERE {IS_TRACKING} AND day(jst) % 4 = 1 AND second(ts) % 3 = 0
          AND CAST(jst AS TIME) <= TIME '23:59:59' GROUP BY 1""",
    "late_reload": TARGET,
    "versioned_replace": TARGET,
    "versioned_empty_day": TARGET + f" AND {DT} <> DATE '2024-01-10'",
    "versioned_parallel": TARGET,
    "versioned_appends": TARGET,
    "versioned_counts": _groups(BUSY, ONCE)
    + f"SELECT {DT} AS dt, count(*) AS row_count FROM grp WHERE imp > 0 GROUP BY 1",
    "clear_then_append": TARGET
    + f" AND ({DT} <> DATE '2024-01-10' OR hour(timestamp_hourly + INTERVAL 9 HOUR) < 12)",
    "truncate_and_reload": TARGET + f" AND {DT} <= DATE '2024-01-10'",
    "run_default": TARGET + f" AND {DT} = DATE '2024-01-10'",
    "run_range_partial": _groups(BUSY, ONCE)
    + f"""SELECT CAST(day AS DATE) AS process_date, day <> DATE '2024-01-10' AS success,
        CASE WHEN day <> DATE '2024-01-10' THEN count(timestamp_hourly) END AS row_count,
        CASE WHEN day = DATE '2024-01-10' THEN 'unreadable' END AS error
        FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-12', INTERVAL 1 DAY) d(day)
        LEFT JOIN grp ON {DT} = CAST(day AS DATE) AND imp > 0 GROUP BY day""",
    "run_summary_partial": _groups(BUSY, ONCE)
    + f"""SELECT FALSE AS success, DATE '2024-01-01' AS start_date, DATE '2024-01-12' AS end_date,
        count(*) AS total_row_count, '2024-01-10' AS failed_dates FROM grp
        WHERE imp > 0 AND {DT} <= DATE '2024-01-12' AND {DT} <> DATE '2024-01-10'""",
    "day_counts": _groups(BUSY, ONCE)
    + f"SELECT {DT} AS dt, count(*) AS row_count FROM grp WHERE imp > 0 GROUP BY 1",
    "run_log": _groups(BUSY, ONCE)
    + f"""SELECT CAST(day AS DATE) AS process_date, TRUE AS success,
        count(timestamp_hourly) AS row_count, CAST(NULL AS varchar) AS error
        FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) d(day)
        LEFT JOIN grp ON {DT} = CAST(day AS DATE) AND imp > 0 GROUP BY 1""",
    "run_summary": _groups(BUSY, ONCE)
    + """SELECT TRUE AS success, DATE '2024-01-01' AS start_date, DATE '2024-01-31' AS end_date,
        count(*) AS total_row_count, '' AS failed_dates FROM grp WHERE imp > 0""",
    "run_summary_failures": f"""WITH log AS (
          SELECT {JST_DAY} AS process_date, count(*) AS row_count,
            count(*) FILTER (event_type = 'error') <= count(*) FILTER (event_type = 'signup')
              AS success
          FROM events GROUP BY 1)
        SELECT bool_and(success) AS success, min(process_date) AS start_date,
          max(process_date) AS end_date,
          CAST(COALESCE(sum(CASE WHEN success THEN row_count END), 0) AS BIGINT)
            AS total_row_count,
          COALESCE(string_agg(CASE WHEN NOT success THEN CAST(process_date AS varchar) END, ','
            ORDER BY process_date), '') AS failed_dates
        FROM log""",
    "signage_import": f"""WITH {ONCE} SELECT fully_device_id,
          COALESCE(NULLIF(opening_time, ''), '09:00') AS opening,
          COALESCE(NULLIF(closing_time, ''), '21:00') AS closing FROM signage""",
    "signage_csv": f"""WITH {ONCE} SELECT fully_device_id,
          COALESCE(NULLIF(opening_time, ''), '09:00') AS opening,
          COALESCE(NULLIF(closing_time, ''), '21:00') AS closing FROM signage""",
    "named_params": """SELECT event_type, count(*) AS n, 42 AS test_value, 'view' AS test_text
        FROM events WHERE value >= 42 AND event_type <> 'view' GROUP BY event_type""",
}
