"""Business time: days, hours and minutes of UTC timestamps in a zone, which is Tokyo if left out.

Tokyo keeps one whole-hour offset all year, so local time is an addition and an hour bucket is the
same instant in both zones. Other zones are looked up: their days may have 23 or 25 hours, and their hours may
begin at any minute of UTC. An hour that a change of offset repeats is two buckets. Nothing here depends on
the session time zone, except where noted: instants are first turned into their UTC wall clock.
"""

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKYO = "Asia/Tokyo"
JST_HOURS = 9
JST = dt.timedelta(hours=JST_HOURS)

DAY_PATTERN = "[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}"


def utc_wall(ts: Column, ntz: bool) -> Column:
    """UTC wall clock without zone; zone-less input already is that."""
    if ntz:
        return ts
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.unix_micros(ts) * F.expr(
        "INTERVAL '0.000001' SECOND"
    )


# A time of day with something behind it: an offset or the name of a zone.
ZONED_PATTERN = r"^\s*[+-]?[0-9]{4,}-.*[T ][0-9]{1,2}(:[0-9:.]*)?\s*[^0-9:.\s]"


def instant_of(text: Column) -> Column:
    """The instant a text names, NULL if none; without offset or zone it is UTC, whatever the session's zone.

    ``text`` is used several times and should be a plain column.
    """
    zoneless = text.try_cast("timestamp_ntz").cast("string")
    utc = F.concat(zoneless, F.lit("+00:00")).try_cast("timestamp")
    return F.when(text.rlike(ZONED_PATTERN), text.try_cast("timestamp")).otherwise(utc)


def local_ts(ts: Column, ntz: bool, zone: str = TOKYO) -> Column:
    """Wall clock of the zone."""
    if zone == TOKYO:
        return utc_wall(ts, ntz) + F.expr(f"INTERVAL {JST_HOURS} HOURS")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall(ts, ntz))


def hour_bucket(ts: Column, ntz: bool, zone: str = TOKYO) -> Column:
    """Start of the local hour, in the flavour of the input; NULL of NULL."""
    if zone != TOKYO:
        local = local_ts(ts, ntz, zone)
        return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(local), F.extract(F.lit("SECOND"), local))
    if ntz:
        past = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))
        return ts - past
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(3_600_000_000)))


def business_date(local: Column) -> Column:
    return F.to_date(local)


def minute_of_day(local: Column) -> Column:
    return F.hour(local) * 60 + F.minute(local)


def hhmm(local: Column) -> Column:
    """``HH:MM`` text of a zone-less local time."""
    return F.substring(local.cast("string"), 12, 5)


def pad_hour(hour: Column) -> Column:
    text = hour.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(2)), F.lit("0"))


def _utc_literal(moment: dt.datetime, ntz: bool) -> Column:
    text = moment.strftime("%Y-%m-%d %H:%M:%S")
    return F.expr(f"TIMESTAMP_NTZ '{text}'" if ntz else f"TIMESTAMP '{text}+00:00'")


def day_window(
    ts: Column,
    ntz: bool,
    first: dt.date,
    last: dt.date,
    start_hour: int = 0,
    end_hour: int = 23,
    zone: str = TOKYO,
) -> Column:
    """Rows of the local days ``first``..``last``, each from ``start_hour`` to ``end_hour:59:59``.

    Both ends are inclusive at second precision, so a fraction past ``:59:59`` falls out of every
    day. The outer bounds sit on the bare column, where they reach the scan.
    """
    opens = _utc_of(dt.datetime.combine(first, dt.time(start_hour)), zone, min)
    closes = _utc_of(dt.datetime.combine(last, dt.time(end_hour, 59, 59)), zone, max)
    window = ts.between(_utc_literal(opens, ntz), _utc_literal(closes, ntz))
    if first < last or zone != TOKYO:
        local = local_ts(ts, ntz, zone)
        midnight = business_date(local).cast("timestamp_ntz")
        if zone != TOKYO:  # where a change of offset spoils the ends, the bounds are wide
            window &= business_date(local).between(first, last)
        window &= local.between(
            midnight + F.expr(f"INTERVAL {start_hour} HOURS"),
            midnight + F.expr(f"INTERVAL '{end_hour}:59:59' HOUR TO SECOND"),
        )
    return window


def _utc_of(local: dt.datetime, zone: str, of) -> dt.datetime:
    """The UTC wall clock at a local time; ``of`` (min or max) the two, where a change of offset makes it two or none."""
    if zone == TOKYO:
        return local - JST
    both = (local.replace(tzinfo=ZoneInfo(zone), fold=fold).astimezone(dt.timezone.utc) for fold in (0, 1))
    return of(both).replace(tzinfo=None)


def utc_dates(first: dt.date, last: dt.date, zone: str = TOKYO) -> tuple[dt.date, dt.date]:
    """UTC dates touched by the local days ``first``..``last``, for a log partitioned by date."""
    opens = _utc_of(dt.datetime.combine(first, dt.time.min), zone, min)
    closes = _utc_of(dt.datetime.combine(last, dt.time.max), zone, max)
    return opens.date(), closes.date()


def date_range(first: Column, last: Column) -> Column:
    """Array of the days from ``first`` to ``last``; empty when they are reversed."""
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )


def is_valid_date(text: Column) -> Column:
    """Strict ``YYYY-MM-DD`` naming a day that exists, from the year 1000; NULL is not one."""
    shaped = text.rlike(rf"^{DAY_PATTERN}\z")
    return F.coalesce(shaped & text.try_cast("date").isNotNull(), F.lit(False))


# Format tokens and their Spark pattern letters.
FORMAT_TOKENS = {"YYYY": "yyyy", "MM": "MM", "DD": "dd", "HH": "HH", "mm": "mm", "ss": "ss"}


def spark_pattern(fmt: str) -> str:
    """Spark datetime pattern of a token format. Only the first use of a token counts."""
    unused = dict(FORMAT_TOKENS)
    pattern, literal = "", ""
    for part in [*re.split("(" + "|".join(FORMAT_TOKENS) + ")", fmt), None]:
        letters = unused.pop(part, None)
        if part is not None and letters is None:
            literal += part
            continue
        if literal:
            pattern += "'" + literal.replace("'", "''") + "'"
            literal = ""
        pattern += letters or ""
    return pattern


def format_date(moment: Column, fmt: str) -> Column:
    """Format by ``YYYY MM DD HH mm ss`` tokens, in the session time zone."""
    return F.date_format(moment, spark_pattern(fmt))


def yesterday(now: Column, ntz: bool, zone: str = TOKYO) -> Column:
    """The local day before ``now``."""
    return F.date_sub(business_date(local_ts(now, ntz, zone)), 1)


def yesterday_in(zone: str, now: dt.datetime | None = None) -> dt.date:
    """The local day before ``now`` (an aware datetime; the present when left out)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(ZoneInfo(zone)).date() - dt.timedelta(days=1)


def yesterday_jst(now: dt.datetime | None = None) -> dt.date:
    """The Tokyo day before ``now`` (an aware datetime; the present when left out)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return (now.astimezone(dt.timezone.utc) + JST).date() - dt.timedelta(days=1)
