"""Opening hours, kept as ``HH:MM`` text and compared as text.

Text order decides: an unpadded ``9:00`` sorts after ``10:00``, hours that run past midnight never
match, and ``24:00`` lies after every minute.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_OPENING = "09:00"
DEFAULT_CLOSING = "21:00"
MINUTES_PER_DAY = 24 * 60


def hour_text(value: Column, default: str) -> Column:
    """The stored text, or the default where it is NULL or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def in_business_hours(
    hm: Column,
    opening: Column,
    closing: Column,
    default_opening: str = DEFAULT_OPENING,
    default_closing: str = DEFAULT_CLOSING,
) -> Column:
    """``opening <= hm < closing``, as text."""
    return (hm >= hour_text(opening, default_opening)) & (hm < hour_text(closing, default_closing))


def minute_rank(text: Column) -> Column:
    """How many of the day's 1,440 ``HH:MM`` texts sort before ``text``.

    Since those texts sort like the minutes they name, ``hm >= text`` holds exactly for minutes
    ``>= rank`` and ``hm < text`` for minutes ``< rank``: the text comparison becomes an integer one
    for any text. Well-formed times take the direct way; odd ones are ranked by counting, first the
    hours that end before them, then the minutes of the next hour.
    """
    well_formed = (F.length(text) == 5) & text.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$")
    direct = F.substring(text, 1, 2).try_cast("int") * 60 + F.substring(text, 4, 2).try_cast("int")
    whole_hours = _count_below(_texts(range(59, MINUTES_PER_DAY, 60)), text)
    next_hour = F.slice(_texts(range(MINUTES_PER_DAY)), whole_hours * 60 + 1, 60)
    counted = whole_hours * 60 + _count_below(next_hour, text)
    return F.when(well_formed, direct).otherwise(counted)


def minute_text(minute: int) -> str:
    return f"{minute // 60:02}:{minute % 60:02}"


def _texts(minutes: range) -> Column:
    """Constant array of the texts of ``minutes``."""
    return F.split(F.lit(" ".join(map(minute_text, minutes))), " ")


def _count_below(texts: Column, text: Column) -> Column:
    return F.size(F.filter(texts, lambda candidate: candidate < text))


def text_rank(text: str) -> int:
    """``minute_rank`` of one known text."""
    return sum(minute_text(minute) < text for minute in range(MINUTES_PER_DAY))
