"""Reading query parameters and paths out of raw request URLs.

Logged URLs are often malformed, so nothing here parses them strictly: a parameter is whatever
follows the first ``?key=`` or ``&key=``, up to the next ``&`` or ``#``, undecoded.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what the path of a URL is.
PATH_PATTERN = r"//[^/]+([^?#]+)"


def _marker(key: str) -> str:
    """Pattern of ``?key=`` or ``&key=``, from the key on.

    The regex engine searches fast for a pattern that begins with plain text, so what comes before
    the key is checked by looking back from behind it.
    """
    text = re.escape(key) + "="
    return f"{text}(?<=[?&]{text})"


def param_text(url: Column, key: str) -> Column:
    """First value of ``key``; ``''`` both when it is empty and when it is missing."""
    return F.regexp_extract(url, _marker(key) + "([^&#]*)", 1)


def query_param(url: Column, key: str, decode: bool = False) -> Column:
    """First value of ``key``: ``''`` when empty, NULL when missing.

    Telling the two apart needs a second match, made only where the value came out empty.
    ``decode`` resolves percent escapes; a broken escape gives NULL.
    """
    value = F.coalesce(
        F.nullif(param_text(url, key), F.lit("")),
        F.when(url.rlike(_marker(key)), F.lit("")),
    )
    return F.try_url_decode(value) if decode else value


def param_equals(url: Column, key: str, value: str) -> Column:
    """``key`` has exactly ``value``; a plain substring test turns most other URLs away first."""
    return F.contains(url, F.lit(f"{key}={value}")) & (param_text(url, key) == value)


def path_equals(url: Column, path: str) -> Column:
    """The path is exactly ``path``, with the same cheap test in front."""
    return F.contains(url, F.lit(path)) & (F.regexp_extract(url, PATH_PATTERN, 1) == path)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; NULL when there is none."""
    return F.nullif(F.regexp_extract(url, PATH_PATTERN, 1), F.lit(""))


def safe_int(text: Column) -> Column:
    """Text to a 64-bit integer, NULL when it is none. Takes ``0x`` hexadecimal too.

    A failing cast is slow, so texts that cannot be numbers are told by their first character:
    digits, signs and blanks all sort below the colon. ``text`` is used several times and should be
    a plain column.
    """
    number_like = (text > "") & (text < ":")
    hex_form = text.rlike(r"^[+-]?0[xX]0*[0-9a-fA-F]{1,16}\z")
    digits = F.conv(F.regexp_extract(text, "0[xX]0*([0-9a-fA-F]+)$", 1), 16, 10)
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    from_hex = F.when(hex_form, F.concat(sign, digits)).try_cast("bigint")
    return F.when(number_like, F.coalesce(text.try_cast("bigint"), from_hex))
