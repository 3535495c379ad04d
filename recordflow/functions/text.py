"""Names, timestamps and URL templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import variant as V


def camel_to_snake(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"([a-z])([A-Z])", "$1_$2"))


def utc_text(epoch_seconds: Column) -> Column:
    """Whole epoch seconds as ``yyyy-MM-ddTHH:mm:ss``, whatever the session time zone."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = zero + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch_seconds.cast("decimal(18,6)"))
    return F.replace(at.cast("string"), F.lit(" "), F.lit("T"))


def _fraction(digits: Column) -> Column:
    """Nanosecond digits as an ISO fraction of 0, 3, 6 or 9 places."""
    padded = F.rpad(digits, 9, "0")
    return (
        F.when(padded == "000000000", F.lit(""))
        .when(F.substring(padded, 4, 6) == "000000", F.concat(F.lit("."), F.substring(padded, 1, 3)))
        .when(F.substring(padded, 7, 3) == "000", F.concat(F.lit("."), F.substring(padded, 1, 6)))
        .otherwise(F.concat(F.lit("."), padded))
    )


# An ISO instant: date, T, time with seconds, up to nine fraction digits, Z or an offset.
INSTANT = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[Tt]([0-9]{2}:[0-9]{2}:[0-9]{2})"
    r"(?:\.([0-9]{0,9}))?([Zz]|[+-][0-9]{2}:[0-9]{2}(?::[0-9]{2})?)$"
)
EPOCH_TEXT = r"^[0-9]{10,13}$"
MILLIS_ABOVE = 1_000_000_000_000


def iso_instant(text: Column) -> Column:
    """An ISO instant in canonical UTC form, else NULL."""
    whole = F.concat(
        F.regexp_extract(text, INSTANT, 1),
        F.lit("T"),
        F.regexp_extract(text, INSTANT, 2),
        F.upper(F.regexp_extract(text, INSTANT, 4)),
    )
    seconds = F.unix_seconds(F.try_to_timestamp(whole))
    out = F.concat(utc_text(seconds), _fraction(F.regexp_extract(text, INSTANT, 3)), F.lit("Z"))
    return F.when(text.rlike(INSTANT), out)


def epoch_instant(text: Column) -> Column:
    """10 to 13 digits as an instant: milliseconds above 1e12, seconds up to it; else NULL."""
    value = text.try_cast("bigint")
    millis = F.concat(
        utc_text(F.floor(value / 1000)),
        _fraction(F.lpad((value % 1000).cast("string"), 3, "0")),
        F.lit("Z"),
    )
    seconds = F.concat(utc_text(value), F.lit("Z"))
    return F.when(text.rlike(EPOCH_TEXT), F.when(value > MILLIS_ABOVE, millis).otherwise(seconds))


def render_url(template: str, body: Column) -> Column:
    """Fill ``{field}`` from a JSON body; an absent field gives its own name, bad JSON the bare template."""
    pieces = re.split(r"\{([^}]+)\}", template)
    if len(pieces) == 1:
        return F.lit(template)
    parsed = V.parse(body)
    parts = []
    for i, piece in enumerate(pieces):
        if i % 2:
            parts.append(F.coalesce(V.text_of(V.field(parsed, piece)), F.lit(piece)))
        elif piece:
            parts.append(F.lit(piece))
    return F.when(parsed.isNull(), F.lit(template)).otherwise(F.concat(*parts))
