"""Time text codecs for the provider's ``time_utc`` form.

``2024-08-20 18:43:30.581815109 +0000 UTC``: nanoseconds, a numeric offset
and a literal ``UTC`` tail. Spark keeps microseconds, so nanoseconds are
truncated. The session time zone is UTC (see ``session.ensure_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Datetime patterns of the provider text and of ISO output.
TIME_UTC_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS] xx"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"
TIME_UTC_OUT = "yyyy-MM-dd HH:mm:ss.SSSSSS xx 'UTC'"


def parse_time_utc(text: Column) -> Column:
    """P-02: cut the 4-character `` UTC`` tail, honour the offset; NULL on
    text that does not parse."""
    body = F.when(text.endswith(" UTC"),
                  text.substr(F.lit(1), F.length(text) - 4)).otherwise(text)
    return F.try_to_timestamp(body, F.lit(TIME_UTC_PATTERN))


def iso_text(ts: Column) -> Column:
    """P-03: ISO-8601 text; like Python's ``isoformat`` the fraction is left
    out when the microseconds are zero."""
    micros = F.unix_micros(ts) % 1000000
    return F.when(ts.isNull(), F.lit(None)).when(
        micros == 0, F.date_format(ts, ISO_SECONDS)).otherwise(F.date_format(ts, ISO_MICROS))


def epoch_seconds(ts: Column) -> Column:
    """P-04: epoch seconds with fraction (double)."""
    return F.unix_micros(ts) / F.lit(1000000.0)


def time_utc_text(epoch: Column) -> Column:
    """P-05: epoch seconds -> ``... +0000 UTC`` text, rounded to micros."""
    micros = F.round(epoch * F.lit(1000000.0)).cast("long")
    return F.date_format(F.timestamp_micros(micros), TIME_UTC_OUT)


def utc_wallclock(ts: Column) -> Column:
    """An instant as UTC wall-clock ``TIMESTAMP_NTZ`` (session zone is UTC)."""
    return ts.cast("timestamp_ntz")
