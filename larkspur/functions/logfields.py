"""Expressions over access-log lines and the fields parsed from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line pattern, the time format, the country rules (in order
# of precedence) and the label of the remainder bucket.
LINE_PATTERN = r'^(.*?) - - \[(.*?)\] "(.*?)" (\d+) (\d+)'
LINE_PATTERN_NULL_BYTES = r'^(.*?) - - \[(.*?)\] "(.*?)" (\d+) (\d+|-)'
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
UK_SUFFIX = ".ac.uk"
US_SUFFIX = ".edu"
AUSTRALIA_PART = ".edu.au"
REST_LABEL = "other institutions"

SECONDS_PER_DAY = 86_400


def field(line: Column, position: int, pattern: str = LINE_PATTERN) -> Column:
    """Group ``position`` of the line pattern, ``''`` when the line does not match."""
    return F.regexp_extract(line, pattern, position)


def all_fields(line: Column, pattern: str = LINE_PATTERN) -> Column:
    """The five groups as an array of text, from a single match of the pattern.

    The whole line is replaced by its groups with line feeds between them, and
    the result is split.  No group can hold a line feed, because neither ``.``
    nor a digit matches one.  The second branch takes a line that misses the
    pattern, whose groups are then all ``''``.
    """
    whole = rf"^(?:{pattern.removeprefix('^')}[\s\S]*|[\s\S]*)"
    return F.split(F.regexp_replace(line, whole, "$1\n$2\n$3\n$4\n$5"), "\n")


def country_of(host: Column) -> Column:
    """Country by the first rule that holds; matching is case-sensitive."""
    return (
        F.when(host.endswith(UK_SUFFIX), "UK")
        .when(host.endswith(US_SUFFIX), "US")
        .when(host.contains(AUSTRALIA_PART), "Australia")
        .otherwise("other")
    )


def epoch_seconds(raw_time: Column) -> Column:
    """Seconds since 1970 UTC; null for text that is no log time.

    The zone comes from the text itself, so the session time zone plays no part.
    """
    return F.unix_seconds(F.try_to_timestamp(raw_time, F.lit(TIME_FORMAT)))


def zone_offset_seconds(raw_time: Column) -> Column:
    """Offset written at the end of a log time (``-0400`` is -14400)."""
    offset = F.regexp_extract(raw_time, r"([+-]\d{4})$", 1)
    size = (
        F.substring(offset, 2, 2).try_cast("int") * 3600
        + F.substring(offset, 4, 2).try_cast("int") * 60
    )
    return F.when(offset.startswith("-"), -size).otherwise(size)


def day_of_month(seconds: Column) -> Column:
    """Day of month of an epoch second, in UTC whatever the session zone is."""
    days = F.floor(seconds / SECONDS_PER_DAY).cast("int")
    return F.dayofmonth(F.date_from_unix_date(days))


def hour_of_day(seconds: Column) -> Column:
    """Hour of an epoch second, in UTC whatever the session zone is."""
    return F.floor(F.pmod(seconds, F.lit(SECONDS_PER_DAY)) / 3600).cast("int")
