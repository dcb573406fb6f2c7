"""Date helpers with the reports' whole-unit semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Fixed value: the source's creation-time text format (quoted 'Z': the instant
# is read in the session time zone, which is UTC).
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Text of that format in ASCII digits from the year 1 on (the format has no year 0, a cast has one).
ISO_UTC_FORM = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}Z\z"
# Fixed value: the date dimension's key format.
DATE_KEY_FORMAT = "dd-MM-yyyy"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def order_date(ts: str | Column = "creation_time_utc") -> Column:
    """Calendar date of an order timestamp."""
    return F.to_date(_col(ts))


def parse_iso_utc(text: str | Column) -> Column:
    """ISO text -> TIMESTAMP_NTZ; text not matching the format gives NULL.

    Text of the usual form is cast, which gives the same time and costs a fraction of a parse by
    format; the format decides on all other text.
    """
    c = _col(text)
    usual = c.cast("string").rlike(ISO_UTC_FORM)
    by_cast = c.cast("string").substr(1, 23).try_cast("timestamp")
    return F.when(usual, by_cast).otherwise(F.try_to_timestamp(c, F.lit(ISO_UTC_FORMAT))).cast("timestamp_ntz")


def whole_days_to(ts: str | Column, as_of: dt.date | str) -> Column:
    """Whole elapsed days from a timestamp to midnight of ``as_of``.

    A timestamp at 12:00 is 0 days before the next midnight (not 1, as a
    calendar-date difference would say).
    """
    end = date_lit(as_of).cast("timestamp_ntz")
    return F.timestamp_diff("DAY", _col(ts).cast("timestamp_ntz"), end)


def days_between(start: str | Column, end: str | Column) -> Column:
    """Calendar days between two dates."""
    return F.datediff(_col(end), _col(start))


def whole_weeks_between(start: str | Column, end: str | Column) -> Column:
    """Whole 7-day spans from ``start`` to ``end`` (both dates, end >= start)."""
    return F.floor(F.datediff(_col(end), _col(start)) / F.lit(7)).cast("bigint")


def week_start(d: str | Column) -> Column:
    """Monday of the date's week, as DATE."""
    return F.trunc(_col(d), "week")


def month_start(d: str | Column) -> Column:
    """First day of the date's month, as DATE."""
    return F.trunc(_col(d), "month")
