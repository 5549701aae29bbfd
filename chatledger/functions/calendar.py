"""Dates, times of day and period names.

All times are zone-less, and nothing here passes through the session time zone.
"""

from __future__ import annotations

import datetime as dt


def ntz(value: dt.datetime | dt.date | str) -> str:
    """A literal without zone."""
    return f"TIMESTAMP_NTZ'{value}'"


def date(value: dt.date) -> str:
    return f"DATE'{value.isoformat()}'"


def in_date_range(time: str, since: dt.date, until: dt.date) -> str:
    """Both days included, stated half-open so that it can be pushed down."""
    after = until + dt.timedelta(days=1)
    return f"{time} >= {ntz(since)} AND {time} < {ntz(after)}"


def hour_number(time: str) -> str:
    """Clock hours since 1970-01-01 00:00."""
    return f"CAST(unix_date(CAST({time} AS DATE)) * 24 + hour({time}) AS BIGINT)"


def truncate_millis(time: str) -> str:
    """Messages are stored with milliseconds; finer digits are cut."""
    extra = f"CAST(extract(SECOND FROM {time}) * 1000000 AS BIGINT) % 1000"
    return f"timestampadd(MICROSECOND, -({extra}), {time})"


def _two_digits(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


def second_of_day(time: str) -> str:
    return f"(hour({time}) * 3600 + minute({time}) * 60 + second({time}))"


def two_hour_block(time: str) -> str:
    """``22:00 - 00:00`` and the like."""
    start = f"(hour({time}) - hour({time}) % 2)"
    end = f"(({start} + 2) % 24)"
    return f"concat({_two_digits(start)}, ':00 - ', {_two_digits(end)}, ':00')"


def day_fraction(time: str) -> str:
    """whole seconds since midnight as a fraction of the day."""
    return f"({second_of_day(time)} / 86400D)"


def minute_of_day(time: str) -> str:
    """F6."""
    return f"(hour({time}) * 60 + minute({time}))"


def nearest_quarter(time: str) -> str:
    """nearest quarter hour, a tie goes to the even quarter, midnight wraps."""
    quarter = f"(CAST(bround({second_of_day(time)} / 900D) AS INT) % 96)"
    hour, minute = f"({quarter} div 4)", f"({quarter} % 4 * 15)"
    return f"concat({_two_digits(hour)}, ':', {_two_digits(minute)})"


def day_month_year(time: str) -> str:
    """F10."""
    return f"date_format(CAST({time} AS DATE), 'dd/MM/yyyy')"


def minute_text(time: str) -> str:
    """``yyyy-MM-dd HH:mm``, nothing as ''."""
    return f"coalesce(substring(CAST({time} AS STRING), 1, 16), '')"


def lenient_timestamp(text: str) -> str:
    """an empty or unreadable date text becomes null."""
    return f"try_cast({text} AS TIMESTAMP_NTZ)"


def period_key(since: str, until: str) -> str:
    """``2024-01-01_2024-01-02``."""
    return f"concat_ws('_', CAST(CAST({since} AS DATE) AS STRING), CAST(CAST({until} AS DATE) AS STRING))"


def period_label(key: str) -> str:
    """``2024-01-01 a 2024-01-02``."""
    return f"replace({key}, '_', ' a ')"


_DATE = "[0-9]{4}[-_][0-9]{2}[-_][0-9]{2}"


def period_from_name(name: str) -> tuple[str, str]:
    """both dates in a report file name, with ``-`` or ``_`` inside the dates.
    Names without two dates give null."""

    def one(group: int) -> str:
        found = f"regexp_extract({name}, '_({_DATE})_({_DATE})[.]parquet$', {group})"
        return f"try_cast(nullif(translate({found}, '_', '-'), '') AS DATE)"

    return one(1), one(2)
