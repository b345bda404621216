"""Date and time helpers.  Text times are ``yyyy-MM-dd HH:mm:ss`` in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME = "yyyy-MM-dd HH:mm:ss"
DATE = "yyyy-MM-dd"
DATE_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"


def parse_time(text: Column) -> Column:
    return F.to_timestamp(text, TIME)


def parse_date_key(text: Column) -> Column:
    return F.to_date(text, DATE_KEY)


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, DATE)


def date_key(ts: Column) -> Column:
    return F.date_format(ts, DATE_KEY)


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_KEY)


def date_hour(time_text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to ``yyyy-MM-dd_HH``."""
    return F.concat_ws("_", F.substring(time_text, 1, 10), F.substring(time_text, 12, 2))


def before(first: Column, second: Column) -> Column:
    return parse_time(first) < parse_time(second)


def after(first: Column, second: Column) -> Column:
    return parse_time(first) > parse_time(second)


def minus_seconds(first: Column, second: Column) -> Column:
    """Seconds from ``second`` to ``first``."""
    return F.unix_seconds(parse_time(first)) - F.unix_seconds(parse_time(second))
