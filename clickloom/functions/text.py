"""Text, number, list and JSON helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def trim_comma(text: Column) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(text, "^,|,$", "")


def two_digits(text: Column) -> Column:
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def round_half_up(number: Column, scale: int) -> Column:
    return F.round(number, scale)


def id_list(csv: Column) -> Column:
    """Comma-joined ids to an array of bigint; a null list stays null."""
    return F.transform(F.split(csv, ","), lambda item: F.trim(item).cast("bigint"))


def csv_or_null(items: Column) -> Column:
    """Array to comma-joined text, with null for an empty list."""
    return F.nullif(F.array_join(items, ","), F.lit(""))


def json_value(json: Column, field: str) -> Column:
    return F.get_json_object(json, f"$.{field}")


def concat_long_string(number: Column, text: Column, separator: str) -> Column:
    return F.concat_ws(separator, number.cast("string"), text)


def group_concat_distinct(text: Column) -> Column:
    """Aggregate: sorted distinct values, comma-joined.

    The partial step keeps one set per group and task, so a hot group sends one small
    row per task and not its rows.
    """
    return F.array_join(F.array_sort(F.collect_set(text)), ",")
