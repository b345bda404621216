"""Reading and changing ``k=v|k=v`` record text, for ingest of old exports.

Everything else in the package works on real columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fields(record: Column, delimiter: str) -> Column:
    """Entries with both a name and a value, as (name, value) structs."""
    pairs = F.transform(F.split(record, _literal(delimiter)), lambda part: F.split(part, "="))
    named = F.filter(pairs, lambda pair: (F.size(pair) == 2) & (F.element_at(pair, 2) != ""))
    return F.transform(named, lambda pair: F.struct(F.element_at(pair, 1).alias("name"),
                                                    F.element_at(pair, 2).alias("value")))


def _literal(delimiter: str) -> str:
    return "\\Q" + delimiter + "\\E"


def get_field(record: Column, field: str, delimiter: str = "|") -> Column:
    """First value stored under ``field``; null when it is absent or empty."""
    match = F.filter(_fields(record, delimiter), lambda entry: entry["name"] == field)
    return F.get(match, F.lit(0))["value"]


def set_field(record: Column, field: str, value: Column, delimiter: str = "|") -> Column:
    """Replace the value of ``field``, keeping the order of the entries."""
    def rewrite(part: Column) -> Column:
        name = F.element_at(F.split(part, "="), 1)
        return F.when(name == field, F.concat_ws("=", name, value)).otherwise(part)

    return F.array_join(F.transform(F.split(record, _literal(delimiter)), rewrite), delimiter)
