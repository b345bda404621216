"""Task parameters: date range, user and behaviour filters, target page flow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Field names of the task JSON (fixed values).
JSON_SCHEMA = (
    "startDate string, endDate string, startAge string, endAge string, "
    "professionals string, cities string, sex string, keywords string, "
    "categoryIds string, targetPageFlow string"
)


def _items(text: str | None) -> tuple[str, ...]:
    return tuple(part.strip() for part in (text or "").split(",") if part.strip())


def _number(text: str | None) -> int | None:
    return int(text) if text and text.strip() else None


@dataclass(frozen=True)
class TaskParams:
    """A blank or missing value means "no filter"."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    page_flow: tuple[int, ...] = ()

    @classmethod
    def from_json(cls, spark: SparkSession, text: str) -> "TaskParams":
        """Read the task JSON; field names may come without quotes."""
        parsed = F.from_json(F.lit(text), JSON_SCHEMA, {"allowUnquotedFieldNames": "true"})
        row = spark.range(1).select(parsed.alias("p")).select("p.*").first()
        return cls(
            start_date=row.startDate or None,
            end_date=row.endDate or None,
            start_age=_number(row.startAge),
            end_age=_number(row.endAge),
            professionals=_items(row.professionals),
            cities=_items(row.cities),
            sex=row.sex or None,
            keywords=_items(row.keywords),
            category_ids=tuple(int(c) for c in _items(row.categoryIds)),
            page_flow=tuple(int(p) for p in _items(row.targetPageFlow)),
        )
