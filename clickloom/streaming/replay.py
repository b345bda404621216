"""Replaying a stored ad log as a sequence of arrivals."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def replay(slices: Iterable[DataFrame], landing: str,
           start: Callable[[], StreamingQuery]) -> None:
    """Land each slice of record text, then run the stream over what is new.

    The stream is started once per slice on the same checkpoint, so each slice is one
    micro-batch however many files it has, and every slice is also a restart.  The loop
    is over the given slices; the rows never pass the driver.
    """
    for number, lines in enumerate(slices):
        lines.write.mode("overwrite").text(f"{landing}/arrival-{number:05d}")
        start().awaitTermination()
