"""First k rows of every group, without ever gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                  spread: str, rank: str = "rank") -> DataFrame:
    """Rows ranked 1 to k in their group, with their ``rank``.

    The literal bound lets every task drop all but k rows of a group before the shuffle
    (window group limit).  Spark does so only up to a threshold; for a larger k the
    group is first ranked in salted pieces by a hash of ``spread``, which is as exact:
    a row outside the first k of its piece cannot be among the first k of the group.
    """
    def ranked(rows: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn(rank, number).where(F.col(rank) <= k)

    if k > int(df.sparkSession.conf.get(LIMIT_SETTING, "1000")):
        salt = F.pmod(F.xxhash64(spread), F.lit(SALTS))
        df = ranked(df, [*group, salt]).drop(rank)
    return ranked(df, group)
