"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep, for each key, the row that is last by ``order_by`` (missing values lose).

    Ties are broken by ``tie_break``, by default every other column in name order, so
    a retried task picks the same row again. Spark runs rank 1 as a group limit before
    and after the shuffle: each map task sends at most one row per key, and a key that
    holds a large share of the rows stays cheap for the task that receives it.
    """
    if tie_break is None:
        used = {*keys, *order_by}
        tie_break = sorted(name for name in df.columns if name not in used)
    newest_first = [F.col(name).desc_nulls_last() for name in (*order_by, *tie_break)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
