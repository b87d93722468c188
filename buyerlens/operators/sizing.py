"""Broadcasts behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` as a broadcast side when it has at most ``max_rows`` rows, else unchanged.

    For results of aggregations that are nearly always tiny, such as one row per
    cluster: without it the large side would be shuffled before Spark can see
    how small the other one is. At most ``max_rows + 1`` rows are fetched."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
