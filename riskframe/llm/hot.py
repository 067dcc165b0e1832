"""Joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is hot; more for inputs so large that over ``HOT_KEYS`` could be.
HOT_ROWS = 200_000
HOT_KEYS = 50_000


def join_hot(rows: DataFrame, table: DataFrame, key: str, n_col: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table`` by ``key`` (null equal to null; every key of a row has its one table row).

    ``n_col`` of the table counts the rows of a key, ``total`` all rows. Rows of hot keys, of
    which there are at most ``HOT_KEYS`` (as each has over total / HOT_KEYS rows), stay where they
    are and meet a broadcast; the others shuffle, and no task gets over ``HOT_ROWS`` of one key.
    Without hot keys this is one join. ``key`` is dropped from the table's side only.
    """
    least = max(HOT_ROWS, total // HOT_KEYS)
    right = table.withColumnRenamed(key, "_hot_key")
    cold = rows.join(right.where(F.col(n_col) <= least), F.col(key).eqNullSafe(F.col("_hot_key")), "inner").drop("_hot_key")
    hot = right.where(F.col(n_col) > least)
    if total <= least or not hot.take(1):
        return cold
    return cold.unionByName(rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "inner").drop("_hot_key"))
