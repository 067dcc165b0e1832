"""Keyed, partition-independent hashing.

Every random choice in the library (sampling, folds, generated columns) is a
pure function of (key, seed): the first 15 hex digits of
``md5(concat_ws(':', key..., seed))`` read as a 60-bit integer. The same value
comes out in any partitioning, after any recomputation, and in DuckDB
(``('0x' || substr(md5(...), 1, 15))::BIGINT``), which is what the oracles use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
HASH_SPAN = 1 << HASH_BITS  # number of distinct hash values


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_hash(keys, seed) -> Column:
    """60-bit non-negative bigint hash of the key columns and a seed."""
    if isinstance(keys, (str, Column)):
        keys = [keys]
    parts = [_as_col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def hash_below(keys, seed, fraction: float) -> Column:
    """Boolean: the key's hash falls in the lowest ``fraction`` of the range."""
    cut = int(fraction * HASH_SPAN)
    return key_hash(keys, seed) < F.lit(cut).cast("bigint")
