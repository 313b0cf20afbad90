"""Hot-key detection shared by the operators that split hot groups.

A group is hot when it holds more than ``hot_rows`` rows.  The per-group
count is an aggregate of the key columns only (map-side combined), and the
list of hot keys has at most (total rows / ``hot_rows``) entries; its size is
counted before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups above this many rows take the split (distributed) path.
HOT_GROUP_ROWS = 500_000
# For rows that are known to hold no hot group: nothing is counted.
NONE_HOT = (1 << 63) - 1
# Hot-key lists up to this many rows are broadcast.
BROADCAST_MAX_KEYS = 200_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_GROUP_ROWS
             ) -> tuple[DataFrame | None, int]:
    """``(keys of hot groups or None, how many)``; the frame is broadcast when
    small enough."""
    if hot_rows >= NONE_HOT:
        return None, 0
    return counted_hot_keys(df, keys, hot_rows)[:2]


def counted_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_GROUP_ROWS
                     ) -> tuple[DataFrame | None, int, int]:
    """``hot_keys`` and, from the same counts, how many rows there are."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n_rows, n_hot = counts.agg(F.sum("_n"), F.count_if(F.col("_n") > hot_rows)).first()
    if n_hot == 0:
        return None, 0, n_rows or 0
    hot = counts.where(F.col("_n") > hot_rows).select(*keys)
    return (F.broadcast(hot) if n_hot <= BROADCAST_MAX_KEYS else hot), n_hot, n_rows
