"""Join helpers: size-checked broadcast (J1) and pre-aggregate-then-join."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a lookup side may have and still be broadcast on purpose. Lookups above it go through a shuffle join
# (AQE may still broadcast them once their real size is measured at run time).
BROADCAST_MAX_ROWS = 200_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only after proving the side has at most ``max_rows`` rows.

    The proof is ``take(max_rows + 1)`` of a constant column: Spark scans partitions incrementally and stops once
    it holds ``max_rows + 1`` rows, and at most that many one-column rows reach the driver. (A frame with shuffles
    upstream still computes them; use it on scans and cheap projections of lookup tables.)
    """
    n = len(df.select(F.lit(1).alias("_")).take(max_rows + 1))
    return F.broadcast(df) if n <= max_rows else df


def left_join_all(base: DataFrame, key: str, sides: list[DataFrame]) -> DataFrame:
    """Chain left joins that all use the same key, so one hash partitioning on ``key`` serves every join."""
    out = base
    for side in sides:
        out = out.join(side, key, "left")
    return out
