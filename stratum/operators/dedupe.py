"""Deterministic de-duplication (A11) and latest-row-per-key.

The survivor of every duplicate group is fixed by a *total* order: the caller's order columns first, then every
remaining non-key column ascending (NULLs first). So reruns and other engines pick the same row, where a bare
``dropDuplicates`` would keep an arbitrary one.

Plan shape: ``row_number() ... = 1`` lets Catalyst insert a partial ``WindowGroupLimit`` *before* the shuffle, so
each map task forwards at most one row per key. A hot key holding a third of the table therefore ships one row per
map task, not a third of the table, into its reducer.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

_RN = "__stratum_rn"


def _orderable(df: DataFrame, exclude: set[str]) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, (MapType, VariantType))]


def first_per_key(df: DataFrame, keys: list[str] | tuple[str, ...],
                  order_by: list[Column] | None = None, tiebreak_exclude: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` and then by all other columns ascending."""
    keys = list(keys)
    lead = list(order_by or [])
    rest = [F.col(c).asc_nulls_first() for c in _orderable(df, set(keys) | set(tiebreak_exclude))]
    w = Window.partitionBy(*keys).orderBy(*(lead + rest))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_by_key(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Collapse rows sharing ``keys`` to one deterministic survivor."""
    return first_per_key(df, keys)


def latest_per_key(df: DataFrame, keys: list[str] | tuple[str, ...], order_col: str) -> DataFrame:
    """Most recent row per key by ``order_col`` (NULL times last), ties broken by the other columns."""
    return first_per_key(df, keys, [F.col(order_col).desc_nulls_last()])
