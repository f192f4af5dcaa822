"""Exact money sums.

A sum of doubles depends on the order rows are added, which depends on partitioning, so a rerun on a different
cluster can round a total ending in ...5 the other way. Money is therefore summed as DECIMAL: each value is taken
to six decimals (amounts carry at most that many) and the sum is exact and order-independent; rounding to cents
happens once, HALF_UP, on the exact total. A group holding a value that has no such decimal form (NaN, infinity,
beyond 10^12, or with digits past the sixth decimal) falls back to the double sum, so NaN still poisons the total,
nothing aborts and no digit is dropped.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _exact(c: Column):
    """(exact decimal sum, all values survive the conversion): NaN, infinities and values beyond the decimal range do
    not convert, and values with digits past the sixth decimal would lose them; then the caller falls back to the
    double sum (NaN and overflow behave as for doubles)."""
    as_dec = c.try_cast(MONEY)
    lost = as_dec.isNull() | (F.abs(c - as_dec.cast("double")) > F.abs(c) * 1e-12)
    return F.sum(as_dec), F.count_if(c.isNotNull() & lost) == 0


def money_exact(c) -> Column:
    """The exact DECIMAL total, or NULL when a value has no decimal form (for ordering by exact amounts)."""
    c = _col(c)
    exact, ok = _exact(c)
    return F.when(ok, exact)


def money_sum(c) -> Column:
    """Exact sum as DOUBLE (the double nearest the exact decimal total)."""
    c = _col(c)
    exact, ok = _exact(c)
    return F.when(ok, exact.cast("double")).otherwise(F.sum(c))


def money_total(c, digits: int = 2) -> Column:
    """Exact sum rounded HALF_UP to ``digits`` decimals, as DOUBLE."""
    c = _col(c)
    exact, ok = _exact(c)
    return F.when(ok, F.round(exact, digits).cast("double")).otherwise(F.round(F.sum(c), digits))
