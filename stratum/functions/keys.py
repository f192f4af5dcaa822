"""Key functions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """Stable BIGINT key: xxhash64 over the natural key cast to text.

    Casting first makes the key independent of the natural key's storage type (INT 1 and BIGINT 1 hash apart
    otherwise). A NULL natural key gives a NULL surrogate key rather than the hash seed, so it can never look like
    a real member and foreign-key checks report it.
    """
    parts = [_col(c).cast("string") for c in cols]
    any_null = None
    for p in parts:
        any_null = p.isNull() if any_null is None else (any_null | p.isNull())
    return F.when(~any_null, F.xxhash64(*parts))


def date_key(c) -> Column:
    """yyyyMMdd as INT of the calendar day (session zone).

    Integer arithmetic on the date parts gives the same value as formatting the date as text and parsing it
    back, without building a string per row.
    """
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
