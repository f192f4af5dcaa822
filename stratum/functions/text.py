"""Text standardisation."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_city(c: str | Column) -> Column:
    """initcap(trim(x)): words split on spaces only, so 'mogi-guaçu' becomes 'Mogi-guaçu'."""
    return F.initcap(F.trim(c))


def upper_code(c: str | Column) -> Column:
    return F.upper(F.trim(c))


def zip5(c: str | Column) -> Column:
    """Left-pad to five characters with zeros (longer input is cut to five, as lpad does)."""
    return F.lpad(c, 5, "0")


def status_text(c: str | Column) -> Column:
    return F.lower(F.trim(c))
