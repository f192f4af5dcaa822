"""Rule-based quarantine.

A rule is a predicate that marks a row *bad* plus the reason recorded for it. Rules are evaluated in order and the
first rule that is TRUE names the reason. A predicate that evaluates to NULL does not reject (three-valued logic), so
rows with a NULL status, price or score pass unless a rule tests for NULL explicitly.

The rules become one chained ``CASE WHEN`` column, so flagging is a single projection inside whole-stage codegen.
Good rows are the flagged rows without a reason; rejected rows are selected by the OR of the rules first (which a
Parquet scan can take as a pushed filter) and then given their reason.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reject_reason"


@dataclass(frozen=True)
class Rule:
    reason: str
    bad: Column | str  # Column, or a Spark SQL predicate string

    def predicate(self) -> Column:
        return F.expr(self.bad) if isinstance(self.bad, str) else self.bad


def reason_column(rules: list[Rule]) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    expr = None
    for rule in rules:
        cond = rule.predicate()
        expr = F.when(cond, F.lit(rule.reason)) if expr is None else expr.when(cond, F.lit(rule.reason))
    return expr


def flag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``_reject_reason`` (NULL for good rows)."""
    return df.withColumn(REASON, reason_column(rules))


def any_bad(rules: list[Rule]) -> Column:
    """TRUE when some rule is TRUE. As a filter it keeps exactly the rejected rows (NULL OR TRUE is TRUE, and a
    filter drops NULL), and Catalyst can push it into a Parquet scan when the rules compare plain columns."""
    cond = None
    for rule in rules:
        cond = rule.predicate() if cond is None else (cond | rule.predicate())
    return cond if cond is not None else F.lit(False)


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected rows with it).

    The rejected branch filters on the OR of the rules *before* naming the reason, so on Parquet input the filter
    is pushed to the scan and row groups whose statistics rule out every reject are skipped.
    """
    good = flag(df, rules).filter(F.col(REASON).isNull()).drop(REASON)
    rejected = df.filter(any_bad(rules)).withColumn(REASON, reason_column(rules))
    return good, rejected


def quarantine_rows(rejected: DataFrame, table: str, key: list[str] | tuple[str, ...],
                    drop: tuple[str, ...] = ()) -> DataFrame:
    """Rejected rows in the shared quarantine shape.

    ``key`` is the first key column (as text), ``full_key`` all key columns joined by '|', and ``record`` the
    whole source row as JSON so nothing about the reject is lost.
    """
    payload = [c for c in rejected.columns if c != REASON and c not in drop]
    return rejected.select(
        F.lit(table).alias("table"),
        F.col(key[0]).cast("string").alias("key"),
        F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]).alias("full_key"),
        F.col(REASON),
        F.to_json(F.struct(*payload)).alias("record"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
