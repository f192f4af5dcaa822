"""Referentially consistent sample.

The first ``n`` orders by purchase time (ties by order_id) and every row that belongs to them: lines, payments and
reviews of those orders, their customers, and the sellers and products their lines reference. A small top-n is a
``TakeOrderedAndProject`` (each partition keeps its own top n); for a larger one the n-th time is found by counting
(``first_rows``), so no task holds n rows. It is computed once and checkpointed (n rows); the lines
of those orders are cut once and checkpointed too, and every member table is cut with a left-semi join against a
bounded key set, broadcast when it is proven small, so no large table is shuffled.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import BROADCAST_MAX_ROWS, broadcast_if_bounded


#: Up to this many rows the top n is a TakeOrderedAndProject, where every task keeps n rows in memory.
TOP_N_ROWS = 1_000_000
#: Time ranges counted at once while the n-th time is looked for.
TIME_BINS = 1024


def _nth_time(times: DataFrame, n: int, bins: int = TIME_BINS) -> tuple[int, int]:
    """(t, rows before t) of the n-th smallest of the microseconds ``t``, of which there are at least ``n``.

    The range that holds it is cut into ``bins`` parts and counted anew until it is one microsecond wide: six counts for
    any span of years, each bringing at most ``bins`` rows to the driver."""
    low, high = times.agg(F.min("t"), F.max("t")).first()
    before = 0
    while low < high:
        width = (high - low) // bins + 1
        part = F.floor((F.col("t") - low) / width) if width > 1 else F.col("t") - low
        counts = dict(times.where(F.col("t").between(low, high)).groupBy(part.cast("long")).count().collect())
        for k in sorted(counts):
            if before + counts[k] >= n:
                low, high = low + k * width, min(high, low + (k + 1) * width - 1)
                break
            before += counts[k]
    return low, before


def first_rows(df: DataFrame, n: int, order_col: str, tie_col: str, top_n: int = TOP_N_ROWS) -> DataFrame:
    """O3: the first ``n`` rows by ``order_col`` (a timestamp, NULLs last) and then by ``tie_col``, for any ``n``.

    Beyond ``top_n`` rows, all rows before the n-th time are taken by a filter, and only what is missing of that one
    instant (or of the rows without a time) is ordered by ``tie_col``."""
    order = [F.col(order_col).asc_nulls_last(), F.col(tie_col).asc_nulls_last()]
    if n <= top_n:
        return df.orderBy(*order).limit(n)
    micros = F.unix_micros(F.col(order_col).cast("timestamp"))
    total, timed = df.agg(F.count(F.lit(1)), F.count(order_col)).first()
    if n >= total:
        return df
    if n >= timed:
        sure, edge, missing = F.col(order_col).isNotNull(), F.col(order_col).isNull(), n - timed
    else:
        t, before = _nth_time(df.where(F.col(order_col).isNotNull()).select(micros.alias("t")), n)
        sure, edge, missing = micros < t, micros == t, n - before
    return df.where(sure).unionByName(df.where(edge).orderBy(*order).limit(missing))


def sample_slice(src: dict[str, DataFrame], n: int = 2000,
                 order_col: str = "order_purchase_timestamp") -> dict[str, DataFrame]:
    spark = src["orders"].sparkSession
    ensure_checkpoint_dir(spark)
    # the top n is computed once: a reliable checkpoint of its n rows, reused by every member's semi-join
    orders = first_rows(src["orders"], n, order_col, "order_id").checkpoint(eager=True)
    # the key sets have at most n rows: broadcast them while n is within the broadcast bound, else shuffle
    small = (lambda df: F.broadcast(df)) if n <= BROADCAST_MAX_ROWS else (lambda df: df)
    ids = small(orders.select("order_id"))

    def members(name: str, keys: DataFrame, key: str) -> DataFrame:
        # a USING join puts the key column first; keep the source's column order (strict CSV checks the header)
        return src[name].join(keys, key, "left_semi").select(*src[name].columns)

    # the lines of the sampled orders are cut once; sellers and products are then cut by their distinct ids,
    # broadcast when their count is proven small
    items = members("order_items", ids, "order_id").checkpoint(eager=True)
    return {
        "orders": orders,
        "order_items": items,
        "payments": members("payments", ids, "order_id"),
        "reviews": members("reviews", ids, "order_id"),
        "customers": members("customers", small(orders.select("customer_id")), "customer_id"),
        "sellers": members("sellers", broadcast_if_bounded(items.select("seller_id").distinct()), "seller_id"),
        "products": members("products", broadcast_if_bounded(items.select("product_id").distinct()), "product_id"),
        "category_translation": src["category_translation"],
    }


def slice_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for every member of the slice, as one DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_slice(tables: dict[str, DataFrame], out_dir: str, files: dict[str, str] | None = None) -> dict[str, str]:
    """S17+S19: write every member of the slice as a headed CSV folder named after its contract file, ready for
    strict ingestion (``LakeJob(raw_dir=out_dir)``); returns source -> path."""
    from ..contracts import SOURCES
    from ..sources.files import write_csv
    paths = {}
    for name, df in tables.items():
        file = (files or {}).get(name) or SOURCES[name].file
        path = f"{out_dir.rstrip('/')}/{file}"
        write_csv(df, path)
        paths[name] = path
    return paths
