"""Analyst views, PII masking and ad-hoc SQL.

Money totals are exact DECIMAL sums rounded once (see ``functions.money``).

``create_views`` registers them as temporary views of one session; ``VIEW_SQL`` are the same views as SQL, which
``sources.warehouse`` makes persistent. Either way analyst SQL keeps the full Catalyst path (pruning, pushdown, AQE)
and stays distributed; nothing is loaded into a single-process database.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import pii_columns
from ..functions.money import MONEY, money_exact, money_sum, money_total

GOLD_VIEW_PREFIX = "gold_"


def register_gold(gold: dict[str, DataFrame], prefix: str = GOLD_VIEW_PREFIX) -> dict[str, str]:
    """Expose gold tables as temp views; returns table -> view name."""
    names = {}
    for name, df in gold.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names


def create_views(spark: SparkSession, gold: dict[str, DataFrame], prefix: str = GOLD_VIEW_PREFIX) -> dict[str, DataFrame]:
    """V4: create-or-replace the analyst views over the gold tables; returns view name -> DataFrame.

    Each view is the DataFrame of its function below registered under its name, so SQL users query
    ``v_monthly_revenue`` etc. and DataFrame users call the functions; both get the same plan.
    """
    register_gold(gold, prefix)
    out = {"v_monthly_revenue": monthly_revenue(gold["fact_orders"], gold["dim_date"]),
           "v_category_performance": category_performance(gold["fact_order_items"], gold["dim_product"]),
           "v_customers_masked": customers_masked(gold["dim_customer"])}
    for view, df in out.items():
        df.createOrReplaceTempView(view)
    return {view: spark.table(view) for view in out}


def monthly_revenue(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """V1: orders and revenue per calendar month of purchase. Its late_share counts an undelivered order (NULL
    is_late) as on time, unlike the mart's, which leaves those orders out."""
    j = facts.join(dates, dates.date_key == facts.purchase_date_key)
    return (j.groupBy(dates.year, dates.month)
            .agg(F.count(F.lit(1)).alias("orders"), money_total(facts.payment_value).alias("revenue"),
                 F.round(F.avg(F.when(facts.is_late, 1).otherwise(0)), 4).alias("late_share"))
            .orderBy("year", "month"))


def category_performance(items: DataFrame, products: DataFrame) -> DataFrame:
    """V2: lines and revenue per product category, ranked by revenue. The rank runs after the aggregation, over
    one row per category, so its single window partition stays small."""
    from pyspark.sql import Window
    per = (items.join(products, "product_key").groupBy("category")
           .agg(F.count(F.lit(1)).alias("items"), money_sum("price").alias("_rev"),
                money_exact("price").alias("_rev_exact"), money_total("price").alias("revenue")))
    return per.select("category", "items", "revenue",
                      F.rank().over(Window.orderBy(F.col("_rev").desc_nulls_last(), F.col("_rev_exact").desc_nulls_last()))
                      .alias("revenue_rank"))


def _exact_total(column: str) -> str:
    """``money_total`` as SQL text: exact decimals rounded once, or the double sum where a value has no such form."""
    d = f"try_cast({column} AS {MONEY})"
    lost = f"{column} IS NOT NULL AND ({d} IS NULL OR abs({column} - CAST({d} AS DOUBLE)) > abs({column}) * 1e-12)"
    return f"CASE WHEN count_if({lost}) = 0 THEN CAST(round(sum({d}), 2) AS DOUBLE) ELSE round(sum({column}), 2) END"


def _exact_order(column: str) -> tuple[str, str]:
    """What ``category_performance`` ranks by: the total as a double, and the exact total (null where there is none)."""
    d = f"try_cast({column} AS {MONEY})"
    lost = f"{column} IS NOT NULL AND ({d} IS NULL OR abs({column} - CAST({d} AS DOUBLE)) > abs({column}) * 1e-12)"
    return (f"CASE WHEN count_if({lost}) = 0 THEN CAST(sum({d}) AS DOUBLE) ELSE sum({column}) END",
            f"CASE WHEN count_if({lost}) = 0 THEN sum({d}) END")


#: The three views below as SQL, for the catalog: ``{gold}`` is the schema of the gold tables. A persistent view cannot
#: hold a DataFrame; tests/test_warehouse.py compares each with its function.
VIEW_SQL = {
    "v_monthly_revenue": f"""
        SELECT d.year, d.month, count(*) AS orders, {_exact_total('f.payment_value')} AS revenue,
               round(avg(CASE WHEN f.is_late THEN 1 ELSE 0 END), 4) AS late_share
        FROM {{gold}}.fact_orders f JOIN {{gold}}.dim_date d ON d.date_key = f.purchase_date_key
        GROUP BY d.year, d.month ORDER BY d.year, d.month""",
    "v_category_performance": f"""
        SELECT category, items, revenue,
               rank() OVER (ORDER BY total DESC NULLS LAST, exact_total DESC NULLS LAST) AS revenue_rank
        FROM (SELECT p.category, count(*) AS items, {_exact_total('i.price')} AS revenue,
                     {_exact_order('i.price')[0]} AS total, {_exact_order('i.price')[1]} AS exact_total
              FROM {{gold}}.fact_order_items i JOIN {{gold}}.dim_product p USING (product_key) GROUP BY p.category)""",
    "v_customers_masked": "SELECT customer_key, customer_city, customer_state FROM {gold}.dim_customer",
}


def mask(df: DataFrame, policy: dict[str, str] | None = None, pii: frozenset[str] | None = None,
         keep: tuple[str, ...] = (), salt: str | None = None) -> DataFrame:
    """Contract-driven masking: every PII column is dropped, hashed (sha2-256) or kept as the policy says.

    Columns not named in ``policy`` default to ``drop``; ``keep`` lists PII columns shown on purpose. Low-cardinality
    values (a 5-digit zip) are easy to recover from a bare hash by trying every value, so pass a secret ``salt``
    when hashed columns leave the governed zone; equal inputs still hash equal, so joins on them keep working.
    """
    pii = pii if pii is not None else pii_columns()
    policy = dict(policy or {})
    cols = []
    for name in df.columns:
        action = "keep" if name in keep else (policy.get(name, "drop") if name in pii else "keep")
        if action == "keep":
            cols.append(F.col(name))
        elif action == "hash":
            value = F.col(name).cast("string")
            cols.append(F.sha2(F.concat(F.lit(salt), value) if salt else value, 256).alias(name))
        elif action != "drop":
            raise ValueError(f"unknown masking action {action!r} for {name}")
    return df.select(*cols)


def customers_masked(dim_customer: DataFrame) -> DataFrame:
    """V3: customer_key, city and state only (city is shown on purpose; zip and person id never)."""
    return dim_customer.select("customer_key", "customer_city", "customer_state")


def query(spark: SparkSession, sql: str) -> DataFrame:
    """V5: ad-hoc read-only SQL over registered views, as a lazy DataFrame.

    The statement runs as a subquery, where only queries parse: commands that write or change the catalog (INSERT,
    CREATE, DROP, SET, ...) are refused with a parse error before anything runs."""
    return spark.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """V6: (column, type) pairs from the schema, no job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
