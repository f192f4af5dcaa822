"""Map the driver's TPC-H-style tables onto the source contracts.

The library's operators take contract-shaped sources (orders, order_items, payments, reviews, customers, sellers,
products, category_translation). The shared test tables are TPC-H-shaped, so this adapter derives each contract
source from them with plain DataFrame projections and one per-order line rollup; every derived source grows with
the tables it is read from.

    orders        orders, delivered = last ship date of its lines (only for status F), estimated = +365 days
    order_items   lineitem (price = extended price; duplicate (order, line) keys are kept for de-duplication)
    payments      lineitem, value = ext * (1 - discount) * (1 + tax), type from the return flag
    reviews       events: reviewer = user, order = props.k, score = floor(value) mod 7 (0 and 6 are out of range)
    customers     customer + nation + region (untrimmed lower-case city and state, short zip)
    sellers       supplier + nation + region
    products      part, category = lower(p_type)
    translation   part: one English name per (type, brand), so the key repeats and must be collapsed
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Tables:
    """Lazy parquet readers for the driver tables under one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


# Fixed values of the mapping (stand-in codes → contract domain values).
STATUS_BY_CODE = {"F": " Delivered ", "O": "shipped", "P": "canceled"}
PAYMENT_TYPE_BY_FLAG = {"R": "credit_card", "A": "boleto", "N": "voucher"}
ESTIMATED_DAYS = 365


def _case(col: str, mapping: dict[str, str]) -> F.Column:
    expr = None
    for code, value in mapping.items():
        cond = F.col(col) == F.lit(code)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.col(col))


def _ts(col) -> F.Column:
    return F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp")


def orders(t: Tables) -> DataFrame:
    # Joined on the text order_id (not o_orderkey) so the join's hash partitioning is the one the order
    # de-duplication and every later order_id join need: orders are shuffled once.
    ships = (t["lineitem"].groupBy(F.col("l_orderkey").cast("string").alias("order_id"))
             .agg(F.min("l_shipdate").alias("_first_ship"), F.max("l_shipdate").alias("_last_ship")))
    o = t["orders"].withColumn("order_id", F.col("o_orderkey").cast("string")).join(ships, "order_id", "left")
    return o.select(
        "order_id",
        F.col("o_custkey").cast("string").alias("customer_id"),
        _case("o_orderstatus", STATUS_BY_CODE).alias("order_status"),
        _ts("o_orderdate").alias("order_purchase_timestamp"),
        _ts("o_orderdate").alias("order_approved_at"),
        _ts("_first_ship").alias("order_delivered_carrier_date"),
        _ts(F.when(F.col("o_orderstatus") == "F", F.col("_last_ship"))).alias("order_delivered_customer_date"),
        _ts(F.col("o_orderdate") + F.expr(f"INTERVAL {ESTIMATED_DAYS} DAYS")).alias("order_estimated_delivery_date"))


def order_items(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _ts("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"))


def payments(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _case("l_returnflag", PAYMENT_TYPE_BY_FLAG).alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("payment_value"))


def reviews(t: Tables) -> DataFrame:
    return t["events"].select(
        F.col("user_id").cast("string").alias("review_id"),
        F.get_json_object("props", "$.k").alias("order_id"),
        (F.floor("value").cast("int") % 7).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        _ts("ts").alias("review_creation_date"),
        _ts("ts").alias("review_answer_timestamp"))


def _places(base: DataFrame, t: Tables, id_col: str, nation_col: str, prefix: str, extra: list) -> DataFrame:
    geo = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    j = base.join(geo, F.col(nation_col) == F.col("n_nationkey"), "left")
    return j.select(
        F.col(id_col).cast("string").alias(f"{prefix}_id"), *extra,
        F.col(nation_col).cast("string").alias(f"{prefix}_zip_code_prefix"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "), F.lower("r_name"), F.lit(" ")).alias(f"{prefix}_city"),
        F.lower(F.substring("r_name", 1, 2)).alias(f"{prefix}_state"))


def customers(t: Tables) -> DataFrame:
    return _places(t["customer"], t, "c_custkey", "c_nationkey", "customer",
                   [F.col("c_name").alias("customer_unique_id")])


def sellers(t: Tables) -> DataFrame:
    return _places(t["supplier"], t, "s_suppkey", "s_nationkey", "seller", [])


def products(t: Tables) -> DataFrame:
    return t["part"].select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        F.lit(None).cast("double").alias("product_height_cm"),
        F.lit(None).cast("double").alias("product_width_cm"))


def category_translation(t: Tables) -> DataFrame:
    return t["part"].select(
        F.lower("p_type").alias("product_category_name"),
        F.concat(F.lower("p_type"), F.lit("_"), F.lower(F.regexp_replace("p_brand", "Brand#", "b")))
        .alias("product_category_name_english")).distinct()


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All contract sources, lazily derived from the driver tables."""
    t = Tables(spark, sf_dir)
    return {"orders": orders(t), "order_items": order_items(t), "payments": payments(t), "reviews": reviews(t),
            "customers": customers(t), "sellers": sellers(t), "products": products(t),
            "category_translation": category_translation(t)}


def stream_events(t: Tables) -> DataFrame:
    """The events table in the stream event shape (T1); error events count as cancellations."""
    return t["events"].select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(F.col("event_type") == "error", F.lit("canceled")).otherwise(F.col("event_type")).alias("order_status"),
        _ts("ts").alias("event_time"),
        F.col("value").alias("payment_value"))
