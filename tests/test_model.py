"""Star schema, mart, views, masking, catalog."""
from datetime import datetime as T

import pytest
from pyspark.sql import functions as F

from stratum.functions.keys import date_key, surrogate_key
from stratum.operators import governance, model, views


def test_surrogate_key_is_type_insensitive_and_null_safe(spark):
    df = spark.createDataFrame([(1, 1, "1"), (None, None, None)], "a INT, b BIGINT, c STRING")
    rows = df.select(surrogate_key("a").alias("a"), surrogate_key("b").alias("b"), surrogate_key("c").alias("c")).collect()
    assert rows[0].a == rows[0].b == rows[0].c is not None
    assert rows[1].a is None and rows[1].c is None


def test_date_key_and_dim_date(spark):
    orders = spark.createDataFrame([(T(2018, 1, 6, 23, 30), T(2018, 1, 8))],
                                   "order_purchase_timestamp TIMESTAMP, order_estimated_delivery_date TIMESTAMP")
    d = {r.date_key: r for r in model.dim_date(orders).collect()}
    assert sorted(d) == [20180106, 20180107, 20180108]
    assert (d[20180106].day_of_week, d[20180106].is_weekend) == (7, True)    # Saturday
    assert (d[20180107].day_of_week, d[20180107].is_weekend) == (1, True)    # Sunday
    assert (d[20180108].day_of_week, d[20180108].is_weekend, d[20180108].quarter) == (2, False, 1)
    assert orders.select(date_key("order_purchase_timestamp").alias("k")).first().k == 20180106


def test_dim_date_bounds(spark):
    schema = "order_purchase_timestamp TIMESTAMP, order_estimated_delivery_date TIMESTAMP"

    def days(rows, **options):
        return sorted(r.date_key for r in model.dim_date(spark.createDataFrame(rows, schema), **options).collect())
    bought_late = [(T(2018, 2, 1), T(2018, 2, 2)), (T(2018, 2, 4), None)]
    assert days(bought_late) == [20180201, 20180202]                      # up to the last estimate
    assert days(bought_late, cover_purchases=True) == [20180201, 20180202, 20180203, 20180204]
    assert days([(T(2018, 3, 2), T(2018, 2, 28))]) == [20180228, 20180301, 20180302]      # the ends the other way round
    assert days([(T(2018, 3, 2), None)]) == [] == days([(None, None)]) == days([])


def _silver(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", T(2018, 1, 1), T(2018, 1, 11), T(2018, 1, 8), 10, True),
        ("o2", "c2", "canceled", T(2018, 1, 1), None, T(2018, 1, 8), None, None),
        ("o3", "c3", None, T(2018, 1, 2), None, T(2018, 1, 9), None, None),       # no lines, no payments
    ], "order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP, "
       "order_delivered_customer_date TIMESTAMP, order_estimated_delivery_date TIMESTAMP, delivery_days INT, "
       "is_late BOOLEAN")
    customers = spark.createDataFrame([("c1", "u1", "Sp", "SP"), ("c2", "u1", "Rio", "RJ"), ("c3", "u3", "X", "Y")],
                                      "customer_id STRING, customer_unique_id STRING, customer_city STRING, "
                                      "customer_state STRING")
    items = spark.createDataFrame([("o1", 1, "p1", "s1", 10.0, 1.0), ("o1", 2, "p2", "s1", 5.0, 0.5),
                                   ("o2", 1, "p1", "s1", 7.0, 0.0), ("o9", 1, "p1", "s1", 1.0, 0.0)],
                                  "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
                                  "price DOUBLE, freight_value DOUBLE")
    payments = spark.createDataFrame([("o1", 2, "voucher", 5.0), ("o1", 1, "boleto", 10.0), ("o2", 1, "boleto", 7.0)],
                                     "order_id STRING, payment_sequential INT, payment_type STRING, payment_value DOUBLE")
    reviews = spark.createDataFrame([("o1", 4), ("o1", 5), ("o2", 1)], "order_id STRING, review_score INT")
    return orders, customers, items, payments, reviews


def test_fact_orders_keeps_every_order_and_rolls_up_before_joining(spark):
    orders, customers, items, payments, reviews = _silver(spark)
    f = {r.order_id: r for r in model.fact_orders(orders, customers, items, payments, reviews).collect()}
    assert set(f) == {"o1", "o2", "o3"}
    assert (f["o1"].items, f["o1"].items_value, f["o1"].payment_value, f["o1"].payment_type, f["o1"].review_score) == \
        (2, 15.0, 15.0, "boleto", 4.5)
    assert (f["o3"].items, f["o3"].items_value, f["o3"].payment_value, f["o3"].review_score) == (0, None, None, None)
    assert f["o1"].customer_key == f["o2"].customer_key          # same person (u1)
    assert f["o1"].purchase_date_key == 20180101


def test_fact_order_items_drops_lines_without_an_order(spark):
    orders, customers, items, _, _ = _silver(spark)
    fi = model.fact_order_items(items, orders, customers)
    assert sorted((r.order_id, r.order_item_id) for r in fi.collect()) == [("o1", 1), ("o1", 2), ("o2", 1)]


def test_mart_shares_treat_null_is_late_and_null_status_as_documented(spark):
    orders, customers, items, payments, reviews = _silver(spark)
    facts = model.fact_orders(orders, customers, items, payments, reviews)
    m = {r.purchase_date_key: r for r in model.mart_daily_kpis(facts).collect()}
    d1 = m[20180101]
    assert (d1.orders, d1.revenue, d1.late_share, d1.cancel_share, d1.avg_review) == (2, 22.0, 1.0, 0.5, 2.75)
    d2 = m[20180102]
    assert (d2.orders, d2.late_share, d2.cancel_share, d2.avg_review) == (1, None, 0.0, None)


def test_views_late_share_counts_undelivered_as_on_time_and_masks_pii(spark):
    orders, customers, items, payments, reviews = _silver(spark)
    facts = model.fact_orders(orders, customers, items, payments, reviews)
    dates = model.dim_date(orders)
    gold = {"fact_orders": facts, "dim_date": dates, "dim_customer": model.dim_customer(customers),
            "fact_order_items": model.fact_order_items(items, orders, customers),
            "dim_product": model.dim_product(spark.createDataFrame(
                [("p1", "toys", 1.0, 1), ("p2", "books", 1.0, 1)],
                "product_id STRING, category STRING, product_weight_g DOUBLE, product_photos_qty INT"))}
    v = views.create_views(spark, gold)
    m = v["v_monthly_revenue"].first()
    assert (m.year, m.month, m.orders, m.late_share) == (2018, 1, 3, 0.3333)
    assert views.monthly_revenue(facts, dates).first().late_share == 0.3333
    cats = {r.category: (r.items, r.revenue, r.revenue_rank) for r in v["v_category_performance"].collect()}
    assert cats == {"toys": (2, 17.0, 1), "books": (1, 5.0, 2)}
    assert views.category_performance(gold["fact_order_items"], gold["dim_product"]).count() == 2
    cols = [c for c, _ in views.describe(v["v_customers_masked"])]
    assert cols == ["customer_key", "customer_city", "customer_state"]
    assert views.query(spark, "SELECT count(*) AS n FROM v_customers_masked").first().n == 2


def test_contract_masking_drops_or_hashes_pii(spark):
    df = spark.createDataFrame([("c1", "01234", "Sao Paulo", "SP")],
                               "customer_id STRING, customer_zip_code_prefix STRING, customer_city STRING, "
                               "customer_state STRING")
    assert views.mask(df).columns == ["customer_id", "customer_state"]
    hashed = views.mask(df, {"customer_zip_code_prefix": "hash"}, keep=("customer_city",)).first()
    assert len(hashed.customer_zip_code_prefix) == 64 and hashed.customer_city == "Sao Paulo"
    salted = views.mask(df, {"customer_zip_code_prefix": "hash"}, salt="s3cret").first()
    assert salted.customer_zip_code_prefix != hashed.customer_zip_code_prefix


def test_owner_resolution_and_lineage(spark):
    assert governance.owner_of("orders") == "commerce"
    assert governance.owner_of("dim_customer") == "crm"
    assert governance.owner_of("fact_order_items") == "commerce"
    assert governance.owner_of("dim_date") == "analytics"
    edges = governance.lineage_edges(spark)
    first = edges.filter((F.col("table") == "gold.fact_orders") & (F.col("position") == 0)).first()
    assert first.upstream == "silver.orders"


def test_broadcast_hint_only_with_a_proven_row_bound(spark):
    from stratum.operators.joins import broadcast_if_bounded
    small = spark.range(10)
    big = spark.range(1000)
    assert "broadcast" in str(broadcast_if_bounded(small, max_rows=100)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(broadcast_if_bounded(big, max_rows=100)._jdf.queryExecution().logical()).lower()


def test_money_sums_do_not_depend_on_partitioning(spark):
    from stratum.functions.money import money_total
    # 0.1 + 0.2 + ... in different orders gives different doubles; the exact decimal sum does not
    vals = [(0.1,), (0.2,), (0.3,), (1e6 + 0.005,), (0.015,)] * 200
    df = spark.createDataFrame(vals, "v DOUBLE")
    totals = {df.repartition(n).agg(money_total("v").alias("t")).first().t for n in (1, 3, 7, 16)}
    assert totals == {200000124.0}


def test_money_totals_fall_back_to_doubles_for_nan_and_huge_values(spark):
    from stratum.functions.money import money_sum, money_total
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", 2e12), ("b", 1.0), ("c", 0.1), ("c", 0.2)],
                               "k STRING, v DOUBLE")
    out = {r.k: (r.s, r.t) for r in df.groupBy("k").agg(money_sum("v").alias("s"),
                                                          money_total("v").alias("t")).collect()}
    assert out["a"][0] != out["a"][0]                     # NaN poisons the total, as a double sum does
    assert out["b"] == (2e12 + 1.0, 2e12 + 1.0)           # beyond the decimal range: no abort, double sum
    assert out["c"] == (0.3, 0.3)                         # exact: 0.1 + 0.2 is 0.3, not 0.30000000000000004


def test_category_rank_uses_exact_totals(spark):
    # the exact totals differ by 1e-6, but both double sums round to the same double near 1e10
    items = spark.createDataFrame([("a", 9999999999.0), ("a", 0.000001), ("b", 9999999999.0), ("b", 0.000002)],
                                  "product_key STRING, price DOUBLE")
    products = spark.createDataFrame([("a", "x"), ("b", "y")], "product_key STRING, category STRING")
    ranks = {r.category: r.revenue_rank for r in views.category_performance(items, products).collect()}
    assert ranks == {"y": 1, "x": 2}


def test_encoded_first_payment_matches_the_generic_rollup(spark):
    from stratum.contracts import PAYMENT_TYPES
    rows = [("o1", 2, "voucher"), ("o1", 1, "boleto"), ("o1", 1, "credit_card"), ("o2", 3, None), ("o2", 3, "boleto"),
            ("o3", None, "voucher"), ("o3", 1, "boleto"), ("o4", 5, None), ("o5", 2, "debit_card")]
    df = spark.createDataFrame([(o, s, t, 1.0) for o, s, t in rows],
                               "order_id STRING, payment_sequential INT, payment_type STRING, payment_value DOUBLE")
    generic = {r.order_id: r.payment_type for r in model.payment_rollup(df).collect()}
    encoded = {r.order_id: r.payment_type for r in model.payment_rollup(df, PAYMENT_TYPES).collect()}
    assert encoded == generic == {"o1": "boleto", "o2": None, "o3": "voucher", "o4": None, "o5": "debit_card"}
    bad = df.union(spark.createDataFrame([("o9", 1, "pix", 1.0)], df.schema))
    with pytest.raises(Exception, match="outside the declared domain"):
        model.payment_rollup(bad, PAYMENT_TYPES).collect()


def test_category_rank_puts_huge_and_nan_revenue_first(spark):
    from stratum.operators.views import category_performance
    items = spark.createDataFrame([(1, 2e12), (2, 11.0), (3, float("nan")), (4, 5.0), (5, 5.0), (6, None)],
                                  "product_key long, price double")
    products = spark.createDataFrame([(1, "big"), (2, "small"), (3, "nan"), (4, "a"), (5, "b"), (6, "none")],
                                     "product_key long, category string")
    ranks = {r["category"]: r["revenue_rank"] for r in category_performance(items, products).collect()}
    assert ranks == {"nan": 1, "big": 2, "small": 3, "a": 4, "b": 4, "none": 6}


def test_small_amounts_keep_their_digits(spark):
    from stratum.functions.money import money_sum
    df = spark.range(10).selectExpr("4e-7D AS v", "cast(id AS double) + 0.25D AS w")
    r = df.agg(money_sum("v").alias("v"), money_sum("w").alias("w")).first()
    assert abs(r.v - 4e-6) < 1e-15 and r.w == 47.5


def test_payment_domains_of_any_size(spark):
    types = tuple(f"t{i:02d}" for i in range(20))
    pay = spark.createDataFrame([("o", 2, "t01", 1.0), ("o", 1, "t19", 2.0)],
                                "order_id string, payment_sequential int, payment_type string, payment_value double")
    r = model.payment_rollup(pay, types).first()
    assert (r.payment_type, r.payment_value) == ("t19", 3.0)


def test_ad_hoc_sql_is_read_only(spark):
    spark.range(3).createOrReplaceTempView("ad_hoc_numbers")
    rows = views.query(spark, "WITH x AS (SELECT id FROM ad_hoc_numbers) SELECT id FROM x ORDER BY id DESC; ").collect()
    assert [r.id for r in rows] == [2, 1, 0]
    for statement in ("CREATE TABLE ad_hoc_t (a int) USING parquet", "DROP VIEW ad_hoc_numbers",
                      "INSERT INTO ad_hoc_numbers VALUES (1)", "SET spark.sql.ansi.enabled=false"):
        with pytest.raises(Exception):
            views.query(spark, statement)
    assert spark.table("ad_hoc_numbers").count() == 3
