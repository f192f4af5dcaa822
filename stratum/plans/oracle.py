"""DuckDB SQL that recomputes each registered query independently (the correctness oracle).

The SQL restates the stand-in mapping, the cleaning rules and the model as common table expressions over the
driver's views (orders, lineitem, ...). Rounding goes through DECIMAL so it is HALF_UP on the decimal value, as
Spark's ``round`` is; ``initcap`` and the Sunday-first ``dayofweek`` are spelled out because DuckDB lacks them.
Surrogate keys (xxhash64) have no DuckDB counterpart, so oracle-checked outputs use natural keys.
"""
from __future__ import annotations

from ..contracts import ORDER_STATUSES, PAYMENT_TYPES, SOURCES
from ..operators import clean
from ..operators.quality import Check, gold_suite, silver_suite
from ..sources import standin


def R(x: str, n: int) -> str:
    """Spark's round(double): HALF_UP once on the double's shortest decimal text (DuckDB prints that text too)."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def MS(x: str) -> str:
    """Exact money sum as DOUBLE (DECIMAL(18,6) per value), as ``functions.money.money_sum``."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def MT(x: str, n: int = 2) -> str:
    """Exact money sum rounded to ``n`` decimals, as ``functions.money.money_total``."""
    return f"CAST(round(sum(CAST({x} AS DECIMAL(18,6))), {n}) AS DOUBLE)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {col} END"


def _initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _tiebreak(columns: list[str], keys: list[str], lead: list[str] = ()) -> str:
    rest = [f"{c} ASC NULLS FIRST" for c in columns if c not in keys]
    return ", ".join(list(lead) + rest)


def _first(columns: list[str], keys: list[str], lead: list[str] = ()) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {_tiebreak(columns, keys, lead)}) = 1"


def _cols(name: str) -> list[str]:
    return SOURCES[name].column_names


DAYS = standin.ESTIMATED_DAYS

CTES = {
    # --- stand-in sources --------------------------------------------------------------------------------------
    "src_orders": f"""
        SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
               {_case('o.o_orderstatus', standin.STATUS_BY_CODE)} AS order_status,
               CAST(o.o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
               CAST(o.o_orderdate AS TIMESTAMP) AS order_approved_at,
               CAST(s.first_ship AS TIMESTAMP) AS order_delivered_carrier_date,
               CAST(CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS TIMESTAMP) AS order_delivered_customer_date,
               CAST(o.o_orderdate + INTERVAL {DAYS} DAY AS TIMESTAMP) AS order_estimated_delivery_date
        FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                                 FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "src_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
    "src_payments": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
               {_case('l_returnflag', standin.PAYMENT_TYPE_BY_FLAG)} AS payment_type,
               CAST(trunc(l_quantity) AS INTEGER) AS payment_installments,
               l_extendedprice * (1 - l_discount) * (1 + l_tax) AS payment_value
        FROM lineitem""",
    "src_reviews": """
        SELECT CAST(user_id AS VARCHAR) AS review_id, json_extract_string(props, '$.k') AS order_id,
               CAST(floor(value) AS INTEGER) % 7 AS review_score, event_type AS review_comment_title,
               props AS review_comment_message, CAST(ts AS TIMESTAMP) AS review_creation_date,
               CAST(ts AS TIMESTAMP) AS review_answer_timestamp
        FROM events""",
    "src_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
               ' ' || lower(n_name) || ' ' || lower(r_name) || ' ' AS customer_city,
               lower(substr(r_name, 1, 2)) AS customer_state
        FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey""",
    "src_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
               ' ' || lower(n_name) || ' ' || lower(r_name) || ' ' AS seller_city,
               lower(substr(r_name, 1, 2)) AS seller_state
        FROM supplier LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON s_nationkey = n_nationkey""",
    "src_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(length(p_brand) AS INTEGER) AS product_description_lenght,
               p_size AS product_photos_qty, p_retailprice AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm, CAST(NULL AS DOUBLE) AS product_height_cm,
               CAST(NULL AS DOUBLE) AS product_width_cm
        FROM part""",
    "src_translation": """
        SELECT DISTINCT lower(p_type) AS product_category_name,
               lower(p_type) || '_' || lower(replace(p_brand, 'Brand#', 'b')) AS product_category_name_english
        FROM part""",
    # --- silver ------------------------------------------------------------------------------------------------
    "o_flag": f"""
        SELECT *, CASE WHEN order_id IS NULL OR order_purchase_timestamp IS NULL THEN {_q(clean.R_ORDER_MISSING)}
                       WHEN NOT (order_status IN {_in(ORDER_STATUSES)}) THEN {_q(clean.R_ORDER_STATUS)}
                       WHEN order_delivered_customer_date < order_purchase_timestamp THEN {_q(clean.R_ORDER_TIME)}
                  END AS _reject_reason
        FROM (SELECT * REPLACE (lower(trim(order_status)) AS order_status) FROM src_orders)""",
    "s_orders": f"""
        SELECT * EXCLUDE (_reject_reason),
               CAST(datediff('day', order_purchase_timestamp, order_delivered_customer_date) AS INTEGER) AS delivery_days,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late
        FROM o_flag WHERE _reject_reason IS NULL
        {_first(_cols('orders'), ['order_id'])}""",
    "i_flag": f"""
        SELECT *, CASE WHEN price < 0 OR freight_value < 0 OR product_id IS NULL THEN {_q(clean.R_ITEM)}
                  END AS _reject_reason
        FROM src_items""",
    "s_items": f"""
        SELECT * EXCLUDE (_reject_reason) FROM i_flag WHERE _reject_reason IS NULL
        {_first(_cols('order_items'), ['order_id', 'order_item_id'])}""",
    "p_flag": f"""
        SELECT *, CASE WHEN NOT (payment_type IN {_in(PAYMENT_TYPES)}) OR payment_value < 0 THEN {_q(clean.R_PAYMENT)}
                  END AS _reject_reason
        FROM src_payments""",
    "s_payments": "SELECT * EXCLUDE (_reject_reason) FROM p_flag WHERE _reject_reason IS NULL",
    "r_flag": f"""
        SELECT *, CASE WHEN NOT (review_score BETWEEN 1 AND 5) THEN {_q(clean.R_REVIEW)} END AS _reject_reason
        FROM src_reviews""",
    "s_reviews": f"""
        SELECT * EXCLUDE (_reject_reason) FROM r_flag WHERE _reject_reason IS NULL
        {_first(_cols('reviews'), ['review_id', 'order_id'], ['review_answer_timestamp DESC NULLS LAST'])}""",
    "s_customers": f"""
        SELECT customer_id, customer_unique_id, lpad(customer_zip_code_prefix, 5, '0') AS customer_zip_code_prefix,
               {_initcap('trim(customer_city)')} AS customer_city, upper(trim(customer_state)) AS customer_state
        FROM src_customers
        {_first(_cols('customers'), ['customer_id'])}""",
    "s_sellers": f"""
        SELECT seller_id, lpad(seller_zip_code_prefix, 5, '0') AS seller_zip_code_prefix,
               {_initcap('trim(seller_city)')} AS seller_city, upper(trim(seller_state)) AS seller_state
        FROM src_sellers
        {_first(_cols('sellers'), ['seller_id'])}""",
    "tr_one": f"""
        SELECT * FROM src_translation
        {_first(['product_category_name', 'product_category_name_english'], ['product_category_name'])}""",
    "s_products": f"""
        SELECT * FROM (
            SELECT p.product_category_name, p.* EXCLUDE (product_category_name),
                   coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category
            FROM src_products p LEFT JOIN tr_one t ON p.product_category_name = t.product_category_name)
        {_first(['product_category_name'] + [c for c in _cols('products') if c != 'product_category_name'] + ['category'], ['product_id'])}""",
    # --- gold (natural keys) -----------------------------------------------------------------------------------
    "g_lines": f"""
        SELECT order_id, count(*) AS items, {MS('price')} AS items_value, {MS('freight_value')} AS freight_value
        FROM s_items GROUP BY order_id""",
    "g_paid": f"""
        SELECT order_id, {MS('payment_value')} AS payment_value,
               (min({{'s': payment_sequential, 't': payment_type}})).t AS payment_type
        FROM s_payments GROUP BY order_id""",
    "g_review": "SELECT order_id, avg(review_score) AS review_score FROM s_reviews GROUP BY order_id",
    "fact_orders_nk": """
        SELECT o.order_id, c.customer_unique_id,
               CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS purchase_date_key,
               o.order_status, coalesce(l.items, 0) AS items, l.items_value, l.freight_value, p.payment_value,
               p.payment_type, o.delivery_days, o.is_late, r.review_score
        FROM s_orders o LEFT JOIN g_lines l ON o.order_id = l.order_id
             LEFT JOIN g_paid p ON o.order_id = p.order_id LEFT JOIN g_review r ON o.order_id = r.order_id
             LEFT JOIN s_customers c ON o.customer_id = c.customer_id""",
    "fact_items_nk": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, c.customer_unique_id,
               CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS purchase_date_key,
               i.price, i.freight_value
        FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
             LEFT JOIN s_customers c ON o.customer_id = c.customer_id""",
    "dim_customer_nk": f"""
        SELECT customer_unique_id, customer_city, customer_state FROM s_customers
        {_first(['customer_unique_id', 'customer_city', 'customer_state'], ['customer_unique_id'])}""",
    "dim_seller_nk": "SELECT seller_id, seller_city, seller_state FROM s_sellers",
    "dim_product_nk": "SELECT product_id, category, product_weight_g, product_photos_qty FROM s_products",
    "dim_date_nk": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(CAST(order_purchase_timestamp AS DATE)) AS lo,
                           max(CAST(order_estimated_delivery_date AS DATE)) AS hi FROM s_orders))""",
}

_DEPS_ORDER = list(CTES)


def with_ctes(select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with every CTE it (transitively) needs, in definition order, then the ``extra`` CTEs."""
    extra = extra or {}
    needed: set[str] = set()

    def visit(text: str):
        for name in _DEPS_ORDER:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(CTES[name])

    for text in [select, *extra.values()]:
        visit(text)
    parts = [f"{n} AS ({CTES[n]})" for n in _DEPS_ORDER if n in needed]
    parts += [f"{n} AS ({q})" for n, q in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b{re.escape(name)}\b", text) is not None


# --- quality suites as SQL ----------------------------------------------------------------------------------------

SILVER_VIEWS = {"orders": "s_orders", "order_items": "s_items", "customers": "s_customers", "sellers": "s_sellers",
                "products": "s_products", "reviews": "s_reviews", "payments": "s_payments"}
# Gold checks on natural keys: surrogate keys are one-to-one with them.
GOLD_VIEWS = {"dim_customer": "dim_customer_nk", "dim_seller": "dim_seller_nk", "dim_product": "dim_product_nk",
              "dim_date": "dim_date_nk", "fact_orders": "fact_orders_nk", "fact_order_items": "fact_items_nk"}
GOLD_NATURAL = {"customer_key": "customer_unique_id", "seller_key": "seller_id", "product_key": "product_id"}


def check_sql(ch: Check, views: dict[str, str], natural: dict[str, str] | None = None) -> str:
    nat = natural or {}
    t = views[ch.table]
    head = f"SELECT {_q(ch.table)} AS \"table\", {_q(ch.name)} AS name, {_q(ch.severity)} AS severity"
    scope = f"({ch.where})" if ch.where else "TRUE"
    if ch.kind in ("not_null", "accepted", "range"):
        c = ch.columns[0]
        bad = {"not_null": f"{c} IS NULL", "accepted": f"NOT ({c} IN {_in(ch.values)})",
               "range": f"NOT ({c} BETWEEN {ch.lo} AND {ch.hi})"}[ch.kind]
        return (f"{head}, CAST(count_if({scope} AND ({bad})) AS BIGINT) AS failed, "
                f"CAST(count_if({scope}) AS BIGINT) AS total FROM {t}")
    if ch.kind == "unique":
        keys = ", ".join(nat.get(k, k) for k in ch.columns)
        return (f"{head}, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS failed, "
                f"CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM (SELECT count(*) AS n FROM {t} GROUP BY {keys})")
    if ch.kind == "fk":
        c, pc = nat.get(ch.columns[0], ch.columns[0]), nat.get(ch.parent_col, ch.parent_col)
        p = views[ch.parent]
        return (f"{head}, CAST(coalesce(sum(CASE WHEN p.k IS NULL THEN c.n END), 0) AS BIGINT) AS failed, "
                f"CAST(coalesce(sum(c.n), 0) AS BIGINT) AS total "
                f"FROM (SELECT {c} AS k, count(*) AS n FROM {t} GROUP BY {c}) c "
                f"LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {p} WHERE {pc} IS NOT NULL) p ON c.k = p.k")
    raise ValueError(ch.kind)


def suite_sql(checks: list[Check], views: dict[str, str], natural: dict[str, str] | None = None) -> str:
    body = "\nUNION ALL\n".join(check_sql(ch, views, natural) for ch in checks)
    return with_ctes(f"SELECT *, failed = 0 AS passed FROM ({body})")


def silver_suite_sql() -> str:
    return suite_sql(silver_suite(), SILVER_VIEWS)


def gold_suite_sql() -> str:
    return suite_sql(gold_suite(), GOLD_VIEWS, GOLD_NATURAL)
