"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator family, plus its oracle SQL.

Every query reads the driver tables under ``sf_dir`` through the stand-in mapping and runs the library operators
over the whole tables. Outputs that carry surrogate keys (xxhash64, no DuckDB counterpart) are checked on the natural
keys that they resolve to. Timestamps are returned as TIMESTAMP_NTZ so
they compare with DuckDB's zone-less TIMESTAMP.
"""
from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..operators import clean, model, quality, views
from ..sources import standin
from . import oracle
from .oracle import MS, MT, R, with_ctes


def ntz(df: DataFrame) -> DataFrame:
    """Cast every session-zone TIMESTAMP column to TIMESTAMP_NTZ (wall clock in UTC)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


class Lake:
    """Sources, silver and gold of one sf directory, built lazily (nothing runs until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.tables = standin.Tables(spark, sf_dir)
        self.src = standin.sources(spark, sf_dir)
        self._silver = self._rejected = self._gold = None

    @property
    def silver(self) -> dict[str, DataFrame]:
        if self._silver is None:
            self._silver, self._rejected = clean.clean_all(self.src)
        return self._silver

    @property
    def rejected(self) -> dict[str, DataFrame]:
        self.silver
        return self._rejected

    @property
    def gold(self) -> dict[str, DataFrame]:
        if self._gold is None:
            self._gold = model.build(self.silver)
        return self._gold

    def materialize(self, silver: list[str] | None = None, gold: bool = True,
                    columns: dict[str, tuple[str, ...]] | None = None) -> "Lake":
        """Write the named silver tables (all, if None) and, with ``gold``, the facts built from them, once each as
        Parquet in a fresh folder under the session's checkpoint directory, and continue from the written tables.
        ``columns``: the gold columns that will be read, where not all are; of the facts only these (and the keys that
        the line fact takes from the order fact) are worked out and written.

        Queries that check or catalogue many tables then shuffle and sort each table once instead of re-deriving it in
        every branch, exactly as the staged job does. Payments are not written: cleaning them is a projection that
        costs no more than reading a copy. Neither are the dimensions, which a suite reads once each. (Parquet is much
        cheaper to write and scan than a ``checkpoint()``, which stores rows with Java serialisation.)
        """
        from ..session import scratch_dir
        from ..sources.tables import TableStore
        store = TableStore(scratch_dir(self.spark, "lake"))

        def written(layer: str, name: str, df: DataFrame) -> DataFrame:
            store.write(df, layer, name)
            return store.read(self.spark, layer, name)

        def pruned(name: str, df: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
            return df if columns is None else df.select(*dict.fromkeys(columns.get(name, ()) + others))

        chosen = [n for n in self.silver if n != "payments" and (silver is None or n in silver)]
        # independent jobs of few tasks each: started together, they share the cores
        with ThreadPoolExecutor(max(1, len(chosen))) as pool:
            self._silver = self.silver | dict(zip(chosen, pool.map(lambda n: written("silver", n, self.silver[n]), chosen)))
        if gold:
            built = model.build(self._silver)
            facts = written("gold", "fact_orders", pruned("fact_orders", built["fact_orders"], model.ORDER_KEYS))
            lines = model.fact_order_items_from_facts(self._silver["order_items"], facts)
            built.update(fact_orders=facts, fact_order_items=written("gold", "fact_order_items",
                                                                     pruned("fact_order_items", lines)))
            if columns is None:
                built["mart_daily_kpis"] = written("gold", "mart_daily_kpis", model.mart_daily_kpis(facts))
            self._gold = built
        return self


MATERIALIZE_CONF = "stratum.materialize"
#: Bytes of the largest source table from which on checks read written tables.
MATERIALIZE_BYTES = 64 * 2**20


def _materializes(spark: SparkSession, sf_dir: str) -> bool:
    setting = (spark.conf.get(MATERIALIZE_CONF, "auto") or "auto").lower()
    if setting != "auto":
        return setting == "true"
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return int(str(lines._jdf.queryExecution().analyzed().stats().sizeInBytes())) >= MATERIALIZE_BYTES


def _checked_lake(spark: SparkSession, sf_dir: str, silver: list[str] | None = None, gold: bool = True,
                  columns: dict[str, tuple[str, ...]] | None = None) -> Lake:
    """The lake for queries that check or catalogue many tables. Large inputs are written once, so that every check
    scans a written table, as in the staged job; on small ones (by file sizes) deriving a table again in every check is
    quicker than writing it. ``stratum.materialize=true`` or ``false`` decides for all sizes; results are the same."""
    lake = Lake(spark, sf_dir)
    if _materializes(spark, sf_dir):
        lake.materialize(silver, gold, columns)
    return lake


def _silver_checks(spark: SparkSession, sf_dir: str, checks: list[quality.Check]) -> DataFrame:
    needed = quality.tables_of(checks)
    return quality.run_checks(_checked_lake(spark, sf_dir, needed, gold=False).silver, checks)


# --- star schema and mart ----------------------------------------------------------------------------------------

def q_mart_daily_kpis(spark, sf_dir):
    return Lake(spark, sf_dir).gold["mart_daily_kpis"]


def q_fact_orders(spark, sf_dir):
    f = Lake(spark, sf_dir).gold["fact_orders"]
    return f.select("order_id", "purchase_date_key", "order_status", "items",
                    F.round("items_value", 2).alias("items_value"), F.round("freight_value", 4).alias("freight_value"),
                    F.round("payment_value", 6).alias("payment_value"), "payment_type", "delivery_days", "is_late",
                    F.round("review_score", 3).alias("review_score"))


def q_fact_order_items(spark, sf_dir):
    f = Lake(spark, sf_dir).gold["fact_order_items"]
    return f.select("order_id", "order_item_id", "purchase_date_key", "price", "freight_value")


def q_dim_date(spark, sf_dir):
    return Lake(spark, sf_dir).gold["dim_date"]


def q_dim_customer(spark, sf_dir):
    return Lake(spark, sf_dir).gold["dim_customer"].drop("customer_key")


def q_dim_seller(spark, sf_dir):
    return Lake(spark, sf_dir).gold["dim_seller"].drop("seller_key")


def q_dim_product(spark, sf_dir):
    return Lake(spark, sf_dir).gold["dim_product"].drop("product_key")


def q_surrogate_keys(spark, sf_dir):
    """The line fact joined with its dimensions on the surrogate keys; what comes back are natural keys. A key that
    stood for two members would double a line, one that differed between fact and dimension would lose its member."""
    g = Lake(spark, sf_dir).gold
    return (g["fact_order_items"].join(g["dim_product"].select("product_key", "product_id"), "product_key", "left")
            .join(g["dim_seller"].select("seller_key", "seller_id"), "seller_key", "left")
            .join(g["dim_customer"].select("customer_key", "customer_unique_id"), "customer_key", "left")
            .select("order_id", "order_item_id", "product_id", "seller_id", "customer_unique_id"))


def _published(spark, sf_dir, names):
    """The named gold tables written and published in schemas of their own, and a second session to read them in."""
    from ..session import scratch_dir, sibling_session
    from ..sources.tables import TableStore
    from ..sources.warehouse import Layout, Warehouse
    root = scratch_dir(spark, "warehouse")
    tag = root.rsplit("-", 1)[1]
    house = Warehouse(TableStore(root), f"gold_{tag}", f"analytics_{tag}")
    gold = Lake(spark, sf_dir).gold
    for n in names:
        house.store.write(gold[n], "gold", n)
    house.publish(spark, {n: Layout() for n in names}, views.VIEW_SQL)
    return house, sibling_session(spark)


def q_warehouse_revenue(spark, sf_dir):
    """The persistent monthly view, read by name in a second session."""
    house, other = _published(spark, sf_dir, ("fact_orders", "dim_date"))
    return house.view(other, "v_monthly_revenue")


def q_monthly_revenue(spark, sf_dir):
    return views.create_views(spark, Lake(spark, sf_dir).gold)["v_monthly_revenue"]


def q_category_performance(spark, sf_dir):
    return views.create_views(spark, Lake(spark, sf_dir).gold)["v_category_performance"]


def q_customers_masked(spark, sf_dir):
    """The persistent masked view, read by name in a second session; its surrogate key is resolved to the natural one."""
    house, other = _published(spark, sf_dir, ("dim_customer",))
    people = house.table(other, "dim_customer").select("customer_key", "customer_unique_id")
    view = house.view(other, "v_customers_masked")
    return view.join(people, view.customer_key.eqNullSafe(people.customer_key)).drop("customer_key")


# --- cleaning ----------------------------------------------------------------------------------------------------

def q_quarantine_split(spark, sf_dir):
    return clean.quarantine_table(Lake(spark, sf_dir).rejected).drop("record")


def q_reject_reasons(spark, sf_dir):
    q = clean.quarantine_table(Lake(spark, sf_dir).rejected)
    return q.groupBy("table", "_reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def q_dedupe_by_key(spark, sf_dir):
    return ntz(Lake(spark, sf_dir).silver["order_items"])


def q_latest_per_key(spark, sf_dir):
    return ntz(Lake(spark, sf_dir).silver["reviews"])


def q_clean_orders(spark, sf_dir):
    return ntz(Lake(spark, sf_dir).silver["orders"])


def q_standardize_places(spark, sf_dir):
    s = Lake(spark, sf_dir).silver
    cols = lambda p: [F.lit(p).alias("kind"), F.col(f"{p}_id").alias("id"),
                      F.col(f"{p}_zip_code_prefix").alias("zip"), F.col(f"{p}_city").alias("city"),
                      F.col(f"{p}_state").alias("state")]
    return s["customers"].select(*cols("customer")).unionByName(s["sellers"].select(*cols("seller")))


def q_category_coalesce(spark, sf_dir):
    return Lake(spark, sf_dir).silver["products"].select("product_id", "product_category_name", "category")


# --- quality -----------------------------------------------------------------------------------------------------

def _silver_kind(kind):
    return [c for c in quality.silver_suite() if c.kind == kind]


def _suite_query(kind):
    """Row-local checks read each table once anyway; key checks read some tables several times, so from written ones."""
    def run(spark, sf_dir):
        if kind in quality.LOCAL:
            return quality.run_checks(Lake(spark, sf_dir).silver, _silver_kind(kind))
        return _silver_checks(spark, sf_dir, _silver_kind(kind))
    return run


def q_quality_suite(spark, sf_dir):
    return _silver_checks(spark, sf_dir, quality.silver_suite())


def _contract_checks():
    from ..contracts import SOURCES
    from .jobs import SILVER
    return [c for name in SILVER for c in quality.contract_suite(SOURCES[name])]


def q_contract_checks(spark, sf_dir):
    """Checks derived from the contracts (key not null, key unique, domains) on every silver table, payments
    included."""
    return _silver_checks(spark, sf_dir, _contract_checks())


def q_gold_quality_suite(spark, sf_dir):
    checks = quality.gold_suite()
    return quality.run_checks(_checked_lake(spark, sf_dir, columns=quality.columns_of(checks)).gold, checks)


def q_quality_report(spark, sf_dir):
    checks = quality.gold_suite()
    lake = _checked_lake(spark, sf_dir, columns=quality.columns_of(checks))
    silver = quality.summarize(quality.run_checks(lake.silver, quality.silver_suite()))
    gold = quality.summarize(quality.run_checks(lake.gold, checks))
    return silver.select(F.lit("silver").alias("stage"), "*").unionByName(gold.select(F.lit("gold").alias("stage"), "*"))


# --- streaming ---------------------------------------------------------------------------------------------------

def q_hourly_windows(spark, sf_dir):
    from ..streaming.hourly import hourly_aggregate
    return ntz(hourly_aggregate(standin.stream_events(standin.Tables(spark, sf_dir))))


def q_hourly_stream(spark, sf_dir):
    from ..streaming.hourly import replay_and_aggregate
    return ntz(replay_and_aggregate(spark, Lake(spark, sf_dir).silver))


def _staged_events(spark, sf_dir) -> DataFrame:
    from ..session import scratch_dir
    from ..streaming.hourly import order_events
    path = scratch_dir(spark, "order-events")
    order_events(Lake(spark, sf_dir).silver).write.parquet(path)
    return spark.read.parquet(path)


def q_hourly_restart(spark, sf_dir):
    """The orders of two halves of the time line; the stream stops after the first and resumes from its checkpoint."""
    from ..streaming.hourly import replay_in_waves
    events = _staged_events(spark, sf_dir)
    t = F.unix_seconds("event_time")
    middle = events.agg(((F.min(t) + F.max(t)) / 2).cast("long")).first()[0]
    early = t <= F.lit(middle)
    return ntz(replay_in_waves(spark, [events.where(early), events.where(~early | F.col("event_time").isNull())]))


def q_hourly_late(spark, sf_dir):
    """A tenth of the orders arrives after all others: of these, what the watermark has passed by then is dropped."""
    from ..streaming.hourly import replay_in_waves
    events = _staged_events(spark, sf_dir)
    late = F.col("order_id").cast("long") % 10 == 0
    return ntz(replay_in_waves(spark, [events.where(~late), events.where(late)]))


# --- sampling and governance -------------------------------------------------------------------------------------

def q_sample_slice(spark, sf_dir):
    from ..operators.sample import sample_slice, slice_counts
    return slice_counts(sample_slice(Lake(spark, sf_dir).src, n=2000))


def q_catalog_tables(spark, sf_dir):
    from ..operators.governance import catalog_tables
    lake = _checked_lake(spark, sf_dir)
    return catalog_tables(lake.silver, lake.gold).drop("columns", "upstream")


def q_bronze_ingest(spark, sf_dir):
    """The sources written as contract CSV files, ingested strictly into bronze Parquet; rows and
    malformed rows per source, counted from the bronze tables."""
    from ..contracts import SOURCES
    from ..sources.files import CORRUPT, write_csv
    from ..sources.tables import TableStore
    from ..session import scratch_dir
    from .jobs import LakeJob
    root = scratch_dir(spark, "ingest")
    src = standin.sources(spark, sf_dir)
    for name, contract in SOURCES.items():
        write_csv(src[name], f"{root}/raw/{contract.file}")
    store = TableStore(f"{root}/lake")
    LakeJob(spark, store, raw_dir=f"{root}/raw").bronze()
    parts = [store.read(spark, "bronze", n).agg(F.count(F.lit(1)).alias("rows"),
                                                F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"))
             .select(F.lit(n).alias("table"), "rows", "malformed") for n in SOURCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mart_daily_kpis": q_mart_daily_kpis,
    "fact_orders": q_fact_orders,
    "fact_order_items": q_fact_order_items,
    "dim_date": q_dim_date,
    "dim_customer": q_dim_customer,
    "dim_seller": q_dim_seller,
    "dim_product": q_dim_product,
    "surrogate_keys": q_surrogate_keys,
    "monthly_revenue": q_monthly_revenue,
    "category_performance": q_category_performance,
    "customers_masked": q_customers_masked,
    "warehouse_revenue": q_warehouse_revenue,
    "quarantine_split": q_quarantine_split,
    "reject_reasons": q_reject_reasons,
    "clean_orders": q_clean_orders,
    "dedupe_by_key": q_dedupe_by_key,
    "latest_per_key": q_latest_per_key,
    "standardize_places": q_standardize_places,
    "category_coalesce": q_category_coalesce,
    "check_not_null": _suite_query("not_null"),
    "check_unique": _suite_query("unique"),
    "check_references": _suite_query("fk"),
    "check_accepted": _suite_query("accepted"),
    "check_range": _suite_query("range"),
    "quality_suite": q_quality_suite,
    "contract_checks": q_contract_checks,
    "gold_quality_suite": q_gold_quality_suite,
    "quality_report": q_quality_report,
    "hourly_windows": q_hourly_windows,
    "hourly_stream": q_hourly_stream,
    "hourly_restart": q_hourly_restart,
    "hourly_late": q_hourly_late,
    "sample_slice": q_sample_slice,
    "catalog_tables": q_catalog_tables,
    "bronze_ingest": q_bronze_ingest,
}


# --- oracle SQL --------------------------------------------------------------------------------------------------

def _suite_kind_sql(kind):
    return oracle.suite_sql(_silver_kind(kind), oracle.SILVER_VIEWS)


def _quality_report_sql() -> str:
    def summary(stage, checks, views_, nat=None):
        body = "\nUNION ALL\n".join(oracle.check_sql(c, views_, nat) for c in checks)
        return (f"SELECT {oracle._q(stage)} AS stage, CAST(count(*) AS BIGINT) AS checks, "
                f"CAST(count_if(failed <> 0 AND severity = 'error') AS BIGINT) AS failed_errors, "
                f"CAST(count_if(failed <> 0 AND severity = 'warn') AS BIGINT) AS warnings FROM ({body})")
    return with_ctes(summary("silver", quality.silver_suite(), oracle.SILVER_VIEWS) + "\nUNION ALL\n"
                     + summary("gold", quality.gold_suite(), oracle.GOLD_VIEWS, oracle.GOLD_NATURAL))


def _quarantine_sql() -> str:
    parts = []
    for name, flag in (("orders", "o_flag"), ("order_items", "i_flag"), ("payments", "p_flag"), ("reviews", "r_flag")):
        keys = clean.QUARANTINE_KEYS[name]
        full = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
        parts.append(f"SELECT '{name}' AS \"table\", CAST({keys[0]} AS VARCHAR) AS key, "
                     f"concat_ws('|', {full}) AS full_key, _reject_reason FROM {flag} WHERE _reject_reason IS NOT NULL")
    return "\nUNION ALL\n".join(parts)


def _hourly_sql(source: str, ts: str, status: str, value: str) -> str:
    return f"""
        SELECT date_trunc('hour', {ts}) AS window_start, date_trunc('hour', {ts}) + INTERVAL 1 HOUR AS window_end,
               count(*) AS orders, {MT(value)} AS revenue,
               CAST(sum(CASE WHEN {status} = 'canceled' THEN 1 ELSE 0 END) AS BIGINT) AS canceled
        FROM {source} GROUP BY 1, 2"""


_ORDER_EVENTS = ("(SELECT o.order_id, o.order_purchase_timestamp AS ts, o.order_status AS status, p.payment_value AS value "
                 f"FROM s_orders o LEFT JOIN (SELECT order_id, {MS('payment_value')} AS payment_value FROM s_payments "
                 "GROUP BY order_id) p ON o.order_id = p.order_id)")
# the watermark stands two hours before the last order of the first wave when the late tenth arrives
_LATE_EVENTS = f"""(SELECT * FROM {_ORDER_EVENTS} WHERE order_id::BIGINT % 10 <> 0 OR date_trunc('hour', ts) + INTERVAL 1 HOUR >
    (SELECT max(ts) - INTERVAL 2 HOUR FROM {_ORDER_EVENTS} WHERE order_id::BIGINT % 10 <> 0))"""


def _sample_sql(n: int = 2000) -> str:
    extra = {"so": f"""SELECT order_id, customer_id FROM src_orders
                       ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id ASC NULLS LAST LIMIT {n}""",
             "si": "SELECT * FROM src_items WHERE order_id IN (SELECT order_id FROM so)"}
    return with_ctes("""
        SELECT 'orders' AS "table", CAST(count(*) AS BIGINT) AS rows FROM so
        UNION ALL SELECT 'order_items', count(*) FROM si
        UNION ALL SELECT 'payments', count(*) FROM src_payments WHERE order_id IN (SELECT order_id FROM so)
        UNION ALL SELECT 'reviews', count(*) FROM src_reviews WHERE order_id IN (SELECT order_id FROM so)
        UNION ALL SELECT 'customers', count(*) FROM src_customers WHERE customer_id IN (SELECT customer_id FROM so)
        UNION ALL SELECT 'sellers', count(*) FROM src_sellers WHERE seller_id IN (SELECT seller_id FROM si)
        UNION ALL SELECT 'products', count(*) FROM src_products WHERE product_id IN (SELECT product_id FROM si)
        UNION ALL SELECT 'category_translation', count(*) FROM src_translation""", extra)


def _catalog_sql() -> str:
    from ..operators.governance import TABLE_SPECS, owner_of
    counts = {f"silver.{k}": v for k, v in oracle.SILVER_VIEWS.items()}
    counts.update({f"gold.{k}": v for k, v in oracle.GOLD_VIEWS.items()})
    counts["gold.mart_daily_kpis"] = "(SELECT DISTINCT purchase_date_key FROM fact_orders_nk)"
    parts = []
    for spec in TABLE_SPECS:
        full = f"{spec.layer}.{spec.name}"
        parts.append(f"SELECT '{full}' AS \"table\", '{spec.layer}' AS layer, '{owner_of(spec.name)}' AS owner, "
                     f"CAST(count(*) AS BIGINT) AS rows, {len(spec.upstream)} AS n_upstream, "
                     f"'{spec.upstream[0]}' AS first_upstream FROM {counts[full]}")
    return with_ctes("\nUNION ALL\n".join(parts))


def oracle_sql() -> dict[str, str]:
    nk = with_ctes
    return {
        "mart_daily_kpis": nk(f"""
            SELECT purchase_date_key, count(*) AS orders, {MT('payment_value')} AS revenue,
                   {R('avg(CAST(is_late AS INTEGER))', 4)} AS late_share,
                   {R("avg(CAST(order_status IS NOT DISTINCT FROM 'canceled' AS INTEGER))", 4)} AS cancel_share,
                   {R('avg(CAST(review_score AS DECIMAL(20,12)))', 3)} AS avg_review
            FROM fact_orders_nk GROUP BY purchase_date_key"""),
        "fact_orders": nk(f"""
            SELECT order_id, purchase_date_key, order_status, items, {R('items_value', 2)} AS items_value,
                   {R('freight_value', 4)} AS freight_value, {R('payment_value', 6)} AS payment_value, payment_type,
                   delivery_days, is_late, {R('review_score', 3)} AS review_score
            FROM fact_orders_nk"""),
        "fact_order_items": nk("SELECT order_id, order_item_id, purchase_date_key, price, freight_value FROM fact_items_nk"),
        "surrogate_keys": nk("""
            SELECT order_id, order_item_id, product_id, seller_id, customer_unique_id FROM fact_items_nk"""),
        "customers_masked": nk("SELECT * FROM dim_customer_nk"),
        "dim_date": nk("SELECT * FROM dim_date_nk"),
        "dim_customer": nk("SELECT * FROM dim_customer_nk"),
        "dim_seller": nk("SELECT * FROM dim_seller_nk"),
        "dim_product": nk("SELECT * FROM dim_product_nk"),
        "monthly_revenue": nk(f"""
            SELECT d.year, d.month, count(*) AS orders, {MT('f.payment_value')} AS revenue,
                   {R('avg(CASE WHEN f.is_late THEN 1 ELSE 0 END)', 4)} AS late_share
            FROM fact_orders_nk f JOIN dim_date_nk d ON d.date_key = f.purchase_date_key
            GROUP BY d.year, d.month"""),
        "warehouse_revenue": nk(f"""
            SELECT d.year, d.month, count(*) AS orders, {MT('f.payment_value')} AS revenue,
                   {R('avg(CASE WHEN f.is_late THEN 1 ELSE 0 END)', 4)} AS late_share
            FROM fact_orders_nk f JOIN dim_date_nk d ON d.date_key = f.purchase_date_key
            GROUP BY d.year, d.month"""),
        "category_performance": nk(f"""
            SELECT p.category, count(*) AS items, {MT('i.price')} AS revenue,
                   CAST(rank() OVER (ORDER BY sum(CAST(i.price AS DECIMAL(18,6))) DESC) AS INTEGER) AS revenue_rank
            FROM fact_items_nk i JOIN dim_product_nk p ON i.product_id = p.product_id
            GROUP BY p.category"""),
        "quarantine_split": nk(_quarantine_sql()),
        "reject_reasons": nk(f"""SELECT "table", _reject_reason, count(*) AS rows FROM ({_quarantine_sql()})
                                  GROUP BY "table", _reject_reason"""),
        "clean_orders": nk("SELECT * FROM s_orders"),
        "dedupe_by_key": nk("SELECT * FROM s_items"),
        "latest_per_key": nk("SELECT * FROM s_reviews"),
        "standardize_places": nk("""
            SELECT 'customer' AS kind, customer_id AS id, customer_zip_code_prefix AS zip, customer_city AS city,
                   customer_state AS state FROM s_customers
            UNION ALL
            SELECT 'seller', seller_id, seller_zip_code_prefix, seller_city, seller_state FROM s_sellers"""),
        "category_coalesce": nk("SELECT product_id, product_category_name, category FROM s_products"),
        "check_not_null": _suite_kind_sql("not_null"),
        "check_unique": _suite_kind_sql("unique"),
        "check_references": _suite_kind_sql("fk"),
        "check_accepted": _suite_kind_sql("accepted"),
        "check_range": _suite_kind_sql("range"),
        "quality_suite": oracle.silver_suite_sql(),
        "contract_checks": oracle.suite_sql(_contract_checks(), oracle.SILVER_VIEWS),
        "gold_quality_suite": oracle.gold_suite_sql(),
        "quality_report": _quality_report_sql(),
        "hourly_windows": _hourly_sql("events", "ts", "CASE WHEN event_type = 'error' THEN 'canceled' ELSE event_type END",
                                      "value"),
        "hourly_stream": nk(_hourly_sql(_ORDER_EVENTS, "ts", "status", "value")),
        "hourly_restart": nk(_hourly_sql(_ORDER_EVENTS, "ts", "status", "value")),
        "hourly_late": nk(_hourly_sql(_LATE_EVENTS, "ts", "status", "value")),
        "sample_slice": _sample_sql(),
        "catalog_tables": _catalog_sql(),
        "bronze_ingest": nk("\nUNION ALL\n".join(
            f"SELECT '{n}' AS \"table\", count(*) AS rows, CAST(0 AS BIGINT) AS malformed FROM {v}"
            for n, v in (("orders", "src_orders"), ("order_items", "src_items"), ("customers", "src_customers"),
                         ("sellers", "src_sellers"), ("products", "src_products"), ("payments", "src_payments"),
                         ("reviews", "src_reviews"), ("category_translation", "src_translation")))),
    }
