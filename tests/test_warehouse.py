"""The durable warehouse: schemas of the catalog, persistent views, a manifest that another application attaches."""
import pytest
from pyspark.sql import functions as F

from stratum.operators import model, views
from stratum.plans.registry import Lake
from stratum.session import sibling_session
from stratum.sources.tables import TableStore
from stratum.sources.warehouse import Layout, Warehouse

SF_SMALL = "/root/testdata/sf0.001"
NUMBER = iter(range(1000))


def lake(spark, root, names=model.GOLD_TABLES, **layouts):
    """A written gold layer and its warehouse, in schemas that no other test uses."""
    store = TableStore(f"file://{root}/lake")
    gold = Lake(spark, SF_SMALL).gold
    for n in names:
        store.write(gold[n], "gold", n, partition_by=list(layouts[n].partition_by) or None if n in layouts else None)
    k = next(NUMBER)
    house = Warehouse(store, f"gold_t{k}", f"analytics_t{k}")
    return house, {n: layouts.get(n, Layout()) for n in names}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_persistent_views_equal_their_functions_in_a_second_session(spark, tmp_root):
    house, layouts = lake(spark, tmp_root)
    done = house.publish(spark, layouts, views.VIEW_SQL)
    assert len(done["table"]) == 7 and len(done["view"]) == 3
    other = sibling_session(spark)
    assert not [t for t in other.catalog.listTables() if t.isTemporary and t.name in views.VIEW_SQL]
    g = {n: house.table(other, n) for n in model.GOLD_TABLES}
    assert rows(house.view(other, "v_monthly_revenue")) == rows(views.monthly_revenue(g["fact_orders"], g["dim_date"]))
    assert rows(house.view(other, "v_category_performance")) == rows(
        views.category_performance(g["fact_order_items"], g["dim_product"]))
    masked = house.view(other, "v_customers_masked")
    assert masked.columns == ["customer_key", "customer_city", "customer_state"]
    assert masked.count() == g["dim_customer"].count() == house.counts(other, ["dim_customer"])["dim_customer"]


def test_a_lost_catalog_is_attached_again_from_the_manifest(spark, tmp_root):
    house, layouts = lake(spark, tmp_root)
    house.publish(spark, layouts, views.VIEW_SQL)
    before = rows(house.view(spark, "v_monthly_revenue"))
    for schema in (house.analytics_schema, house.gold_schema):       # as in an application without that metastore
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
    done = house.attach(sibling_session(spark))
    assert len(done["table"]) == 7 and rows(house.view(spark, "v_monthly_revenue")) == before


def test_publishing_again_shows_new_rows_and_new_columns(spark, tmp_root):
    house, layouts = lake(spark, tmp_root, ("dim_customer",))
    assert house.publish(spark, layouts, views.VIEW_SQL)["view"] == [f"{house.analytics_schema}.v_customers_masked"]
    n = house.view(spark, "v_customers_masked").count()
    more = house.table(spark, "dim_customer").limit(3).withColumn("customer_key", -F.monotonically_increasing_id())
    house.store.write(more, "gold", "dim_customer", mode="append")
    house.publish(spark, layouts, views.VIEW_SQL)
    assert house.view(spark, "v_customers_masked").count() == n + 3
    wider = spark.read.parquet(house.store.path("gold", "dim_customer")).withColumn("vip", F.lit(True))
    house.store.rewrite(wider, "gold", "dim_customer")
    house.publish(spark, layouts, views.VIEW_SQL)
    assert "vip" in house.table(spark, "dim_customer").columns and house.view(spark, "v_customers_masked").count() == n + 3


def test_partitioned_tables_keep_their_partitions_and_prune(spark, tmp_root):
    part = Layout(partition_by=("purchase_date_key",))
    house, layouts = lake(spark, tmp_root, ("fact_orders",), fact_orders=part)
    house.publish(spark, layouts, {})
    table = house.table(spark, "fact_orders")
    day = table.agg(F.min("purchase_date_key")).first()[0]
    one = table.where(F.col("purchase_date_key") == day)
    assert one.count() == spark.read.parquet(house.store.path("gold", "fact_orders")).where(f"purchase_date_key = {day}").count() > 0
    assert "PartitionFilters: [isnotnull(purchase_date_key" in one._jdf.queryExecution().toString()


def test_another_lakes_schema_is_refused_and_left_alone(spark, tmp_root):
    house, layouts = lake(spark, f"{tmp_root}/a", ("dim_customer",))
    house.publish(spark, layouts, views.VIEW_SQL)
    second, layouts = lake(spark, f"{tmp_root}/b", ("dim_customer",))
    thief = Warehouse(second.store, house.gold_schema, house.analytics_schema)
    with pytest.raises(ValueError, match="another lake"):
        thief.publish(spark, layouts, views.VIEW_SQL)
    assert house.table(spark, "dim_customer").inputFiles()[0].startswith(house.store.path("gold", "dim_customer"))
