"""Catalog, lineage, owners and PII tags.

Lineage and owners are declared on table specs; row counts come from the data (one aggregate per table, unioned
into one DataFrame); columns and PII flags come from the schemas and the contracts.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SOURCES, pii_columns


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    upstream: tuple[str, ...]
    entity: str | None = None      # the source contract whose owner owns this table; None: shared analytics


# Lineage of every silver and gold table (upstream tables, main input first) and the source entity
# each table belongs to (its owner comes from that entity's contract).
TABLE_SPECS = (
    TableSpec("silver", "orders", ("bronze.orders",), "orders"),
    TableSpec("silver", "order_items", ("bronze.order_items",), "order_items"),
    TableSpec("silver", "customers", ("bronze.customers",), "customers"),
    TableSpec("silver", "sellers", ("bronze.sellers",), "sellers"),
    TableSpec("silver", "products", ("bronze.products", "bronze.category_translation"), "products"),
    TableSpec("silver", "payments", ("bronze.payments",), "payments"),
    TableSpec("silver", "reviews", ("bronze.reviews",), "reviews"),
    TableSpec("gold", "dim_customer", ("silver.customers",), "customers"),
    TableSpec("gold", "dim_seller", ("silver.sellers",), "sellers"),
    TableSpec("gold", "dim_product", ("silver.products",), "products"),
    TableSpec("gold", "dim_date", ("silver.orders",)),
    TableSpec("gold", "fact_orders", ("silver.orders", "silver.customers", "silver.order_items", "silver.payments",
                                      "silver.reviews"), "orders"),
    TableSpec("gold", "fact_order_items", ("silver.order_items", "silver.orders", "silver.customers"), "order_items"),
    TableSpec("gold", "mart_daily_kpis", ("gold.fact_orders",)),
)

DEFAULT_OWNER = "analytics"


def owner_of(name: str) -> str:
    """V9: the owner of the table's entity contract; tables without one (dates, marts) belong to analytics."""
    spec = next((s for s in TABLE_SPECS if s.name == name), None)
    entity = spec.entity if spec else (name if name in SOURCES else None)
    return SOURCES[entity].owner if entity in SOURCES else DEFAULT_OWNER


def lineage_edges(spark) -> DataFrame:
    """V8 as rows (table, upstream, position)."""
    rows = [(f"{s.layer}.{s.name}", u, i) for s in TABLE_SPECS for i, u in enumerate(s.upstream)]
    return spark.createDataFrame(rows, "table STRING, upstream STRING, position INT")


def tag_pii(df: DataFrame, pii: frozenset[str] | None = None) -> DataFrame:
    """Mark PII columns in the schema itself (field metadata ``{"pii": true}``).

    The tag is stored in the Parquet footer with the schema, so it travels with the written table to every reader.
    """
    pii = pii if pii is not None else pii_columns()
    if not any(c in pii for c in df.columns):
        return df
    return df.select(*[F.col(c).alias(c, metadata={"pii": True}) if c in pii else F.col(c) for c in df.columns])


def is_pii(field, pii: frozenset[str]) -> bool:
    """A column is PII when its schema says so, or when a contract names it."""
    return bool((field.metadata or {}).get("pii")) or field.name in pii


def _columns(df: DataFrame, pii: frozenset[str]):
    return F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                              F.lit(is_pii(f, pii)).alias("pii")) for f in df.schema.fields])


def catalog_tables(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """V7: (table, layer, owner, rows, n_upstream, first_upstream, upstream, columns) per silver/gold table."""
    pii = pii_columns()
    layers = {"silver": silver, "gold": gold}
    parts = []
    for spec in TABLE_SPECS:
        df = layers[spec.layer][spec.name]
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(f"{spec.layer}.{spec.name}").alias("table"), F.lit(spec.layer).alias("layer"),
            F.lit(owner_of(spec.name)).alias("owner"), "rows",
            F.lit(len(spec.upstream)).alias("n_upstream"), F.lit(spec.upstream[0]).alias("first_upstream"),
            F.array(*[F.lit(u) for u in spec.upstream]).alias("upstream"), _columns(df, pii).alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def catalog_columns(catalog: DataFrame) -> DataFrame:
    """Columns of every table, one row each (table, name, type, pii)."""
    return catalog.select("table", F.inline("columns"))
