"""Data contracts: schema, key, owner, PII columns and accepted values of every source table.

A contract is data, not code. The same object drives ingestion (schema, strictness), de-duplication (key),
quality checks (not-null key columns, uniqueness, accepted domains), masking and the catalog (owner, PII).
"""
from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Contract:
    name: str
    schema: str                      # Spark DDL, e.g. "id STRING, ts TIMESTAMP"
    key: tuple[str, ...]
    owner: str
    pii: frozenset[str] = field(default_factory=frozenset)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    multi_line: bool = False         # free text: quoted CSV fields may hold newlines

    @property
    def file(self) -> str:
        """Default raw file name, ``<name>.csv``; jobs accept a per-source override."""
        return f"{self.name}.csv"

    @property
    def columns(self) -> list[tuple[str, str]]:
        """(name, type) pairs parsed from the DDL (flat schemas only, as all contracts are)."""
        out = []
        for part in self.schema.split(","):
            col, typ = part.strip().split(None, 1)
            out.append((col.strip("`"), typ.strip().lower()))
        return out

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]


# ---------------------------------------------------------------------------------------------------------------
# Source contracts, accepted-value domains and owners. They must equal the reference's for results
# (column names, types, keys, owners, PII tags and domains) to line up.
# ---------------------------------------------------------------------------------------------------------------
ORDER_STATUSES = ("created", "approved", "invoiced", "processing", "shipped", "delivered", "unavailable", "canceled")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

ORDERS = Contract(
    "orders",
    "order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP, "
    "order_approved_at TIMESTAMP, order_delivered_carrier_date TIMESTAMP, "
    "order_delivered_customer_date TIMESTAMP, order_estimated_delivery_date TIMESTAMP",
    ("order_id",), "commerce", frozenset(), {"order_status": ORDER_STATUSES})
ORDER_ITEMS = Contract(
    "order_items",
    "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, shipping_limit_date TIMESTAMP, "
    "price DOUBLE, freight_value DOUBLE",
    ("order_id", "order_item_id"), "commerce")
CUSTOMERS = Contract(
    "customers",
    "customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING, customer_city STRING, "
    "customer_state STRING",
    ("customer_id",), "crm", frozenset({"customer_zip_code_prefix", "customer_city"}))
SELLERS = Contract(
    "sellers",
    "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING",
    ("seller_id",), "marketplace", frozenset({"seller_zip_code_prefix"}))
PRODUCTS = Contract(
    "products",
    "product_id STRING, product_category_name STRING, product_name_lenght INT, product_description_lenght INT, "
    "product_photos_qty INT, product_weight_g DOUBLE, product_length_cm DOUBLE, product_height_cm DOUBLE, "
    "product_width_cm DOUBLE",
    ("product_id",), "catalog")
PAYMENTS = Contract(
    "payments",
    "order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT, payment_value DOUBLE",
    ("order_id", "payment_sequential"), "finance", frozenset(), {"payment_type": PAYMENT_TYPES})
REVIEWS = Contract(
    "reviews",
    "review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
    "review_comment_message STRING, review_creation_date TIMESTAMP, review_answer_timestamp TIMESTAMP",
    ("review_id", "order_id"), "cx", frozenset({"review_comment_title", "review_comment_message"}),
    multi_line=True)
CATEGORY_TRANSLATION = Contract(
    "category_translation",
    "product_category_name STRING, product_category_name_english STRING",
    ("product_category_name",), "catalog")

SOURCES: dict[str, Contract] = {c.name: c for c in (
    ORDERS, ORDER_ITEMS, CUSTOMERS, SELLERS, PRODUCTS, PAYMENTS, REVIEWS, CATEGORY_TRANSLATION)}

# Columns added at ingestion (bronze only).
META_COLUMNS = ("_source_file", "_ingested_at")

# Stream event schema.
EVENT_SCHEMA = "order_id STRING, customer_id STRING, order_status STRING, event_time TIMESTAMP, payment_value DOUBLE"


def pii_columns(contracts=None) -> frozenset[str]:
    """PII is tagged by column name, unioned over all contracts."""
    return frozenset(c for k in (contracts or SOURCES.values()) for c in k.pii)
