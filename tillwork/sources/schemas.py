"""Declared schemas of the five raw feeds, and the contract of each table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

RESCUED = "_rescued_data"
ARRIVAL = "ingesttime"
SOURCE_FILE = "file_name"
FILE_TIME = "file_time"  # when the file was last changed; ingest adds it
ORDER = "_order"  # of a cleaned row among the versions of its key
BUCKET, BATCH = "_bucket", "_batch"  # partition columns of every table
PLACE = (BUCKET, BATCH)
CLOCKS = ("_silver_processed_at", "_gold_updated_at")  # when a run wrote a row


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Column names of the raw feeds.
FEED_COLUMNS = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone",
        "address", "city", "region", "signup_date", "customer_segment",
    ],
    "crm": [
        "crm_last_updated", "customer_id", "last_campaign_engaged", "lifetime_value_estimate",
        "churn_risk_score", "loyalty_tier", "marketing_opt_in", "preferred_channel",
    ],
    "products": [
        "product_id", "product_name", "category", "subcategory", "brand", "unit_price",
        "cost_price", "stock_quantity", "reorder_threshold", "supplier_id", "created_date",
    ],
    "sales": [
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "discount_pct",
        "total_amount", "store_id", "region", "transaction_ts", "last_modified_ts",
        "payment_method",
    ],
    "clicks": [
        "customer_id", "device_type", "event_id", "event_type", "page_url", "product_id",
        "session_id", "timestamp",
    ],
}

FEED_SCHEMAS = {feed: text_schema(names) for feed, names in FEED_COLUMNS.items()}


@dataclass(frozen=True)
class Feed:
    """One raw feed: its landing folder, file format and bronze table."""

    folder: str
    file_format: str
    table: str
    options: dict[str, str]


# Landing folders, formats and bronze table names.
FEEDS = {
    "customers": Feed("sales_db/customers", "csv", "sql_customers", {"header": "true"}),
    "products": Feed("sales_db/products", "csv", "sql_products", {"header": "true"}),
    "sales": Feed(
        "sales_db/sales_transactions", "csv", "sql_sales_transactions", {"header": "true"}
    ),
    "crm": Feed("crm_api/customers", "json", "crm_customers", {"multiLine": "true"}),
    "clicks": Feed("kafka", "json", "clickstream", {}),
}


@dataclass(frozen=True)
class Contract:
    """How a table is written: mode, key columns, and columns the files are clustered by."""

    mode: str
    keys: tuple[str, ...]
    cluster: tuple[str, ...]


# Table names, write modes, keys and clustering columns. The dimensions and the
# daily report are computed in full each time and replace themselves; merging the report
# would keep groups that no longer occur after a customer or product changed.
SILVER_TABLES = {
    "sql_customers": Contract("merge", ("customer_id",), ("customer_id",)),
    "crm_customers": Contract("merge", ("customer_id",), ("customer_id",)),
    "sql_products": Contract("merge", ("product_id",), ("product_id",)),
    "sql_sales_transactions": Contract("append", ("transaction_id",), ("customer_id", "product_id")),
    "clickstream": Contract("append", ("event_id",), ("customer_id", "product_id")),
}
GOLD_TABLES = {
    "dim_customers": Contract("overwrite", ("customer_id",), ("customer_id",)),
    "dim_products": Contract("overwrite", ("product_id",), ("product_id",)),
    "fact_inventory": Contract("append", ("product_id", "_gold_updated_at"), ("product_id",)),
    "fact_sales": Contract("append", ("transaction_id",), ("customer_id", "product_id")),
    "fact_clicks": Contract("append", ("event_id",), ("customer_id",)),
    "fact_daily_sales": Contract(
        "overwrite",
        ("sales_date", "product_category", "customer_region"),
        ("sales_date", "product_category", "customer_region"),
    ),
    "fact_low_stock_alert": Contract("append", ("event_id",), ("product_id", "alert_timestamp")),
}
