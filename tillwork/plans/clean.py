"""Raw feed -> clean table, one function per feed.

Keys are normalised before the latest row is picked, so ``c1 `` and ``C1`` are one
key. The row-wise part of each feed is a function of its own where a stream needs it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillwork.functions import (
    cast_to_boolean,
    cast_to_decimal,
    cast_to_integer,
    clean_email,
    clean_text_standard,
    format_phone_e164,
    full_name,
    is_device_allowed,
    is_event_allowed,
    is_margin_positive,
    is_pricing_correct,
    is_reorder_needed,
    is_time_valid,
    is_verified_email,
    lower_trim,
    null_text,
    search_term,
    standardize_date,
    trim_only,
    upper_trim,
)
from tillwork.operators.dedup import latest_per_key
from tillwork.sources.schemas import ARRIVAL, FILE_TIME, ORDER, RESCUED, SOURCE_FILE
from tillwork.sources.tables import Stage, latest_in_files

# Origin tag of each clean table.
RECORD_SOURCES = {
    "customers": "SQL_SERVER_CUSTOMERS",
    "crm": "CRM_SYSTEM_CUSTOMERS",
    "products": "SQL_SERVER_PRODUCTS",
    "sales": "SQL_SERVER_SALES",
    "clicks": "WEB_CLICKSTREAM",
}

# The key of each feed, and what orders the versions of a key.
VERSIONS = {
    "customers": ("customer_id", (ARRIVAL,)),
    "crm": ("customer_id", (ARRIVAL,)),
    "products": ("product_id", (ARRIVAL,)),
    "sales": ("transaction_id", ("last_modified_ts", ARRIVAL)),
    "clicks": ("event_id", (ARRIVAL,)),
}


def with_normalised_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, upper_trim(key))


def version_order(columns: Sequence[str], key: str, order_by: Sequence[str]) -> tuple[list[str], list[str]]:
    """The columns that order the versions of a key, and those that decide ties.

    Where ingest noted the files' times they stand for the arrival: two files that one run
    brings in have the same arrival, but the later file is the newer one. File time and name
    also order rows of different batches, however the files were cut into batches.
    """
    lineage = (ARRIVAL, SOURCE_FILE, RESCUED, FILE_TIME)
    content = sorted(n for n in columns if n not in (key, *order_by, *lineage))
    if FILE_TIME in columns:
        return [FILE_TIME if n == ARRIVAL else n for n in order_by] + [SOURCE_FILE], content
    return list(order_by), [*content, SOURCE_FILE]


def latest_rows(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Latest row per normalised key. Ties go by content, the source file comes last."""
    order, ties = version_order(df.columns, key, order_by)
    return latest_per_key(with_normalised_key(df, key), [key], order, ties)


def with_audit(df: DataFrame, feed: str) -> DataFrame:
    """Arrival, source file, origin and processing time; the raw audit columns go.

    Rows with a file time keep their place among the versions of their key as ORDER.
    """
    if FILE_TIME in df.columns:
        modified = F.col("last_modified_ts") if feed == "sales" else F.lit(None).cast("string")
        place = F.struct(modified.alias("modified"), F.col(FILE_TIME).alias("filed"), F.col(SOURCE_FILE).alias("file"))
        df = df.withColumn(ORDER, place).drop(FILE_TIME)
    return df.withColumns(
        {
            "_ingest_timestamp": standardize_date(ARRIVAL),
            "_source_file": F.col(SOURCE_FILE),
            "_record_source": F.lit(RECORD_SOURCES[feed]),
            "_silver_processed_at": F.current_timestamp(),
        }
    ).drop(ARRIVAL, SOURCE_FILE, RESCUED)


def bronze_sql_customers_silver(df_bronze: DataFrame) -> DataFrame:
    """Customers of the sales database."""
    return customer_columns(latest_rows(df_bronze, *VERSIONS["customers"]))


def customer_columns(latest: DataFrame) -> DataFrame:
    """Row-wise part of the cleaning, of rows with normalised keys."""
    cleaned = latest.withColumns(
        {
            **{
                name: clean_text_standard(name)
                for name in ("first_name", "last_name", "city", "customer_segment")
            },
            "address": clean_text_standard("address", enforce_title_case=False),
            "region": clean_text_standard("region", is_acronym=True),
            "email": clean_email("email"),
            "cleaned_phone": format_phone_e164("phone"),
            "join_timestamp": standardize_date("signup_date"),
        }
    )
    flagged = cleaned.withColumns(
        {
            "full_name": full_name("first_name", "last_name"),
            "verified_email": is_verified_email("email"),
            # A cleaned number is in a form the phone check accepts, or null.
            "verified_phone": F.col("cleaned_phone").isNotNull(),
        }
    )
    return with_audit(flagged, "customers").drop("phone", "signup_date")


def bronze_crm_customers_silver(df_bronze: DataFrame) -> DataFrame:
    """Customer profiles of the CRM system."""
    return crm_columns(latest_rows(df_bronze, *VERSIONS["crm"]))


def crm_columns(latest: DataFrame) -> DataFrame:
    """Row-wise part of the cleaning, of rows with normalised keys."""
    cleaned = latest.withColumns(
        {
            **{
                name: clean_text_standard(name)
                for name in ("last_campaign_engaged", "loyalty_tier", "preferred_channel")
            },
            "lifetime_value_estimate": cast_to_decimal("lifetime_value_estimate", 10, 2),
            "churn_risk_score": cast_to_decimal("churn_risk_score", 5, 3),
            "marketing_opt_in": cast_to_boolean("marketing_opt_in"),
            "last_updated_crm": standardize_date("crm_last_updated"),
        }
    )
    return with_audit(cleaned, "crm").drop("crm_last_updated")


def bronze_sql_products_silver(df_bronze: DataFrame) -> DataFrame:
    """Product catalogue with prices and stock."""
    return product_columns(latest_rows(df_bronze, *VERSIONS["products"]))


def product_columns(latest: DataFrame) -> DataFrame:
    """Row-wise part of the cleaning, of rows with normalised keys."""
    cleaned = latest.withColumns(
        {
            **{name: clean_text_standard(name) for name in ("product_name", "category", "subcategory")},
            "brand": clean_text_standard("brand", enforce_title_case=False),
            **{name: cast_to_decimal(name, 10, 2) for name in ("unit_price", "cost_price")},
            **{name: cast_to_integer(name) for name in ("stock_quantity", "reorder_threshold")},
            "supplier_id": upper_trim("supplier_id"),
            "created_date": standardize_date("created_date"),
        }
    )
    flagged = cleaned.withColumns(
        {
            "is_margin_positive": is_margin_positive("unit_price", "cost_price"),
            "is_reorder_needed": is_reorder_needed("stock_quantity", "reorder_threshold"),
        }
    )
    return with_audit(flagged, "products")


def bronze_sql_sale_transactions(df_bronze: DataFrame) -> DataFrame:
    """Sale lines. The discount is a fraction and is rounded to two places first."""
    return sale_columns(latest_rows(df_bronze, *VERSIONS["sales"]))


def sale_columns(latest: DataFrame) -> DataFrame:
    """Row-wise part of the cleaning, of rows with normalised keys."""
    cleaned = latest.withColumns(
        {
            **{
                name: upper_trim(name)
                for name in ("customer_id", "product_id", "store_id", "payment_method")
            },
            "quantity": cast_to_integer("quantity"),
            **{
                name: cast_to_decimal(name, 10, 2)
                for name in ("unit_price", "discount_pct", "total_amount")
            },
            "region": clean_text_standard("region", is_acronym=True),
            "transaction_timestamp": standardize_date("transaction_ts"),
            "last_modified_timestamp": standardize_date("last_modified_ts"),
        }
    )
    flagged = cleaned.withColumns(
        {
            "is_pricing_correct": is_pricing_correct(
                "total_amount", "quantity", "unit_price", "discount_pct"
            ),
            "is_time_valid": is_time_valid("transaction_timestamp", "last_modified_timestamp"),
        }
    )
    return with_audit(flagged, "sales").drop("transaction_ts", "last_modified_ts")


def click_columns(df: DataFrame) -> DataFrame:
    """Row-wise part of the click cleaning, the same for batches and streams."""
    cleaned = df.withColumns(
        {
            "customer_id": null_text("customer_id"),
            "session_id": lower_trim("session_id"),
            **{name: upper_trim(name) for name in ("product_id", "event_type", "device_type")},
            "page_url": trim_only("page_url"),
            "event_timestamp": standardize_date("timestamp"),
        }
    )
    return cleaned.withColumns(
        {
            "is_event_valid": is_event_allowed("event_type"),
            "is_device_valid": is_device_allowed("device_type"),
            "search_query": search_term("event_type", "page_url"),
        }
    ).drop("timestamp")


def bronze_clickstream(df_bronze: DataFrame) -> DataFrame:
    """Website events."""
    latest = latest_rows(df_bronze, *VERSIONS["clicks"])
    return with_audit(click_columns(latest), "clicks")


ROW_CLEANERS = {
    "customers": customer_columns,
    "crm": crm_columns,
    "products": product_columns,
    "sales": sale_columns,
}


def clean_files(stage: Stage, df_bronze: DataFrame, feed: str) -> list[DataFrame]:
    """The clean rows of bronze rows in files, in parts; the same rows as the feed's cleaner gives.

    Only keys and what orders their versions are shuffled. Whole rows are where several versions
    of a key tie and content decides.
    """
    key, order_by = VERSIONS[feed]
    rows = with_normalised_key(df_bronze, key)
    order, ties = version_order(rows.columns, key, order_by)
    alone, tied = latest_in_files(stage, rows, [key], order)
    return [ROW_CLEANERS[feed](part) for part in [*alone, *[latest_per_key(part, [key], order, ties) for part in tied]]]
