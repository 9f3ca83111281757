"""The five raw feeds, derived from the TPC-H-like tables with deterministic dirt.

Every row of the source tables takes part. Some keys arrive twice, with other spelling
and later content; ids of guests (``G``), leads (``L``) and delisted products (``D``)
find no partner, so the left joins downstream have unmatched rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwork.sources.schemas import ARRIVAL, FEED_COLUMNS, RESCUED, SOURCE_FILE

# Fixed value: arrival time of the first file of every feed.
FIRST_ARRIVAL = "2026-01-01 02:00:00"


@cache
def _stored_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its footers are read for the schema once per session."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_stored_schema(spark, path)).parquet(path)


def _arrivals(df: DataFrame, twice: str) -> DataFrame:
    """Repeat the rows matching ``twice``; column ``arrival`` numbers the copies."""
    return df.selectExpr("*", f"explode(sequence(1, if({twice}, 2, 1))) AS arrival")


def _feed(df: DataFrame, feed: str, columns: dict[str, str], arrived: str, file: str) -> DataFrame:
    texts = [f"{columns[name]} AS {name}" for name in FEED_COLUMNS[feed]]
    return df.selectExpr(
        *texts,
        f"CAST(NULL AS STRING) AS {RESCUED}",
        f"TIMESTAMP'{FIRST_ARRIVAL}' + {arrived} AS {ARRIVAL}",
        f"{file} AS {SOURCE_FILE}",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    rows = (
        read_table(spark, sf_dir, "customer")
        .join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left")
        .join(region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left")
    )
    rows = _arrivals(rows, "c_custkey % 3 = 0").selectExpr(
        "*",
        "if(c_custkey % 50 = 7, 'G', 'C') || c_custkey AS id",
        "200 + c_custkey % 700 AS area",
        "200 + c_custkey % 791 AS exchange",
        "lpad(c_custkey % 10000, 4, '0') AS line",
        "CAST(date_add(DATE'2020-01-01', CAST(c_custkey % 1500 AS INT)) AS STRING) AS day",
    )
    columns = {
        "customer_id": "CASE WHEN arrival = 2 THEN ' ' || lower(id) || ' '"
        " WHEN c_custkey % 5 = 1 THEN id || '  ' ELSE id END",
        "first_name": "'  ' || lower(c_mktsegment) || '   ann '",
        "last_name": "if(c_custkey % 97 = 5, NULL, ' no  ' || c_custkey || ' ')",
        "email": "CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN ''"
        " WHEN c_custkey % 7 = 0 THEN 'customer' || c_custkey || '@shop'"
        " ELSE ' Customer' || c_custkey || '@Shop' || c_nationkey || '.Example.COM ' END",
        "phone": "CASE c_custkey % 9"
        " WHEN 0 THEN '(' || area || ') ' || exchange || '-' || line || ' x12'"
        " WHEN 1 THEN '001-' || area || '-' || exchange || '-' || line"
        " WHEN 2 THEN '+44 20 7' || exchange || ' ' || line"
        " WHEN 3 THEN area || '.' || exchange || '.' || line"
        " WHEN 4 THEN '+1 ' || area || ' ' || exchange || ' ' || line || ' ext. 7'"
        " WHEN 5 THEN '1-' || area || '-' || exchange || '-' || line"
        " WHEN 6 THEN '12345' WHEN 7 THEN NULL"
        " ELSE if(c_custkey % 2 = 0, '', exchange || '-' || line) END",
        "address": "c_custkey || ' Harbour   Row  Unit ' || (c_custkey % 40) || 'B '",
        "city": "' new  ' || lower(n_name)",
        "region": "'  ' || CASE r_name WHEN 'AMERICA' THEN 'latam' WHEN 'ASIA' THEN 'apac'"
        " WHEN 'EUROPE' THEN 'emea' ELSE lower(replace(r_name, ' ', '  ')) END || ' '",
        "signup_date": "CASE c_custkey % 4 WHEN 1 THEN day || 'T05:06:07'"
        " WHEN 3 THEN if(c_custkey % 8 = 3, '04/03/2025', '2025-02-30') ELSE day END",
        "customer_segment": "if(arrival = 2, ' vip  ', ' ') || lower(c_mktsegment) || ' '",
    }
    return _feed(
        rows, "customers", columns,
        "make_dt_interval(if(c_custkey % 9 = 0, 0, arrival - 1))",
        "'landing/customers/part-' || arrival || '.csv'",
    )


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(read_table(spark, sf_dir, "customer"), "c_custkey % 5 = 0").selectExpr(
        "*",
        "CASE WHEN c_custkey % 4 = 3 THEN 'L' WHEN c_custkey % 50 = 7 THEN 'G' ELSE 'C' END"
        " || c_custkey AS id",
    )
    columns = {
        "crm_last_updated": "if(c_custkey % 6 = 0, '2023/09/10',"
        " CAST(date_add(DATE'2023-01-01', CAST(c_custkey % 700 AS INT)) AS STRING))",
        "customer_id": "if(c_custkey % 2 = 0, lower(id) || ' ', id)",
        "last_campaign_engaged": "if(c_custkey % 10 = 9, NULL, ' spring_' || (2020 + c_custkey % 6))",
        "lifetime_value_estimate": "CASE WHEN c_custkey % 11 = 0 THEN 'n/a'"
        " WHEN c_custkey % 13 = 0 THEN '99999999999.5'"
        " ELSE ' ' || CAST(c_acctbal AS DECIMAL(12,2)) || ' ' END",
        "churn_risk_score": "CASE WHEN c_custkey % 17 = 0 THEN '123.4' WHEN c_custkey % 19 = 0 THEN NULL"
        " ELSE '0.' || lpad(c_custkey % 1000, 3, '0') END",
        "loyalty_tier": "CASE WHEN arrival = 2 THEN 'silver  plus' WHEN c_custkey % 3 = 0 THEN '  platinum '"
        " WHEN c_custkey % 3 = 1 THEN 'gold' END",
        "marketing_opt_in": "CASE c_custkey % 6 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'false'"
        " WHEN 3 THEN 'maybe' WHEN 4 THEN 'Yes' WHEN 5 THEN '1' END",
        "preferred_channel": "CASE c_custkey % 4 WHEN 0 THEN ' email' WHEN 1 THEN 'sms '"
        " WHEN 3 THEN 'phone  call' END",
    }
    return _feed(
        rows, "crm", columns, "make_dt_interval(arrival - 1)",
        "'landing/crm/part-' || arrival || '.json'",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(read_table(spark, sf_dir, "part"), "p_partkey % 4 = 0").selectExpr(
        "*",
        "if(p_partkey % 50 = 9, 'D', 'P') || p_partkey AS id",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
        "CAST(date_add(DATE'2021-01-01', CAST(p_partkey % 900 AS INT)) AS STRING) AS day",
    )
    columns = {
        "product_id": "if(arrival = 2, lower(id) || ' ', id)",
        "product_name": "' ' || replace(p_name, ' ', '   ') || ' '",
        "category": "' ' || lower(p_type)",
        "subcategory": "lower(split_part(p_name, ' ', 2))",
        "brand": "' ' || p_brand || '  X'",
        "unit_price": "if(p_partkey % 333 = 5, 'free', CAST(price AS STRING))",
        "cost_price": "CAST(CAST(price * (60 + p_size) * 0.01 AS DECIMAL(10,2)) AS STRING)",
        "stock_quantity": "CASE WHEN p_partkey % 37 = 0 THEN 'abc' WHEN p_partkey % 41 = 0 THEN NULL"
        " WHEN arrival = 2 THEN CAST(p_partkey % 60 AS STRING) ELSE ' ' || (p_partkey % 100) || ' ' END",
        "reorder_threshold": "CAST(p_size AS STRING)",
        "supplier_id": "' sup' || (p_partkey % 10)",
        "created_date": "if(p_partkey % 5 = 0, day || 'T11:12:13', day)",
    }
    return _feed(
        rows, "products", columns, "make_dt_interval(arrival - 1)",
        "'landing/products/part-' || arrival || '.csv'",
    )


def sales(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """Sale lines. With ``by_order`` the lines of an order, so all versions of a sale, are in one partition."""
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    part = read_table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    lines = read_table(spark, sf_dir, "lineitem").join(part, "l_partkey", "left")
    if by_order:
        lines = lines.repartition("l_orderkey")  # of which the next join makes use
    rows = (
        lines.join(orders, "l_orderkey", "left")
        .selectExpr(
            "*",
            "'T' || l_orderkey || '-' || l_linenumber AS id",
            "CAST(l_quantity AS INT) AS units",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
            "CAST(l_discount AS DECIMAL(4,2)) AS discount",
            "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS ordered",
            "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS shipped",
        )
        .selectExpr("*", "CAST(units * price * (1 - discount) AS DECIMAL(12,2)) AS due")
    )
    columns = {
        "transaction_id": "if(l_suppkey % 2 = 0, lower(id) || ' ', id)",
        "customer_id": "if(l_orderkey % 40 = 0, NULL, ' c' || o_custkey)",
        "product_id": "'p' || l_partkey || ' '",
        "quantity": "if(l_suppkey % 61 = 0, 'many', CAST(units AS STRING))",
        "unit_price": "CAST(price AS STRING)",
        "discount_pct": "CAST(discount AS STRING)",
        "total_amount": "CAST(if((l_orderkey + l_partkey) % 10 = 0, due + 1.00, due) AS STRING)",
        "store_id": "' store0' || (l_suppkey % 10)",
        "region": "CASE l_suppkey % 5 WHEN 0 THEN ' latam ' WHEN 1 THEN 'north  america'"
        " WHEN 2 THEN 'apac' WHEN 3 THEN 'emea' END",
        "transaction_ts": "ordered",
        "last_modified_ts": "CASE WHEN l_partkey % 89 = 0 THEN 'unknown'"
        " WHEN l_partkey % 4 = 0 THEN substring(shipped, 1, 10) ELSE shipped END",
        "payment_method": "CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN ' paypal' ELSE 'cash' END",
    }
    return _feed(
        rows, "sales", columns, "make_dt_interval(CAST(l_suppkey % 3 AS INT))",
        "'landing/sales/part-' || (l_suppkey % 3) || '.csv'",
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").withColumnRenamed("event_id", "number")
    rows = _arrivals(events, "number % 10 = 0").selectExpr(
        "*",
        r"""CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INT) AS k""",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS happened",
    ).selectExpr("*", "k + 100 * (number % 2) AS product")
    columns = {
        "customer_id": "CASE WHEN user_id % 7 = 3 THEN ' NULL ' WHEN user_id % 11 = 5 THEN NULL"
        " ELSE ' c' || user_id END",
        "device_type": "CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'desktop'"
        " WHEN user_id % 4 = 1 THEN ' Mobile' WHEN user_id % 4 = 2 THEN 'tablet ' ELSE 'tv' END",
        "event_id": "if(arrival = 2, ' e', 'E') || number",
        "event_type": "CASE event_type WHEN 'click' THEN ' add_to_cart' WHEN 'view' THEN 'page_view'"
        " WHEN 'signup' THEN 'search ' ELSE event_type END",
        "page_url": "CASE WHEN event_type != 'signup' THEN ' /product/P' || product || '?q=ad'"
        " WHEN number % 3 = 0 THEN ' /s?q=lamp' || k || '&p=2'"
        " WHEN number % 3 = 1 THEN '/s?p=1&q=desk%20' || k || '#top' ELSE '/s?q=' END",
        "product_id": "if(event_type = 'signup', NULL, 'p' || product)",
        "session_id": "' SESS-' || user_id || '-' || substring(happened, 1, 10) || ' '",
        "timestamp": "if(number % 83 = 0, 'bad', happened)",
    }
    return _feed(
        rows, "clicks", columns, "make_dt_interval(0, arrival - 1)",
        "'landing/clicks/part-' || arrival || '.jsonl'",
    )


FEED_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "crm": crm,
    "products": products,
    "sales": sales,
    "clicks": clicks,
}
