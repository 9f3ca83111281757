"""Expected result of each registered query as DuckDB SQL."""

from __future__ import annotations

from checks.oracle import (
    CLICK_COLUMNS,
    CRM_COLUMNS,
    CUSTOMER_COLUMNS,
    RELATIONS,
    SALES_COLUMNS,
    acronym,
    bigint,
    double,
    e164,
    email_flag,
    latest,
    money,
    opt_in,
    parsed,
    spaces,
    statement,
    text,
    title,
    whole,
)
from tillwork.functions.calling_codes import CALLING_CODE_LENGTHS, lengths

AUDIT_OUT = text("_ingest_timestamp") + ", _source_file, _record_source"


def columns(names: list[str] | str) -> str:
    names = names.split() if isinstance(names, str) else names
    return ", ".join(f'"{name}"' for name in names)


SILVER_OUT = {
    "customers": (
        "customer_id, first_name, last_name, email, address, city, region, customer_segment,"
        " cleaned_phone, full_name, verified_email, verified_phone, " + text("join_timestamp")
    ),
    "crm": (
        "customer_id, last_campaign_engaged, loyalty_tier, marketing_opt_in, preferred_channel, "
        + double("lifetime_value_estimate", "churn_risk_score") + ", " + text("last_updated_crm")
    ),
    "products": (
        "product_id, product_name, category, subcategory, brand, supplier_id, is_margin_positive,"
        " is_reorder_needed, " + double("unit_price", "cost_price") + ", "
        + bigint("stock_quantity", "reorder_threshold") + ", " + text("created_date")
    ),
    "sales": (
        "transaction_id, customer_id, product_id, store_id, region, payment_method,"
        " is_pricing_correct, is_time_valid, " + bigint("quantity") + ", "
        + double("unit_price", "discount_pct", "total_amount") + ", "
        + text("transaction_timestamp", "last_modified_timestamp")
    ),
    "clicks": (
        "event_id, customer_id, device_type, event_type, page_url, product_id, session_id,"
        " is_event_valid, is_device_valid, search_query, " + text("event_timestamp")
    ),
}
GOLD_OUT = {
    "dim_customers": (
        "customer_id, first_name, last_name, full_name, email, cleaned_phone, address, city, region,"
        " customer_segment, verified_email, verified_phone, last_campaign_engaged, loyalty_tier,"
        " preferred_channel, marketing_opt_in, "
        + double("lifetime_value_estimate", "churn_risk_score") + ", " + text("joined_at", "last_updated_crm")
    ),
    "dim_products": (
        "product_id, product_name, category, subcategory, brand, supplier_id, is_margin_positive, "
        + double("cost_price", "unit_price", "gross_margin_percentage") + ", "
        + bigint("reorder_threshold") + ", " + text("product_created_at")
    ),
    "fact_inventory": "product_id, is_reorder_needed, " + bigint("stock_quantity"),
    "fact_sales": (
        "customer_id, product_id, transaction_id, store_id, payment_method, " + bigint("quantity") + ", "
        + double("unit_price", "discount_pct", "total_amount") + ", "
        + text("transaction_timestamp", "last_modified_timestamp")
    ),
    "fact_clicks": (
        "customer_id, product_id, session_id, event_id, event_type, device_type, page_url, search_query, "
        + text("event_at")
    ),
    "daily_sales": (
        "product_category, customer_region, average_margin_pct, " + text("sales_date") + ", "
        + double("daily_sale") + ", " + bigint("daily_units_sold")
    ),
    "low_stock_alert": (
        "event_id, session_id, product_id, " + bigint("available_stock") + ", " + text("alert_timestamp")
    ),
}


def silver(name: str) -> str:
    return f"SELECT {SILVER_OUT[name]}, {AUDIT_OUT} FROM silver_{name}"


def gold(name: str) -> str:
    return f"SELECT {GOLD_OUT[name]} FROM {name}"


# Sales as they look when deliveries 0 and 1, or 1 and 2, are all there is.
for _name, _missing in (("old", 2), ("new", 0)):
    RELATIONS[f"feed_{_name}_sales"] = (
        f"SELECT * FROM feed_sales WHERE file_name NOT LIKE '%/part-{_missing}.%'"
    )
    RELATIONS[f"latest_{_name}_sales"] = latest(
        f"feed_{_name}_sales", "transaction_id", ["last_modified_ts", "ingesttime"], SALES_COLUMNS
    )
    RELATIONS[f"silver_{_name}_sales"] = RELATIONS["silver_sales"].replace(
        "FROM latest_sales", f"FROM latest_{_name}_sales"
    )

DIFF_SQL = f"""SELECT _change_type, {SILVER_OUT['sales']}, {AUDIT_OUT} FROM (
  SELECT 'insert' AS _change_type, n.* FROM silver_new_sales n
    WHERE transaction_id NOT IN (SELECT transaction_id FROM silver_old_sales)
  UNION ALL
  SELECT 'delete', o.* FROM silver_old_sales o
    WHERE transaction_id NOT IN (SELECT transaction_id FROM silver_new_sales)
  UNION ALL
  SELECT 'update_pre', o.* FROM (SELECT * FROM silver_old_sales EXCEPT SELECT * FROM silver_new_sales) o
    WHERE transaction_id IN (SELECT transaction_id FROM silver_new_sales)
  UNION ALL
  SELECT 'update_post', n.* FROM (SELECT * FROM silver_new_sales EXCEPT SELECT * FROM silver_old_sales) n
    WHERE transaction_id IN (SELECT transaction_id FROM silver_old_sales))"""

# Products of the first delivery have no brand and supplier; the second adds its rows.
RELATIONS["first_products"] = RELATIONS["silver_products"].replace(
    "FROM latest_products", "FROM (SELECT * FROM feed_products WHERE file_name LIKE '%/part-1.%')"
).replace("SELECT product_id,", "SELECT upper(trim(product_id)) AS product_id,")
RELATIONS["second_products"] = RELATIONS["first_products"].replace("/part-1.", "/part-2.")
WIDEN_SQL = f"""SELECT {SILVER_OUT['products']}, {AUDIT_OUT} FROM (
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS supplier_id) FROM first_products
  UNION ALL BY NAME SELECT * FROM second_products)"""

RELATIONS["raw_cents"] = f"""SELECT product_id, file_name, CAST({money('unit_price')} * 100 AS BIGINT) AS p,
  CAST({money('cost_price')} * 100 AS BIGINT) AS c FROM feed_products"""

JSON_DOC = (
    "'{' || concat_ws(',', "
    + ", ".join(
        f"""'"{n}":"' || "{n}" || '"'"""
        for n in (
            "customer_id", "device_type", "event_id", "event_type", "page_url", "product_id",
            "session_id", "timestamp",
        )
    )
    + """, CASE WHEN event_type = 'search ' THEN '"campaign":"spring"' END) || '}'"""
)
RESCUED_SQL = f"""
SELECT CASE WHEN "timestamp" <> 'bad' THEN event_id END AS event_id,
  CASE WHEN "timestamp" <> 'bad' THEN event_type END AS event_type,
  CASE WHEN "timestamp" = 'bad' THEN left({JSON_DOC}, length({JSON_DOC}) - 1)
       WHEN event_type = 'search ' THEN '{{"campaign":"spring"}}' END AS _rescued_data
FROM feed_clicks"""

NO_RESCUE = "CAST(NULL AS VARCHAR) AS _rescued_data"

# The last delivery of a sale is what a copy has in the end.
RELATIONS["merged_feed_sales"] = """SELECT * FROM feed_sales
  QUALIFY file_name = max(file_name) OVER (PARTITION BY upper(trim(transaction_id)))"""
RELATIONS["merged_latest_sales"] = latest(
    "merged_feed_sales", "transaction_id", ["last_modified_ts", "ingesttime"], SALES_COLUMNS
)
RELATIONS["merged_sales"] = RELATIONS["silver_sales"].replace("FROM latest_sales", "FROM merged_latest_sales")

# Every code with every length it allows; the number must be one of its rows.
_CODES = [*CALLING_CODE_LENGTHS, "999"]
_ALLOWED = ", ".join(
    f"('{code}', {n})" for code in _CODES
    for n in (lengths(CALLING_CODE_LENGTHS[code]) if code in CALLING_CODE_LENGTHS else range(7 - 3, 15 - 3 + 1))
)
PHONE_SQL = f"""WITH allowed(code, n) AS (VALUES {_ALLOWED}),
made AS (SELECT c_custkey, ['{"','".join(_CODES)}'][(c_custkey % {len(_CODES)} + 1)::BIGINT] AS code,
    substr('2345678912345678', 1, (c_custkey % 13 + 3)::BIGINT) AS rest FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '00' END || m.code || ' ' || rest AS phone,
  CASE WHEN n IS NOT NULL THEN '+' || m.code || rest END AS cleaned_phone
FROM made m LEFT JOIN allowed a ON a.code = m.code AND a.n = length(rest)"""

FINAL_SQL = {
    "dedup_latest": f"SELECT customer_id, {columns(CUSTOMER_COLUMNS)}, {text('ingesttime')}, file_name FROM latest_customers",
    "dedup_latest_two_keys": f"SELECT transaction_id, {columns(SALES_COLUMNS)}, last_modified_ts, {text('ingesttime')}, file_name FROM latest_sales",
    "clean_text": f"""SELECT customer_id, file_name, {spaces('address')} AS address,
        {title('first_name')} AS first_name, {spaces('city')} AS city, {acronym('region')} AS region,
        {spaces('first_name')} || ' ' || {spaces('last_name')} AS full_name FROM feed_customers""",
    "clean_email_flag": f"""SELECT customer_id, file_name, lower(trim(email)) AS email,
        {email_flag('lower(trim(email))')} AS verified_email FROM feed_customers""",
    "clean_phone": f"""SELECT customer_id, file_name, regexp_replace(phone, '[^0-9+]', '', 'g') AS stripped,
        {e164('phone')} AS cleaned_phone, ({e164('phone')}) IS NOT NULL AS verified_phone FROM feed_customers""",
    "clean_ids": """SELECT upper(trim(event_id)) AS event_id, file_name,
        CASE WHEN lower(trim(customer_id)) = 'null' THEN NULL ELSE upper(trim(customer_id)) END AS customer_id,
        lower(trim(session_id)) AS session_id, trim(page_url) AS page_url FROM feed_clicks""",
    "parse_dates": f"""SELECT customer_id, file_name, signup_date,
        CAST({parsed('signup_date')} AS VARCHAR) AS joined FROM feed_customers""",
    "cast_defaults": f"""SELECT product_id AS id, file_name, CAST({whole('stock_quantity')} AS BIGINT) AS whole,
        CAST({money('unit_price')} AS DOUBLE) AS amount FROM feed_products
        UNION ALL SELECT customer_id, file_name,
        CAST(CASE WHEN regexp_matches(trim(lifetime_value_estimate), '^-?[0-9]+$')
             THEN trim(lifetime_value_estimate) ELSE '-1' END AS BIGINT),
        CAST(coalesce(TRY_CAST(churn_risk_score AS DECIMAL(5,3)), 0.5) AS DOUBLE) FROM feed_crm""",
    "bool_default": f"""SELECT customer_id, file_name, {opt_in('marketing_opt_in')} AS opt_in,
        coalesce(lower(trim(marketing_opt_in)) NOT IN ('f', 'false', 'n', 'no', '0'), TRUE) AS opt_in_unless_refused
        FROM feed_crm""",
    "search_term": """SELECT event_id, CASE WHEN upper(trim(event_type)) = 'SEARCH'
        THEN nullif(regexp_extract(page_url, '[?&]q=([^&]+)', 1), '') END AS search_query FROM feed_clicks""",
    "gross_margin": """SELECT product_id, file_name, p / 100.0::DOUBLE AS price, c / 100.0::DOUBLE AS cost,
        CASE WHEN p >= c AND p > 0 THEN ((20000 * (p - c) + p) // (2 * p)) / 100.0::DOUBLE
             ELSE 0.0::DOUBLE END AS margin FROM raw_cents""",
    "flag_membership": """SELECT event_id,
        upper(trim(event_type)) IN ('PAGE_VIEW', 'SEARCH', 'ADD_TO_CART', 'REMOVE_FROM_CART', 'PURCHASE') AS is_event_valid,
        upper(trim(device_type)) IN ('DESKTOP', 'MOBILE', 'TABLET') AS is_device_valid FROM feed_clicks""",
    "flag_price": "SELECT transaction_id, is_pricing_correct FROM silver_sales",
    "flag_time": "SELECT transaction_id, is_time_valid FROM silver_sales",
    "flag_margin_reorder": "SELECT product_id, is_margin_positive, is_reorder_needed FROM silver_products",
    **{f"silver_{name}": silver(name) for name in SILVER_OUT},
    **{name: gold(name) for name in GOLD_OUT},
    "ingest_csv": f"SELECT transaction_id, {columns(SALES_COLUMNS)}, last_modified_ts, {NO_RESCUE}, TRUE AS has_lineage FROM feed_sales",
    "ingest_json_multiline": f"SELECT customer_id, {columns(CRM_COLUMNS)}, {NO_RESCUE}, TRUE AS has_lineage FROM feed_crm",
    "ingest_jsonl": f"SELECT event_id, {columns(CLICK_COLUMNS)}, {NO_RESCUE}, TRUE AS has_lineage FROM feed_clicks",
    "ingest_typed": f"""SELECT * REPLACE (TRY_CAST(quantity AS BIGINT) AS quantity,
        CAST(unit_price AS DOUBLE) AS unit_price,
        CASE WHEN quantity = 'many' THEN '{{"quantity":"many"}}' END AS _rescued_data)
        FROM (SELECT transaction_id, {columns(SALES_COLUMNS)}, last_modified_ts, _rescued_data FROM feed_sales)""",
    "schema_evolution": f"""SELECT customer_id AS id,
        CASE WHEN file_name LIKE '%/part-2.%' THEN 'web ' || customer_id END AS channel, {NO_RESCUE} FROM feed_customers
        UNION ALL SELECT event_id, CASE WHEN file_name LIKE '%/part-2.%' THEN 'web ' || event_id END, {NO_RESCUE}
        FROM feed_clicks""",
    "rescued_rows": RESCUED_SQL,
    "rescued_documents": """SELECT customer_id, preferred_channel,
        CASE WHEN loyalty_tier = 'gold' OR preferred_channel IS NOT NULL THEN '{' || concat_ws(',',
          CASE WHEN loyalty_tier = 'gold' THEN '"note":"late"' END,
          '"Preferred_Channel":"' || preferred_channel || '"') || '}' END AS _rescued_data FROM feed_crm""",
    # CSV has no empty text.
    "ingest_reordered": f"""SELECT * REPLACE (nullif(email, '') AS email, nullif(phone, '') AS phone) FROM (
        SELECT CASE WHEN last_name IS NULL AND file_name LIKE '%/part-1.%' THEN 'customer_id'
        ELSE customer_id END AS customer_id, {columns(CUSTOMER_COLUMNS)}, {NO_RESCUE} FROM feed_customers)""",
    "ingest_widened": f"""SELECT p_partkey::BIGINT AS p_partkey, {NO_RESCUE}, CASE p_partkey % 3
        WHEN 0 THEN CAST(CAST(p_size AS DOUBLE) AS VARCHAR)
        WHEN 1 THEN CAST(CAST(p_retailprice + 0.25 AS DOUBLE) AS VARCHAR) ELSE p_brand END AS value FROM part""",
    "ingest_odd_names": f"""SELECT * REPLACE (nullif(email, '') AS email, nullif(phone, '') AS phone) FROM (
        SELECT customer_id, {columns(CUSTOMER_COLUMNS)}, {NO_RESCUE} FROM feed_customers)""",
    "compact_then_ingest": f"SELECT event_id, {columns(CLICK_COLUMNS)}, {NO_RESCUE} FROM feed_clicks",
    "append_after_ingest": f"""SELECT event_id, {columns(CLICK_COLUMNS)}, {NO_RESCUE} FROM feed_clicks
        UNION ALL BY NAME SELECT event_id, {columns(CLICK_COLUMNS)} , {NO_RESCUE} FROM (
          SELECT * REPLACE ('late' AS session_id) FROM feed_clicks
          WHERE customer_id IS NULL AND file_name LIKE '%/part-1.%')""",
    "upsert": silver("products"),
    "append_new": silver("clicks"),
    "append_after_crash": f"""SELECT 'before the retry' AS seen, {SILVER_OUT['products']}, {AUDIT_OUT} FROM first_products
        UNION ALL BY NAME SELECT 'after it' AS seen, {SILVER_OUT['products']}, {AUDIT_OUT} FROM first_products
        UNION ALL BY NAME SELECT 'after it' AS seen, {SILVER_OUT['products']}, {AUDIT_OUT} FROM second_products""",
    "replayed_feed": f"SELECT {SILVER_OUT['sales']}, _record_source FROM merged_sales WHERE customer_id IS NOT NULL",
    "overwrite": silver("crm"),
    "schema_merge_write": WIDEN_SQL,
    "table_diff": DIFF_SQL,
    "clustered_write": gold("fact_sales"),
    "compact": f"""SELECT {GOLD_OUT['fact_clicks']} FROM (
        SELECT f.* FROM fact_clicks f JOIN (SELECT upper(trim(event_id)) AS event_id FROM feed_clicks) a
        ON f.event_id = a.event_id)""",
    "stream_low_stock": gold("low_stock_alert"),
    "stream_clicks": f"SELECT {SILVER_OUT['clicks']}, _record_source FROM silver_clicks",
    "mask_email": "SELECT customer_id, 'CONFIDENTIAL DATA' AS email, region FROM dim_customers",
    "filter_region": "SELECT customer_id, email, region FROM dim_customers WHERE region = 'LATAM'",
    "governed_dim": f"""SELECT * REPLACE ('CONFIDENTIAL DATA' AS email) FROM (
        SELECT {GOLD_OUT['dim_customers']} FROM dim_customers WHERE region IN ('APAC', 'LATAM'))""",
    "governed_table": f"""SELECT * REPLACE ('CONFIDENTIAL DATA' AS email) FROM (
        SELECT {GOLD_OUT['dim_customers']} FROM dim_customers WHERE region IN ('APAC', 'LATAM'))""",
    "governed_dim_admin": gold("dim_customers"),
    "governed_members": f"""SELECT * REPLACE ('CONFIDENTIAL DATA' AS email) FROM (
        SELECT {GOLD_OUT['dim_customers']} FROM dim_customers WHERE region = 'APAC')""",
    "governed_sql": "SELECT customer_id, region, 'CONFIDENTIAL DATA' AS email FROM dim_customers WHERE region = 'APAC'",
    "alerts_after_restock": f"""SELECT {GOLD_OUT['low_stock_alert']} FROM (
        SELECT event_id, session_id, product_id, available_stock, alert_timestamp FROM low_stock_alert
          WHERE CAST(substr(event_id, 2) AS BIGINT) % 2 = 0
        UNION ALL
        SELECT c.event_id, c.session_id, c.product_id, 0, c.event_at FROM fact_clicks c
          JOIN dim_products p ON c.product_id = p.product_id
          WHERE c.event_type = 'ADD_TO_CART' AND p.reorder_threshold >= 0
            AND CAST(substr(c.event_id, 2) AS BIGINT) % 2 = 1)""",
    "rerun_daily_sales": gold("daily_sales"),
    "corrected_sales": f"SELECT {SILVER_OUT['sales']}, _record_source FROM silver_sales",
    "cut_batches": f"SELECT {SILVER_OUT['sales']}, _record_source FROM silver_sales",
}

ORACLE_SQL = {name: statement(sql) for name, sql in FINAL_SQL.items()} | {"phone_countries": PHONE_SQL}
