"""The registered queries: one per operator, each over whole tables of ``sf_dir``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, StructType

from tillwork import functions as fn
from tillwork.functions.calling_codes import CALLING_CODE_LENGTHS
from tillwork.operators import governance
from tillwork.operators.diff import table_diff
from tillwork.plans import clean, marts
from tillwork.plans.clean import latest_rows
from tillwork.plans.retail_run import CLEANERS, RetailRun
from tillwork.session import files_in, move_folder, scratch_folder
from tillwork.sources import feeds, tables
from tillwork.sources.ingest import ingest_raw_to_bronze
from tillwork.sources.landing import LANDERS, raw_columns
from tillwork.sources.schemas import (
    ARRIVAL,
    CLOCKS,
    FEED_SCHEMAS,
    FEEDS,
    FILE_TIME,
    GOLD_TABLES,
    ORDER,
    RESCUED,
    SOURCE_FILE,
)
from tillwork.sources.tables import compact, create_layers, read_table, write_table
from tillwork.streaming.alerts import stream_low_stock
from tillwork.streaming.clicks import stream_clickstream
from tillwork.streaming.progress import current_rows, follow_table

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Without clock columns, in types that compare across engines.

    Decimals become doubles, whole numbers bigints, dates and times text.
    """

    def plain(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "int":
            return F.col(name).cast("bigint").alias(name)
        if kind in ("date", "timestamp"):
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    return df.select(*[plain(n, k) for n, k in df.dtypes if n not in CLOCKS])


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feeds.FEED_BUILDERS[name](spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return CLEANERS[name](feed(spark, sf_dir, name))


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def silver(source: str) -> DataFrame:
        return cleaned(spark, sf_dir, source)

    def gold(table: str) -> DataFrame:
        return mart(spark, sf_dir, table)

    if name == "dim_customers":
        return marts.transfer_silver_to_gold_dim_customer(silver("customers"), silver("crm"))
    if name == "dim_products":
        return marts.transfer_silver_to_gold_dim_products(silver("products"))
    if name == "fact_inventory":
        return marts.transfer_silver_to_gold_fact_inventory(silver("products"))
    if name == "fact_sales":
        return marts.transfer_silver_to_gold_fact_sales(silver("sales"))
    if name == "fact_clicks":
        return marts.transfer_silver_to_gold_fact_clicks(silver("clicks"))
    if name == "daily_sales":
        return marts.daily_sales(gold("dim_customers"), gold("dim_products"), gold("fact_sales"))
    return marts.low_stock_alert(gold("dim_products"), gold("fact_clicks"), gold("fact_inventory"))


def _part(df: DataFrame, number: int) -> DataFrame:
    """Rows of one delivery of a feed."""
    return df.filter(F.col(SOURCE_FILE).contains(f"/part-{number}."))


class Workspace:
    """Databases and folders of one query run, below the shared scratch folder."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = scratch_folder(spark, purpose)
        self.prefix = f"{purpose}_{uuid.uuid4().hex[:12]}_"
        create_layers(spark, self.root, self.prefix)

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"


# Latest row per key


def dedup_latest(spark, sf_dir):
    latest = latest_rows(feed(spark, sf_dir, "customers"), "customer_id", [ARRIVAL])
    return comparable(latest.drop(RESCUED))


def dedup_latest_two_keys(spark, sf_dir):
    latest = latest_rows(
        feed(spark, sf_dir, "sales"), "transaction_id", ["last_modified_ts", ARRIVAL]
    )
    return comparable(latest.drop(RESCUED))


# Column functions


def clean_text(spark, sf_dir):
    return feed(spark, sf_dir, "customers").select(
        "customer_id",
        SOURCE_FILE,
        fn.clean_spaces("address").alias("address"),
        fn.clean_text_standard("first_name").alias("first_name"),
        fn.clean_text_standard("city", enforce_title_case=False).alias("city"),
        fn.clean_text_standard("region", is_acronym=True).alias("region"),
        fn.full_name(fn.clean_spaces("first_name"), fn.clean_spaces("last_name")).alias("full_name"),
    )


def clean_email_flag(spark, sf_dir):
    email = fn.clean_email("email")
    return feed(spark, sf_dir, "customers").select(
        "customer_id", SOURCE_FILE, email.alias("email"), fn.is_verified_email(email).alias("verified_email")
    )


def clean_phone(spark, sf_dir):
    return feed(spark, sf_dir, "customers").select(
        "customer_id",
        SOURCE_FILE,
        fn.clean_phone("phone").alias("stripped"),
        fn.format_phone_e164("phone").alias("cleaned_phone"),
        fn.is_verified_phone("phone").alias("verified_phone"),
    )


def phone_countries(spark, sf_dir):
    """Numbers of every listed country and of an unlisted one, in all lengths, from customer ids."""
    codes = ", ".join(f"'{c}'" for c in [*CALLING_CODE_LENGTHS, "999"])
    number = (
        f"concat(IF(c_custkey % 2 = 0, '+', '00'), element_at(array({codes}), CAST(c_custkey % {len(CALLING_CODE_LENGTHS) + 1}"
        " AS INT) + 1), ' ', substring('2345678912345678', 1, CAST(c_custkey % 13 AS INT) + 3))"
    )
    rows = feeds.read_table(spark, sf_dir, "customer").select("c_custkey", F.expr(number).alias("phone"))
    return rows.select("c_custkey", "phone", fn.format_phone_e164("phone").alias("cleaned_phone"))


def clean_ids(spark, sf_dir):
    return feed(spark, sf_dir, "clicks").select(
        fn.upper_trim("event_id").alias("event_id"),
        SOURCE_FILE,
        fn.null_text("customer_id").alias("customer_id"),
        fn.lower_trim("session_id").alias("session_id"),
        fn.trim_only("page_url").alias("page_url"),
    )


def parse_dates(spark, sf_dir):
    parsed = feed(spark, sf_dir, "customers").select(
        "customer_id", SOURCE_FILE, "signup_date", fn.standardize_date("signup_date").alias("joined")
    )
    return comparable(parsed)


def cast_defaults(spark, sf_dir):
    stock = feed(spark, sf_dir, "products").select(
        F.col("product_id").alias("id"),
        SOURCE_FILE,
        fn.cast_to_integer("stock_quantity").alias("whole"),
        fn.cast_to_decimal("unit_price").alias("amount"),
    )
    scores = feed(spark, sf_dir, "crm").select(
        F.col("customer_id").alias("id"),
        SOURCE_FILE,
        fn.cast_to_integer("lifetime_value_estimate", -1).alias("whole"),
        fn.cast_to_decimal("churn_risk_score", 5, 3, 0.5).alias("amount"),
    )
    return comparable(stock).unionByName(comparable(scores))


def bool_default(spark, sf_dir):
    return feed(spark, sf_dir, "crm").select(
        "customer_id",
        SOURCE_FILE,
        fn.cast_to_boolean("marketing_opt_in").alias("opt_in"),
        fn.cast_to_boolean("marketing_opt_in", True).alias("opt_in_unless_refused"),
    )


def search_term(spark, sf_dir):
    return feed(spark, sf_dir, "clicks").select(
        "event_id", fn.search_term(fn.upper_trim("event_type"), "page_url").alias("search_query")
    )


def gross_margin(spark, sf_dir):
    priced = feed(spark, sf_dir, "products").select(
        "product_id",
        SOURCE_FILE,
        fn.cast_to_decimal("unit_price").alias("price"),
        fn.cast_to_decimal("cost_price").alias("cost"),
    )
    margin = fn.gross_margin_percentage("price", "cost", fn.is_margin_positive("price", "cost"))
    return comparable(priced.withColumn("margin", margin))


# Flags


def flag_membership(spark, sf_dir):
    return feed(spark, sf_dir, "clicks").select(
        "event_id",
        fn.is_event_allowed(fn.upper_trim("event_type")).alias("is_event_valid"),
        fn.is_device_allowed(fn.upper_trim("device_type")).alias("is_device_valid"),
    )


def flag_price(spark, sf_dir):
    return cleaned(spark, sf_dir, "sales").select("transaction_id", "is_pricing_correct")


def flag_time(spark, sf_dir):
    return cleaned(spark, sf_dir, "sales").select("transaction_id", "is_time_valid")


def flag_margin_reorder(spark, sf_dir):
    return cleaned(spark, sf_dir, "products").select(
        "product_id", "is_margin_positive", "is_reorder_needed"
    )


# Ingest


def _ingested(spark, sf_dir, name: str) -> DataFrame:
    """Land a feed delivery by delivery, ingest after each and once more at the end."""
    space, source = Workspace(spark, f"ingest_{name}"), FEEDS[name]
    rows, landing, table = feed(spark, sf_dir, name), f"{space.root}/landing", space.name("bronze", name)
    parts = (0, 1, 2) if name == "sales" else (1, 2)

    def ingest() -> None:
        ingest_raw_to_bronze(
            spark, landing, table, f"{space.root}/checkpoint/{name}", source.file_format,
            source.options, FEED_SCHEMAS[name],
        )

    for number in parts:
        LANDERS[name](_part(rows, number), landing)
        ingest()
    ingest()
    folder = space.root.rsplit("/", 1)[-1]
    arrived = F.col(ARRIVAL).isNotNull() & F.col(SOURCE_FILE).contains(f"{folder}/landing/")
    return read_table(spark, table).select(
        *FEED_SCHEMAS[name].names, RESCUED, arrived.alias("has_lineage")
    )


def ingest_csv(spark, sf_dir):
    return _ingested(spark, sf_dir, "sales")


def ingest_typed(spark, sf_dir):
    """Sales with typed numbers; text that is no number is rescued."""
    space, source = Workspace(spark, "typed"), FEEDS["sales"]
    landing, table = f"{space.root}/landing", space.name("bronze", "sales")
    types = {"quantity": IntegerType(), "unit_price": DecimalType(10, 2)}
    schema = StructType(
        [StructField(n, types.get(n, StringType())) for n in FEED_SCHEMAS["sales"].names]
    )
    LANDERS["sales"](feed(spark, sf_dir, "sales"), landing)
    ingest_raw_to_bronze(
        spark, landing, table, f"{space.root}/checkpoint", source.file_format, source.options, schema
    )
    return comparable(read_table(spark, table).drop(ARRIVAL, SOURCE_FILE, FILE_TIME))


def ingest_json_multiline(spark, sf_dir):
    return _ingested(spark, sf_dir, "crm")


def ingest_jsonl(spark, sf_dir):
    return _ingested(spark, sf_dir, "clicks")


def schema_evolution(spark, sf_dir):
    """A feed whose later files bring one more column, as CSV and as JSON lines."""
    space = Workspace(spark, "evolve")
    results = []
    for name, key in (("customers", "customer_id"), ("clicks", "event_id")):
        source, rows = FEEDS[name], feed(spark, sf_dir, name)
        landing, table = f"{space.root}/landing/{name}", space.name("bronze", name)

        def ingest() -> None:
            ingest_raw_to_bronze(
                spark, landing, table, f"{space.root}/checkpoint/{name}", source.file_format,
                source.options, FEED_SCHEMAS[name],
            )

        LANDERS[name](_part(rows, 1), landing)
        ingest()
        LANDERS[name](_part(rows, 2).withColumn("channel", F.concat(F.lit("web "), key)), landing)
        ingest()
        results.append(read_table(spark, table).select(F.col(key).alias("id"), "channel", RESCUED))
    return results[0].unionByName(results[1])


def rescued_rows(spark, sf_dir):
    """JSON lines of which some are cut off and some carry an unknown key."""
    space, rows = Workspace(spark, "rescue"), raw_columns(feed(spark, sf_dir, "clicks"))
    landing, table = f"{space.root}/landing", space.name("bronze", "clicks")
    is_search = F.col("event_type") == "search "
    document = F.to_json(F.struct("*", F.when(is_search, F.lit("spring")).alias("campaign")))
    cut = F.when(F.col("timestamp") == "bad", F.expr("substring(doc, 1, length(doc) - 1)"))
    lines = rows.withColumn("doc", document).select(F.coalesce(cut, "doc").alias("value"))
    lines.write.text(landing)
    ingest_raw_to_bronze(
        spark, landing, table, f"{space.root}/checkpoint", "json",
        schema=FEED_SCHEMAS["clicks"], add_new_columns=False,
    )
    return read_table(spark, table).select("event_id", "event_type", RESCUED)


def rescued_documents(spark, sf_dir):
    """JSON arrays with an unknown key, and with a key that differs from a known one in case."""
    space, rows = Workspace(spark, "rescue_array"), raw_columns(feed(spark, sf_dir, "crm"))
    landing, table = f"{space.root}/landing", space.name("bronze", "crm")
    note = F.when(F.col("loyalty_tier") == "gold", F.lit("late")).alias("note")
    document = F.to_json(F.struct("*", note, F.col("preferred_channel").alias("Preferred_Channel")))
    arrays = rows.select(document.alias("doc")).groupBy(F.pmod(F.xxhash64("doc"), F.lit(20))).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("doc"), ","), F.lit("]")).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(landing)
    ingest_raw_to_bronze(
        spark, landing, table, f"{space.root}/checkpoint", "json", {"multiLine": "true"},
        schema=FEED_SCHEMAS["crm"], add_new_columns=False,
    )
    return read_table(spark, table).select("customer_id", "preferred_channel", RESCUED)


def ingest_reordered(spark, sf_dir):
    """A delivery in the feed's order with a value that equals a column's name, another reversed in capitals."""
    space, rows = Workspace(spark, "reordered"), raw_columns(feed(spark, sf_dir, "customers"))
    landing, table = f"{space.root}/landing", space.name("bronze", "customers")
    parts = [raw_columns(_part(feed(spark, sf_dir, "customers"), n)) for n in (1, 2)]
    named = F.when(F.col("last_name").isNull(), F.lit("customer_id")).otherwise(F.col("customer_id"))
    deliveries = (
        parts[0].withColumn("customer_id", named),
        parts[1].select(*[F.col(n).alias(n.upper()) for n in reversed(rows.columns)]),
    )
    for delivery in deliveries:
        LANDERS["customers"](delivery, landing)
        ingest_raw_to_bronze(
            spark, landing, table, f"{space.root}/checkpoint", "csv", schema=FEED_SCHEMAS["customers"]
        )
    return read_table(spark, table).select(*FEED_SCHEMAS["customers"].names, RESCUED)


def ingest_widened(spark, sf_dir):
    """Three deliveries of one column: whole numbers, then amounts, then text; nothing is rescued."""
    space = Workspace(spark, "widened")
    landing, table = f"{space.root}/landing", space.name("bronze", "parts")
    parts = feeds.read_table(spark, sf_dir, "part")
    for number, value in enumerate(("p_size", "p_retailprice + 0.25", "p_brand")):
        rows = parts.filter(F.col("p_partkey") % 3 == number).selectExpr("p_partkey", f"string({value}) AS value")
        rows.write.mode("append").option("header", True).csv(landing)
        ingest_raw_to_bronze(
            spark, landing, table, f"{space.root}/checkpoint", "csv", {"inferSchema": "true"}, widen_types=True
        )
    return comparable(read_table(spark, table).select("p_partkey", "value", RESCUED))


def ingest_odd_names(spark, sf_dir):
    """Files whose names look like patterns that match their neighbours."""
    space, source = Workspace(spark, "odd_names"), FEEDS["customers"]
    rows, landing = feed(spark, sf_dir, "customers"), f"{space.root}/landing"
    for number in (1, 2):
        LANDERS["customers"](_part(rows, number).coalesce(4), f"{space.root}/made/{number}")
        for at, file in enumerate(files_in(spark, f"{space.root}/made/{number}", ".csv")):
            name = f"{'[0-9]' if number == 2 else ''}{at}{'*' if number == 2 else ''}.csv"
            move_folder(spark, f"{space.root}/made/{number}/{file}", f"{landing}/{name}")
        ingest_raw_to_bronze(
            spark, landing, space.name("bronze", "customers"), f"{space.root}/checkpoint", source.file_format,
            source.options, FEED_SCHEMAS["customers"],
        )
    table = read_table(spark, space.name("bronze", "customers"))
    return table.select(*FEED_SCHEMAS["customers"].names, RESCUED)


def _clicks_between(spark, sf_dir, purpose: str, between) -> DataFrame:
    """Ingest one delivery of clicks, do ``between`` with the table, ingest the other."""
    space, source = Workspace(spark, purpose), FEEDS["clicks"]
    landing, table = f"{space.root}/landing", space.name("bronze", "clicks")
    for number in (1, 2):
        LANDERS["clicks"](_part(feed(spark, sf_dir, "clicks"), number), landing)
        ingest_raw_to_bronze(
            spark, landing, table, f"{space.root}/checkpoint", source.file_format, source.options,
            FEED_SCHEMAS["clicks"],
        )
        if number == 1:
            between(table)
    return read_table(spark, table).select(*FEED_SCHEMAS["clicks"].names, RESCUED)


def compact_then_ingest(spark, sf_dir):
    return _clicks_between(
        spark, sf_dir, "compacted", lambda table: compact(spark, table, ["product_id"])
    )


def append_after_ingest(spark, sf_dir):
    """Rows that a batch job adds to an ingested table are seen beside those of later files."""

    def add(table: str) -> None:
        late = raw_columns(_part(feed(spark, sf_dir, "clicks"), 1)).filter("customer_id IS NULL")
        write_table(late.withColumn("session_id", F.lit("late")), table, "append")

    return _clicks_between(spark, sf_dir, "appended", add)


# Tables


def upsert(spark, sf_dir):
    table = Workspace(spark, "upsert").name("silver", "products")
    rows = feed(spark, sf_dir, "products")
    for number in (1, 2, 2):
        delivery = clean.bronze_sql_products_silver(_part(rows, number))
        write_table(delivery, table, "merge", "product_id", ["product_id"])
    return comparable(read_table(spark, table))


def append_new(spark, sf_dir):
    table = Workspace(spark, "append").name("silver", "clicks")
    rows = feed(spark, sf_dir, "clicks")
    for number in (2, 1, 2):
        delivery = clean.bronze_clickstream(_part(rows, number))
        write_table(delivery, table, "append", "event_id", ["customer_id", "product_id"])
    return comparable(read_table(spark, table))


class _Killed(Exception):
    pass


def append_after_crash(spark, sf_dir):
    """Two deliveries, each written twice: its first write dies with all files written but not published."""
    table, rows = Workspace(spark, "crash").name("silver", "products"), feed(spark, sf_dir, "products")

    def dies(*_):
        raise _Killed

    def deliver(number: int) -> None:
        delivery = clean.bronze_sql_products_silver(_part(rows, number))
        write_table(delivery, table, "append", batch=f"delivery {number}")

    deliver(1)
    publish, tables.move_folder = tables.move_folder, dies
    try:
        deliver(2)
    except _Killed:
        pass
    finally:
        tables.move_folder = publish
    seen = read_table(spark, table).withColumn("seen", F.lit("before the retry"))
    seen = spark.read.parquet(_kept(seen, "crash_seen"))
    deliver(2)
    deliver(2)
    return comparable(seen.unionByName(read_table(spark, table).withColumn("seen", F.lit("after it"))))


def _kept(df: DataFrame, purpose: str) -> str:
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return folder


def replayed_feed(spark, sf_dir):
    """A copy of the sales table that only ever hears its change feed, after corrections and removals."""
    space, rows = Workspace(spark, "replay"), feed(spark, sf_dir, "sales")
    source, copy = space.name("silver", "sales"), space.name("silver", "copy")

    def replay(changes: DataFrame, batch: str) -> None:
        now = current_rows(changes, ["transaction_id"])
        keys = changes.select("transaction_id").distinct()
        write_table(now, copy, "merge", "transaction_id", check_unique=False, replaced_keys=keys, batch=batch)

    for number in (0, 1, 2):
        delivery = clean.bronze_sql_sale_transactions(_part(rows, number))
        write_table(delivery, source, "merge", "transaction_id", check_unique=False)
        if number:
            follow_table(spark, source, f"{space.root}/checkpoint", replay)
    # Sales of unknown customers go.
    kept = read_table(spark, source).filter("customer_id IS NOT NULL")
    write_table(kept, source, "overwrite", "transaction_id", check_unique=False)
    follow_table(spark, source, f"{space.root}/checkpoint", replay)
    return comparable(read_table(spark, copy).drop("_ingest_timestamp", "_source_file"))


def overwrite(spark, sf_dir):
    table = Workspace(spark, "overwrite").name("silver", "crm")
    rows = feed(spark, sf_dir, "crm")
    write_table(clean.bronze_crm_customers_silver(_part(rows, 2)), table, "overwrite")
    write_table(clean.bronze_crm_customers_silver(rows), table, "overwrite", option_dict={"compression": "gzip"})
    return comparable(read_table(spark, table))


def schema_merge_write(spark, sf_dir):
    table = Workspace(spark, "widen").name("silver", "products")
    rows = feed(spark, sf_dir, "products")
    first = clean.bronze_sql_products_silver(_part(rows, 1)).drop("brand", "supplier_id")
    write_table(first, table, "append")
    write_table(clean.bronze_sql_products_silver(_part(rows, 2)), table, "append")
    return comparable(read_table(spark, table))


def table_diff_sales(spark, sf_dir):
    rows = feed(spark, sf_dir, "sales")
    part_0, part_2 = F.col(SOURCE_FILE).contains("/part-0."), F.col(SOURCE_FILE).contains("/part-2.")
    old = clean.bronze_sql_sale_transactions(rows.filter(~part_2)).drop(*CLOCKS)
    new = clean.bronze_sql_sale_transactions(rows.filter(~part_0)).drop(*CLOCKS)
    return comparable(table_diff(old, new, ["transaction_id"]))


def clustered_write(spark, sf_dir):
    table, contract = Workspace(spark, "cluster").name("gold", "fact_sales"), GOLD_TABLES["fact_sales"]
    write_table(mart(spark, sf_dir, "fact_sales"), table, contract.mode, contract.keys, contract.cluster)
    return comparable(read_table(spark, table))


def compact_table(spark, sf_dir):
    table = Workspace(spark, "compact").name("gold", "fact_clicks")
    rows = feed(spark, sf_dir, "clicks")
    for number in (1, 2):
        clicks = marts.transfer_silver_to_gold_fact_clicks(clean.bronze_clickstream(_part(rows, number)))
        write_table(clicks, table, "append", option_dict={"maxRecordsPerFile": "1000"})
    compact(spark, table, ["customer_id"])
    return comparable(read_table(spark, table))


# Streams


def stream_low_stock_alerts(spark, sf_dir):
    """Clicks come in two deliveries; the stream runs after each and once more."""
    space = Workspace(spark, "alerts")
    rows, clicks = feed(spark, sf_dir, "clicks"), space.name("gold", "fact_clicks")
    products, inventory = space.name("gold", "dim_products"), space.name("gold", "fact_inventory")
    alerts = space.name("gold", "fact_low_stock_alert")
    write_table(mart(spark, sf_dir, "dim_products"), products, "merge", "product_id")
    write_table(mart(spark, sf_dir, "fact_inventory"), inventory, "append")
    for number in (2, 1):
        delivery = clean.bronze_clickstream(_part(rows, number))
        write_table(marts.transfer_silver_to_gold_fact_clicks(delivery), clicks, "append", "event_id")
        stream_low_stock(spark, clicks, products, inventory, alerts, f"{space.root}/checkpoint")
    stream_low_stock(spark, clicks, products, inventory, alerts, f"{space.root}/checkpoint")
    return comparable(read_table(spark, alerts))


def stream_clicks(spark, sf_dir):
    """Clicks as a stream over two deliveries; the second one repeats events."""
    space, rows = Workspace(spark, "clicks"), feed(spark, sf_dir, "clicks")
    source, table = f"{space.root}/bronze/arrivals", space.name("silver", "clickstream")
    for number in (1, 2):
        _part(rows, number).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        stream_clickstream(stream, table, f"{space.root}/checkpoint")
    return comparable(read_table(spark, table).drop("_ingest_timestamp", "_source_file"))


def alerts_after_restock(spark, sf_dir):
    """Odd events come after all stock is sold: an alert shows the stock when its click came."""
    space = Workspace(spark, "restock")
    facts, clicks = mart(spark, sf_dir, "fact_clicks"), space.name("gold", "fact_clicks")
    products, inventory = space.name("gold", "dim_products"), space.name("gold", "fact_inventory")
    alerts, stock = space.name("gold", "fact_low_stock_alert"), mart(spark, sf_dir, "fact_inventory")
    write_table(mart(spark, sf_dir, "dim_products"), products, "overwrite")
    odd = F.substring("event_id", 2, 20).cast("long") % 2
    for turn, snapshot in enumerate((stock, stock.withColumn("stock_quantity", F.lit(0)))):
        write_table(snapshot, inventory, "append")
        for delivery in (facts.filter(odd == turn), facts.filter("false")):
            write_table(delivery, clicks, "append", "event_id")
            stream_low_stock(spark, clicks, products, inventory, alerts, f"{space.root}/checkpoint")
    return comparable(read_table(spark, alerts))


# Governance


def _tagged_customers(spark, sf_dir) -> DataFrame:
    return governance.tag_sensitive(mart(spark, sf_dir, "dim_customers"), ["email"])


def mask_email(spark, sf_dir):
    customers = mart(spark, sf_dir, "dim_customers").select("customer_id", "email", "region")
    return governance.mask_columns(customers, ["email"], {"data_analyst_team"})


def filter_region(spark, sf_dir):
    customers = mart(spark, sf_dir, "dim_customers").select("customer_id", "email", "region")
    return governance.filter_rows(customers, {"latam_managers"})


def governed_dim(spark, sf_dir):
    customers = _tagged_customers(spark, sf_dir)
    return comparable(governance.governed_view(customers, {"apac_managers", "latam_managers"}))


def governed_dim_admin(spark, sf_dir):
    return comparable(governance.governed_view(_tagged_customers(spark, sf_dir), {"admin_group"}))


def governed_table(spark, sf_dir):
    """The same through a view that stands beside the table and follows it."""
    space = Workspace(spark, "governed")
    table, view = space.name("gold", "dim_customers"), space.name("gold", "customers_for_managers")
    customers = mart(spark, sf_dir, "dim_customers")
    write_table(customers.filter("region = 'LATAM'"), table, "overwrite")
    governance.create_governed_view(spark, view, table, {"apac_managers", "latam_managers"}, ["email"])
    write_table(customers, table, "overwrite")
    return comparable(read_table(spark, view))


def governed_members(spark, sf_dir):
    """Through a view that looks its reader up among the members of the groups."""
    space = Workspace(spark, "members")
    table, members, view = (space.name("gold", n) for n in ("dim_customers", "members", "customers_by_reader"))
    customers = mart(spark, sf_dir, "dim_customers")
    write_table(customers, table, "overwrite", "customer_id", check_unique=False)
    # Every customer is a user; each region's customers are in that region's group.
    users = customers.select(
        F.col("customer_id").alias("user_name"),
        F.concat(F.lower("region"), F.lit("_managers")).alias("group_name"),
    )
    own = [F.expr("current_user()").alias("user_name"), F.lit("apac_managers").alias("group_name")]
    write_table(users.unionByName(spark.range(1).select(*own)), members, "append")
    governance.create_policy_view(spark, view, table, members, ["email"])
    return comparable(spark.table(view))


def governed_sql(spark, sf_dir):
    governance.register_sql_functions(spark)
    groups = F.array(F.lit("apac_managers"))
    customers = mart(spark, sf_dir, "dim_customers").withColumn("groups", groups)
    return customers.filter("can_read_region(region, groups)").selectExpr(
        "customer_id", "region", "mask_pii(email, groups) AS email"
    )


# The whole run

MANY_FILES = 8  # of a delivery


def _land(rows: DataFrame, name: str, landing: str) -> None:
    LANDERS[name](rows, f"{landing}/{FEEDS[name].folder}")


def _run_three_times(spark, sf_dir, purpose: str) -> RetailRun:
    """Run after each of three deliveries, of which two bring all feeds, and with nothing new."""
    root = scratch_folder(spark, purpose)
    run = RetailRun(spark, f"{root}/landing", f"{root}/lake", f"{purpose}_{uuid.uuid4().hex[:12]}_")
    for number in (0, 1, 2):
        _land_sales(spark, sf_dir, number, run.landing)
        for name in ("customers", "crm", "products", "clicks") if number < 2 else ():
            _land(_part(feed(spark, sf_dir, name), number + 1), name, run.landing)
        run.run()
    run.run()
    return run


def _land_sales(spark, sf_dir, number: int, landing: str, files: int = 8) -> None:
    """One delivery of sales; all versions of a sale in it are in one file, as they arrive together.

    Where there are files for many tasks, those that join an order's lines write them, and no text is
    shuffled; few files are written from texts that all tasks have made.
    """
    if files >= MANY_FILES:
        part = _part(feeds.sales(spark, sf_dir, by_order=True), number).coalesce(files)
    else:
        part = _part(feed(spark, sf_dir, "sales"), number).repartition(files, fn.upper_trim("transaction_id"))
    _land(part, "sales", landing)


def _sales_run(spark, sf_dir, purpose: str, files: int, run_each: bool, **options) -> DataFrame:
    root = scratch_folder(spark, purpose)
    run = RetailRun(spark, f"{root}/landing", f"{root}/lake", f"{purpose}_{uuid.uuid4().hex[:12]}_", **options)
    create_layers(spark, run.root, run.prefix)
    for number in (0, 1, 2):
        _land_sales(spark, sf_dir, number, run.landing, files)
        if run_each or number == 2:
            run.ingest("sales")
            run.clean("sales")
    silver = run.table("silver", FEEDS["sales"].table)
    return comparable(silver.drop("_ingest_timestamp", "_source_file", ORDER))


def corrected_sales(spark, sf_dir):
    """Clean sales after three deliveries that repeat and correct each other's sales."""
    return _sales_run(spark, sf_dir, "corrected", 8, True)


def cut_batches(spark, sf_dir):
    """The same sales landed at one time and ingested file by file."""
    return _sales_run(spark, sf_dir, "cut", 2, False, max_files_per_batch=1)


def rerun_daily_sales(spark, sf_dir):
    run = _run_three_times(spark, sf_dir, "rerun")
    return comparable(run.table("gold", "fact_daily_sales"))


def _cleaned_query(name: str) -> Query:
    return lambda spark, sf_dir: comparable(cleaned(spark, sf_dir, name))


def _mart_query(name: str) -> Query:
    return lambda spark, sf_dir: comparable(mart(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "dedup_latest": dedup_latest,
    "dedup_latest_two_keys": dedup_latest_two_keys,
    "clean_text": clean_text,
    "clean_email_flag": clean_email_flag,
    "clean_phone": clean_phone,
    "phone_countries": phone_countries,
    "clean_ids": clean_ids,
    "parse_dates": parse_dates,
    "cast_defaults": cast_defaults,
    "bool_default": bool_default,
    "search_term": search_term,
    "gross_margin": gross_margin,
    "flag_membership": flag_membership,
    "flag_price": flag_price,
    "flag_time": flag_time,
    "flag_margin_reorder": flag_margin_reorder,
    **{f"silver_{name}": _cleaned_query(name) for name in CLEANERS},
    **{
        name: _mart_query(name)
        for name in (
            "dim_customers", "dim_products", "fact_inventory", "fact_sales", "fact_clicks",
            "daily_sales", "low_stock_alert",
        )
    },
    "ingest_csv": ingest_csv,
    "ingest_json_multiline": ingest_json_multiline,
    "ingest_jsonl": ingest_jsonl,
    "ingest_typed": ingest_typed,
    "schema_evolution": schema_evolution,
    "rescued_rows": rescued_rows,
    "rescued_documents": rescued_documents,
    "ingest_reordered": ingest_reordered,
    "ingest_odd_names": ingest_odd_names,
    "ingest_widened": ingest_widened,
    "compact_then_ingest": compact_then_ingest,
    "append_after_ingest": append_after_ingest,
    "upsert": upsert,
    "append_new": append_new,
    "append_after_crash": append_after_crash,
    "replayed_feed": replayed_feed,
    "overwrite": overwrite,
    "schema_merge_write": schema_merge_write,
    "table_diff": table_diff_sales,
    "clustered_write": clustered_write,
    "compact": compact_table,
    "stream_low_stock": stream_low_stock_alerts,
    "stream_clicks": stream_clicks,
    "mask_email": mask_email,
    "filter_region": filter_region,
    "governed_dim": governed_dim,
    "governed_dim_admin": governed_dim_admin,
    "governed_table": governed_table,
    "governed_sql": governed_sql,
    "governed_members": governed_members,
    "alerts_after_restock": alerts_after_restock,
    "rerun_daily_sales": rerun_daily_sales,
    "corrected_sales": corrected_sales,
    "cut_batches": cut_batches,
}
