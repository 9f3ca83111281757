"""The whole run on landed files: again with nothing new, and with corrections."""

import os
import time
import uuid
from pathlib import Path

import pytest
from conftest import rows

from pyspark.sql import functions as F

from tillwork.plans.queries import _run_three_times, feed
from tillwork.plans.retail_run import RetailRun
from tillwork.session import scratch_folder
from tillwork.sources.landing import LANDERS
from tillwork.sources.schemas import FEEDS, GOLD_TABLES, SILVER_TABLES
from tillwork.sources.tables import create_layers, generations

SF = "/root/testdata/sf0.001"
CLOCKS = ("_silver_processed_at", "_gold_updated_at", "_ingest_timestamp")


@pytest.fixture(scope="module")
def run(spark) -> RetailRun:
    return _run_three_times(spark, SF, "testrun")


def state(run):
    tables = {("silver", t): c for t, c in SILVER_TABLES.items()} | {("gold", t): c for t, c in GOLD_TABLES.items()}
    return {name: rows(run.table(*name).drop(*CLOCKS)) for name in tables if name[1] != "fact_inventory"}


def test_keys_are_unique(run):
    for layer, tables in (("silver", SILVER_TABLES), ("gold", GOLD_TABLES)):
        for name, contract in tables.items():
            table = run.table(layer, name)
            assert table.groupBy(*contract.keys).count().filter("count > 1").isEmpty(), name
            assert not table.isEmpty(), name


def test_a_run_without_new_files_changes_only_the_stock_snapshots(run):
    before, snapshots = state(run), run.table("gold", "fact_inventory").select("_gold_updated_at").distinct().count()
    run.run()
    assert state(run) == before
    assert run.table("gold", "fact_inventory").select("_gold_updated_at").distinct().count() == snapshots + 1


def test_facts_agree_with_the_clean_tables(run):
    sales = run.table("silver", "sql_sales_transactions")
    kept = sales.filter("is_pricing_correct AND is_time_valid")
    assert rows(run.table("gold", "fact_sales"), "transaction_id") == rows(kept, "transaction_id")
    total = run.table("gold", "fact_daily_sales").selectExpr("sum(daily_sale)", "sum(daily_units_sold)").first()
    assert tuple(total) == tuple(kept.selectExpr("sum(total_amount)", "sum(quantity)").first())


def test_bronze_keeps_every_arrival(run, spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    copies = events.filter("event_id % 10 = 0").count()
    assert run.table("bronze", "clickstream").count() == events.count() + copies
    assert run.table("silver", "clickstream").count() == events.count()


def test_upkeep_changes_no_table(run, spark):
    """All tables in few files, old writes gone; the next runs go on from there."""
    before = state(run)
    writes = {t: len(generations(spark, run.name("gold", t))) for t in GOLD_TABLES}
    run.upkeep(most=1, keep=1)
    assert state(run) == before
    assert sum(len(generations(spark, run.name("gold", t))) for t in writes) < sum(writes.values())
    run.run()
    assert state(run) == before


def test_moved_customers_and_a_new_column(run, spark):
    """Every customer moves to one region and the file brings one more column."""
    moved = feed(spark, SF, "customers").filter("file_name LIKE '%/part-1.%'").withColumns(
        {"region": F.lit("anz"), "channel": F.lit("web")})
    LANDERS["customers"](moved, f"{run.landing}/{FEEDS['customers'].folder}")
    customers = run.table("silver", "sql_customers").count()
    run.run()
    silver = run.table("silver", "sql_customers")
    assert silver.count() == customers == silver.filter("region = 'ANZ' AND channel = 'web'").count()
    report, sales = run.table("gold", "fact_daily_sales"), run.table("gold", "fact_sales")
    assert {r[0] for r in report.select("customer_region").distinct().collect()} == {"ANZ", None}
    assert report.selectExpr("sum(daily_sale)").first() == sales.selectExpr("sum(total_amount)").first()


def test_another_process_goes_on(run, spark):
    """A catalog without the tables finds them again, and a run with nothing new changes nothing."""
    other = RetailRun(spark, run.landing, run.root, f"other_{run.prefix}")
    before = state(run)
    other.run()
    assert state(other) == before


def test_the_later_file_of_one_run_wins(spark):
    """Two product files in one ingest; the older one sorts higher by content."""
    root = scratch_folder(spark, "two")
    small = RetailRun(spark, f"{root}/landing", f"{root}/lake", f"two_{uuid.uuid4().hex[:8]}_")
    folder = Path(f"{small.landing.removeprefix('file:')}/{FEEDS['products'].folder}")
    folder.mkdir(parents=True)
    for name, stock, age in (("z.csv", 90, 100), ("a.csv", 10, 0)):
        (folder / name).write_text(f"product_id,stock_quantity\np1,{stock}\n")
        os.utime(folder / name, (time.time() - age, time.time() - age))
    create_layers(spark, small.root, small.prefix)
    small.ingest("products")
    small.clean("products")
    assert rows(small.table("silver", "sql_products"), "product_id", "stock_quantity") == [("P1", 10)]
