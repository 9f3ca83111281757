"""The whole run: landing files -> bronze -> clean tables -> dimensions, facts, reports.

Only tables pass between the steps. Ingest follows the landing files, clean tables, facts, the
daily report and alerts follow the change feed of the table before them, so a run reads what is
new and writes the partitions that it concerns; a run without new files changes nothing but the
stock snapshot. Corrections replace older rows by the source's own time and move on to the facts
and the report, whatever delivery or batch they come in.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tillwork.operators.diff import CHANGE
from tillwork.plans import clean, marts
from tillwork.plans.daily_view import maintain_daily_sales
from tillwork.sources.ingest import ingest_raw_to_bronze
from tillwork.sources.schemas import FEED_SCHEMAS, FEEDS, GOLD_TABLES, ORDER, SILVER_TABLES, Contract
from tillwork.sources.tables import (
    Stage,
    compact,
    create_layers,
    expire_versions,
    generations,
    read_table,
    table_keys,
    write_table,
)
from tillwork.streaming.alerts import stream_low_stock
from tillwork.streaming.clicks import stream_clickstream
from tillwork.streaming.progress import GENERATION, change_feed, current_rows, follow_table

CLEANERS = {
    "customers": clean.bronze_sql_customers_silver,
    "crm": clean.bronze_crm_customers_silver,
    "products": clean.bronze_sql_products_silver,
    "sales": clean.bronze_sql_sale_transactions,
    "clicks": clean.bronze_clickstream,
}


def together(steps: Sequence[Callable[[], None]]) -> None:
    """Independent steps at the same time, so a small feed does not hold up a large one."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


class RetailRun:
    """The steps of a run, on databases ``<prefix>bronze``, ``<prefix>silver``, ``<prefix>gold``."""

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        root: str,
        prefix: str = "",
        max_files_per_batch: int | None = None,
        buckets: int | None = None,
    ):
        """``max_files_per_batch`` cuts a very large load into several writes; the result is the same.

        ``buckets`` is the number of hash buckets of the tables a first run makes.
        """
        self.spark, self.landing, self.root, self.prefix = spark, landing, root, prefix
        self.buckets = buckets
        self.stream_options = (
            {"maxFilesPerTrigger": str(max_files_per_batch)} if max_files_per_batch else {}
        )

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return read_table(self.spark, self.name(layer, table))

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoint/{table}"

    def ingest(self, feed: str) -> None:
        """New files of one feed to its bronze table."""
        source = FEEDS[feed]
        ingest_raw_to_bronze(
            self.spark,
            f"{self.landing}/{source.folder}",
            self.name("bronze", source.table),
            self.checkpoint(f"{source.table}_bronze"),
            source.file_format,
            {**source.options, **self.stream_options},
            FEED_SCHEMAS[feed],
        )

    def clean(self, feed: str) -> None:
        """New bronze rows of one feed to its clean table."""
        source, table = self.name("bronze", FEEDS[feed].table), self.name("silver", FEEDS[feed].table)
        checkpoint, contract = self.checkpoint(f"{FEEDS[feed].table}_silver"), SILVER_TABLES[FEEDS[feed].table]
        if feed == "clicks":
            stream_clickstream(change_feed(self.spark, source).drop(CHANGE, GENERATION), table, checkpoint)
            return

        def add(changes: DataFrame, batch: str) -> None:
            with Stage(changes.sparkSession) as stage:
                rows, *more = clean.clean_files(stage, current_rows(changes), feed)
                self._write(rows, table, contract, newer_by=ORDER, batch=batch, more=more, from_files=True)

        follow_table(self.spark, source, checkpoint, add)

    def _write(self, df: DataFrame, table: str, contract: Contract, **options) -> None:
        # Every table of the run is deduplicated or grouped by its key.
        write_table(
            df, table, contract.mode, contract.keys, contract.cluster, check_unique=False, buckets=self.buckets, **options
        )

    def _gold(self, df: DataFrame, table: str, **options) -> None:
        self._write(df, self.name("gold", table), GOLD_TABLES[table], **options)

    def _silver(self, table: str) -> DataFrame:
        return self.table("silver", table).drop(ORDER)

    def _fact(self, source: str, table: str, transform: Callable[[DataFrame], DataFrame]) -> None:
        """Changed clean rows replace their facts; a row that is no longer valid takes its fact along."""
        contract, followed = GOLD_TABLES[table], self.name("silver", source)

        def replace(changes: DataFrame, batch: str) -> None:
            keyed = table_keys(self.spark, followed) == list(contract.keys)
            rows = current_rows(changes, contract.keys, keyed).drop(ORDER)
            write_table(
                transform(rows), self.name("gold", table), "merge", contract.keys, contract.cluster,
                check_unique=False, replaced_keys=changes.select(*contract.keys).distinct(), batch=batch,
                buckets=self.buckets,
            )

        follow_table(self.spark, followed, self.checkpoint(table), replace)

    def customers(self) -> None:
        customers, crm = self._silver("sql_customers"), self._silver("crm_customers")
        self._gold(marts.transfer_silver_to_gold_dim_customer(customers, crm), "dim_customers")

    def products(self, run_id: str | None = None) -> None:
        """The dimension, and one stock snapshot per run; a retried ``run_id`` adds none."""
        products = self._silver("sql_products")
        self._gold(marts.transfer_silver_to_gold_dim_products(products), "dim_products")
        write_table(
            marts.transfer_silver_to_gold_fact_inventory(products), self.name("gold", "fact_inventory"), "append",
            cluster_keys=GOLD_TABLES["fact_inventory"].cluster, batch=run_id,
        )

    def sales(self) -> None:
        self._fact("sql_sales_transactions", "fact_sales", marts.transfer_silver_to_gold_fact_sales)

    def clicks(self) -> None:
        self._fact("clickstream", "fact_clicks", marts.transfer_silver_to_gold_fact_clicks)

    def daily_sales(self) -> None:
        """The report's groups that changed sales, customers or products concern."""
        gold = partial(self.name, "gold")
        maintain_daily_sales(
            self.spark, gold("dim_customers"), gold("dim_products"), gold("fact_sales"), gold("fact_daily_sales"),
            self.checkpoint("fact_daily_sales"),
        )

    def low_stock(self) -> None:
        """Alerts for the clicks that are new, by the stock as it is now."""
        gold = partial(self.name, "gold")
        stream_low_stock(
            self.spark, gold("fact_clicks"), gold("dim_products"), gold("fact_inventory"),
            gold("fact_low_stock_alert"), self.checkpoint("fact_low_stock_alert"),
        )

    def upkeep(self, most: int = 50, keep: int = 4) -> None:
        """Compact the tables that more than ``most`` writes make up and drop what no table needs any more.

        All followers of the run's tables must have read them, as they have at the end of a run.
        """
        for layer, contracts in (("bronze", {}), ("silver", SILVER_TABLES), ("gold", GOLD_TABLES)):
            for table in self.spark.catalog.listTables(f"{self.prefix}{layer}"):
                name = self.name(layer, table.name)
                if len(generations(self.spark, name)) > most:
                    contract = contracts.get(table.name)
                    compact(self.spark, name, contract.cluster if contract else None)
                    expire_versions(self.spark, name, keep)

    def run(self, run_id: str | None = None) -> None:
        """Bring everything up to date. Give a run that is retried the same ``run_id``."""
        create_layers(self.spark, self.root, self.prefix)

        def bring_in(feed: str) -> None:
            self.ingest(feed)
            self.clean(feed)

        together([partial(bring_in, feed) for feed in FEEDS])
        together([self.customers, partial(self.products, run_id or uuid.uuid4().hex), self.sales, self.clicks])
        together([self.daily_sales, self.low_stock])
        self.upkeep()
