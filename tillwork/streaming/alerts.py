"""Low-stock alerts while clicks arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.plans.marts import GOLD_CLOCK, low_stock_alert
from tillwork.sources.schemas import GOLD_TABLES
from tillwork.sources.tables import read_table, write_table
from tillwork.streaming.progress import current_rows, follow_table


def latest_snapshot(spark: SparkSession, inventory_table: str) -> DataFrame:
    """The rows of the newest snapshot: every run adds one of all products, with one time."""
    table = read_table(spark, inventory_table)
    if GOLD_CLOCK not in table.columns:
        return table
    newest = table.agg(F.max(GOLD_CLOCK).alias("__newest"))
    return table.join(newest, F.col(GOLD_CLOCK) == F.col("__newest"), "left_semi")


def stream_low_stock(
    spark: SparkSession,
    clicks_table: str,
    products_table: str,
    inventory_table: str,
    alert_table: str,
    checkpoint: str,
) -> None:
    """Append an alert for every new add-to-cart event on a product low on stock.

    A stream over the click table's feed; each batch of clicks is joined with the products
    that are low by the stock as it is then. Alerts are keyed by event, so a batch that runs
    twice adds nothing.
    """
    contract = GOLD_TABLES["fact_low_stock_alert"]

    def alert(changes: DataFrame, batch: str) -> None:
        session = changes.sparkSession
        alerts = low_stock_alert(
            df_dim_prod=read_table(session, products_table),
            df_fct_clicks=current_rows(changes, contract.keys),
            df_fct_inven=latest_snapshot(session, inventory_table),
        )
        # An event occurs once in the clicks, so the alerts are unique, too.
        write_table(
            alerts, alert_table, contract.mode, contract.keys, contract.cluster, check_unique=False, batch=batch
        )

    follow_table(spark, clicks_table, checkpoint, alert)
