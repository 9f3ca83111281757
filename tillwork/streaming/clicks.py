"""Click cleaning on a stream."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillwork.plans.clean import click_columns, with_audit, with_normalised_key
from tillwork.session import RECOMMENDED
from tillwork.sources.schemas import SILVER_TABLES
from tillwork.sources.tables import Stage, write_table

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the checkpoint remembers it."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, RECOMMENDED[STATE_STORE])
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def stream_clickstream(df_bronze: DataFrame, table: str, checkpoint: str) -> None:
    """Clean the events that arrived since the last call into ``table``, each event id once.

    The ids met so far are the stream's state, in RocksDB on the executors and in the
    checkpoint, so a batch looks up its own ids and reads nothing of the table. There is no
    watermark: an event may come or come again at any time, and none is lost. An event's first
    batch counts; of copies in one batch any may stand for it, where the batch transform takes
    the latest. A batch that runs twice adds nothing: its write has the batch's name.
    """
    contract = SILVER_TABLES["clickstream"]

    def add(batch: DataFrame, number: int) -> None:
        # Read in any case, also if the write is known: a batch that isn't read leaves no state.
        with Stage(batch.sparkSession) as stage:
            rows = stage.keep(batch, "clicks")
            write_table(
                with_audit(click_columns(rows), "clicks"), table, contract.mode, cluster_keys=contract.cluster,
                batch=f"{checkpoint}#{number}",
            )

    with state_on_disk(df_bronze.sparkSession):
        query = (
            with_normalised_key(df_bronze, "event_id").dropDuplicates(["event_id"])
            .writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
