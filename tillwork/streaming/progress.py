"""Tables that follow another table's change feed by a file stream."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from tillwork.operators.dedup import latest_per_key
from tillwork.operators.diff import CHANGE
from tillwork.session import literal_path
from tillwork.sources.schemas import BATCH
from tillwork.sources.tables import NEW, table_folder, table_schema

GENERATION = "_generation"  # orders the writes of a table
_WRITE = re.compile(r"/(\d+)-[0-9a-f]+/(?:rows|changes)/")
_FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def change_feed(spark: SparkSession, table: str) -> DataFrame:
    """A stream of what writes brought to a table: its rows, CHANGE and GENERATION.

    Added rows are marked insert; of replaced and removed ones the row before (update_pre,
    delete) and after (update_post). Compaction brings no rows.
    """
    reader = _feed_files(spark).schema(_feed_schema(spark, table))
    return _with_writes(reader.parquet(_feed_folders(spark, table)))


def _feed_schema(spark: SparkSession, table: str) -> StructType:
    return StructType([*table_schema(spark, table), StructField(CHANGE, StringType())])


def _feed_folders(spark: SparkSession, table: str) -> str:
    return f"{literal_path(table_folder(spark, table))}/[0-9]*/{{rows/*/{BATCH}={NEW},changes}}"


def _feed_files(spark: SparkSession) -> DataStreamReader:
    # The default age leaves out files a week older than the newest.
    return spark.readStream.option("recursiveFileLookup", "true").option("maxFileAge", "36500d")


def _with_writes(rows: DataFrame) -> DataFrame:
    added = F.coalesce(CHANGE, F.lit("insert"))
    return rows.withColumns(
        {CHANGE: added, GENERATION: F.regexp_extract(F.col("_metadata.file_path"), _WRITE.pattern, 1)}
    )


def _writes(changes: DataFrame) -> set[str]:
    """The generations whose files ``changes`` reads; none if it isn't read from files."""
    return {found[1] for file in changes.inputFiles() if (found := _WRITE.search(file))}


def current_rows(changes: DataFrame, keys: Sequence[str] | None = None, keyed: bool = False) -> DataFrame:
    """The rows of a feed in the form they have now; with ``keys`` only a key's last form.

    ``keyed`` says that the table followed has these keys. One write of it then brings a key's last form
    once, so the changes of a single write are taken as they are, without a shuffle.
    """
    if keys and not (keyed and len(_writes(changes)) == 1):
        # A row before an update has the row after it in the same write.
        changes = changes.where(f"{CHANGE} <> 'update_pre'")
        last = F.expr(f"CASE WHEN {CHANGE} IN ('insert', 'update_post') THEN 1 ELSE 0 END").alias("last")
        changes = latest_per_key(changes.select("*", last), list(keys), [GENERATION, "last"], []).drop("last")
    return changes.where(f"{CHANGE} IN ('insert', 'update_post')").drop(CHANGE, GENERATION)


def follow_table(
    spark: SparkSession,
    source_table: str,
    checkpoint: str,
    step: Callable[[DataFrame, str], None],
) -> None:
    """Hand the changes since the last call to ``step(changes, batch)`` and wait for the end.

    The stream's checkpoint keeps the progress. After a failure a batch is handed over again
    under the same ``batch`` name, so ``step`` is a keyed write or a write of that batch.

    The stream hands over names of files; ``changes`` reads these, so each use reads the columns it
    needs, Spark knows the size, and rows have a place in the files.
    """
    schema = _feed_schema(spark, source_table)

    def hand(batch: DataFrame, number: int) -> None:
        files = sorted(literal_path(r["path"]) for r in batch.collect())
        if files:
            step(_with_writes(batch.sparkSession.read.schema(schema).parquet(*files)), f"{checkpoint}#{number}")

    query = (
        _feed_files(spark).format("binaryFile").schema(_FILES).load(_feed_folders(spark, source_table))
        .select("path")  # the content isn't read here
        .writeStream.foreachBatch(hand)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
