"""Write a DataFrame of text columns as raw files, the way a source system drops them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork.sources.schemas import ARRIVAL, RESCUED, SOURCE_FILE


def raw_columns(df: DataFrame) -> DataFrame:
    return df.drop(ARRIVAL, SOURCE_FILE, RESCUED)


def land_csv(df: DataFrame, folder: str) -> None:
    """CSV files with a header row; spaces around values are kept."""
    (
        raw_columns(df)
        .write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def land_json_lines(df: DataFrame, folder: str) -> None:
    raw_columns(df).write.mode("append").json(folder)


def land_json_array(df: DataFrame, folder: str, rows_per_file: int = 2000) -> None:
    """One JSON array per file."""
    documents = raw_columns(df).select(F.to_json(F.struct("*")).alias("doc"))
    files = documents.count() // rows_per_file + 1
    arrays = documents.groupBy(F.pmod(F.xxhash64("doc"), F.lit(files))).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("doc"), ",\n"), F.lit("]")).alias("value")
    )
    arrays.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(folder)


LANDERS = {
    "customers": land_csv,
    "products": land_csv,
    "sales": land_csv,
    "crm": land_json_array,
    "clicks": land_json_lines,
}
