"""How often a write reads its rows, and what it takes from them."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tillwork.operators.clustering import clustered
from tillwork.operators.diff import CHANGE
from tillwork.sources import tables
from tillwork.sources.tables import _Write, file_sizes, read_table, table_keys, table_schema, write_table
from tillwork.streaming.progress import current_rows, follow_table


def changes_of(spark, table, folder):
    found = []
    follow_table(spark, table, folder, lambda changes, batch: found.append(changes))
    return found


def test_changes_of_one_keyed_write_are_taken_without_a_shuffle(spark, layers, folder):
    table = layers("silver", "t")
    write_table(spark.range(10).selectExpr("string(id) k", "id v"), table, "merge", "k")
    first = changes_of(spark, table, folder)[0]
    write_table(spark.range(5, 12).selectExpr("string(id) k", "-id v"), table, "merge", "k",
                replaced_keys=spark.sql("SELECT '1' k"))
    second = changes_of(spark, table, folder)[0]
    assert table_keys(spark, table) == ["k"]
    for changes in (first, second):
        taken = current_rows(changes, ["k"], keyed=True)
        assert "Exchange" not in plan_of(taken) and "Exchange" in plan_of(current_rows(changes, ["k"]))
        assert rows(taken) == rows(current_rows(changes, ["k"]))
    both = changes_of(spark, table, f"{folder}/late")[0]
    assert rows(current_rows(both, ["k"], keyed=True)) == rows(read_table(spark, table))


def test_a_clustered_layout_reads_whole_rows_once(spark, folder):
    """What is known beforehand, rows and a sample, comes from the keys."""
    spark.range(0, 200_000, 1, 8).selectExpr(
        "lpad(string(hash(id) % 5000), 6, '0') a", "hash(id, 7) % 5000 b", "repeat('x', 50) wide").write.parquet(folder)
    laid = clustered(spark.read.parquet(folder), ["a", "b"], partitions=16)
    assert "rangepartitioning" not in plan_of(laid)  # which reads all rows for its bounds
    assert laid.select("wide").groupBy(F.spark_partition_id()).count().count() == 16


@pytest.mark.parametrize("keys", [["a"], ["a", "b"], []])
def test_clustered_files_have_about_equal_numbers_of_rows(spark, keys):
    df = spark.range(0, 100_000, 1, 8).selectExpr(
        "id", "hash(id) % 70000 a", "IF(id % 3 = 0, NULL, string(id % 7)) b", "id % 3 g")
    laid = clustered(df, keys, ["g"], 24, ["id"])
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 24 and sum(sizes) == 100_000 and max(sizes) < 2 * 100_000 / 24
    assert rows(laid.groupBy("g").count()) == rows(df.groupBy("g").count())


def test_equal_rows_and_few_rows_are_laid_out(spark):
    same = spark.range(0, 50_000, 1, 4).selectExpr("1 a", "'x' b")
    assert clustered(same, ["a", "b"], partitions=4).count() == 50_000
    for number in (0, 1, 300):
        few = clustered(spark.range(number).selectExpr("id a", "-id b"), ["a", "b"])
        assert few.count() == number and few.rdd.getNumPartitions() == 1


def test_a_table_made_from_files_is_not_staged(spark, layers, folder, monkeypatch):
    spark.range(1000).selectExpr("string(id) k", "id v").write.parquet(f"{folder}/in")
    stored, staged = spark.read.parquet(f"{folder}/in"), []
    keep = tables.Stage.keep
    monkeypatch.setattr(tables.Stage, "keep", lambda self, df, what, *more: (staged.append(what), keep(self, df, what, *more))[1])
    table = layers("silver", "t")
    write_table(stored.where("v < 600"), table, "append", "k", ["k"], check_unique=False, more=[stored.where("v >= 600")],
                from_files=True)
    assert staged == [] and rows(read_table(spark, table)) == rows(stored)


def test_stored_rows_are_read_once_for_what_stays_and_what_goes(spark, layers, folder, monkeypatch):
    """The same rows and changes where tasks write what they read."""
    monkeypatch.setattr(_Write, "is_spread", lambda self, size: True)
    told, tell = [], _Write.changes
    monkeypatch.setattr(_Write, "changes", lambda self, df: (told.append(df.columns), tell(self, df))[1])
    table = layers("silver", "t")
    write_table(spark.range(100).selectExpr("string(id) k", "id v"), table, "merge", "k", ["v"])
    changes_of(spark, table, folder)
    write_table(spark.range(90, 120).selectExpr("string(id) k", "-id v"), table, "merge", "k", ["v"],
                replaced_keys=spark.sql("SELECT explode(array('1', '95', '200')) k"))
    assert len(told) == 1  # the rows after, of which the write has them at hand
    kinds = changes_of(spark, table, folder)[0].groupBy(CHANGE).count()
    assert rows(kinds) == [("delete", 1), ("insert", 20), ("update_post", 10), ("update_pre", 10)]
    expected = {str(i): i for i in range(90) if i != 1} | {str(i): -i for i in range(90, 120)}
    assert dict(rows(read_table(spark, table))) == expected
    assert table_schema(spark, table).names == ["k", "v"]
    assert file_sizes(spark, table).where("_bucket < 0").isEmpty()
