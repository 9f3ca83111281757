"""What a run shuffles and writes: keys and places instead of whole rows."""

import random

from conftest import plan_of, rows
from pyspark.sql import functions as F

from tillwork.plans import clean, queries
from tillwork.session import files_in
from tillwork.sources.schemas import ARRIVAL, FEED_COLUMNS, FILE_TIME, RESCUED, SOURCE_FILE
from tillwork.sources.tables import Stage, _located, _bitmaps, _marked, write_table
from tillwork.streaming.progress import current_rows, follow_table


def sale_versions(spark):
    """Sales with up to 40 versions, some equal in time and file, with missing keys and values."""
    dice, made = random.Random(5), []
    for number in range(900):
        key = dice.choice([None, "T1", f"T{dice.randrange(300)}", f" t{dice.randrange(300)} "])
        row = {n: dice.choice([None, "1", "2"]) for n in FEED_COLUMNS["sales"]}
        row |= {"transaction_id": key, "last_modified_ts": dice.choice([None, "2024-01-01", "2024-01-02"]), RESCUED: None}
        row |= {SOURCE_FILE: dice.choice(["a", "b"]), FILE_TIME: dice.choice(["2024-02-01 00:00:00", "2024-02-02 00:00:00"])}
        made.append(row | {ARRIVAL: "2024-03-01 00:00:00"})
    columns = [*FEED_COLUMNS["sales"], RESCUED, ARRIVAL, SOURCE_FILE, FILE_TIME]
    data = spark.createDataFrame([tuple(r[n] for n in columns) for r in made], ", ".join(f"{n} string" for n in columns))
    return data.withColumns({ARRIVAL: F.col(ARRIVAL).cast("timestamp"), FILE_TIME: F.col(FILE_TIME).cast("timestamp")})


def test_cleaning_files_gives_the_cleaners_rows_and_shuffles_no_whole_row(spark, folder):
    sale_versions(spark).repartition(5).write.parquet(folder)
    stored = spark.read.parquet(folder)
    expected = rows(clean.bronze_sql_sale_transactions(stored).drop("_silver_processed_at"))
    with Stage(spark) as stage:
        parts = clean.clean_files(stage, stored, "sales")
        found = [row for part in parts for row in rows(part.drop("_silver_processed_at"))]
        assert sorted(found, key=repr) == expected
        assert len(parts) == 2  # the second one has keys whose versions tie
        assert 0 < parts[1].count() < parts[0].count()
        assert "hashpartitioning" not in plan_of(parts[0]) and "Window" not in plan_of(parts[0])


def test_cleaning_files_without_ties_or_rows(spark, folder):
    sale_versions(spark).dropDuplicates(["transaction_id"]).where("transaction_id NOT LIKE ' %'").write.parquet(folder)
    stored = spark.read.parquet(folder)
    with Stage(spark) as stage:
        alone = clean.clean_files(stage, stored, "sales")
        assert len(alone) == 1 and alone[0].count() == stored.count()
        assert [part.count() for part in clean.clean_files(stage, stored.where("false"), "sales")] == [0]


def test_marks_of_every_bit(spark, folder):
    spark.range(0, 70000, 1, 1).write.parquet(folder)
    stored, hit = spark.read.parquet(folder), F.xxhash64("id") % 3 == 0
    marked = _marked(stored, _bitmaps(_located(stored).where(hit), "__file", "__at", __hit=F.lit(True)), ["__hit"])
    assert marked.where(F.col("__hit") != hit).isEmpty() and marked.where("__hit").count() > 20000


def test_a_follower_reads_the_columns_it_uses(spark, layers, folder):
    table, plans = layers("silver", "t"), []
    write_table(spark.range(10).selectExpr("id", "string(id) AS wide"), table, "append", "id")

    def step(changes, batch):
        plans.append(plan_of(changes.select("id")))
        assert rows(current_rows(changes)) == [(i, str(i)) for i in range(10)]

    follow_table(spark, table, f"{folder}/checkpoint", step)
    assert len(plans) == 1 and "ReadSchema: struct<id:bigint" in plans[0] and "wide" not in plans[0]


def test_files_of_writes_are_packed_with_zstd(spark, layers, folder):
    table = layers("silver", "t")
    for value in ("a", "b"):
        write_table(spark.range(10).selectExpr("id", f"'{value}' AS v"), table, "merge", "id", ["id"])
    names = [r[0] for r in spark.read.table(table).select("_metadata.file_name").distinct().collect()]
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_versions_of_a_sale_land_in_one_file_without_a_shuffle_of_texts(spark, folder, monkeypatch):
    plans, land = [], queries._land
    monkeypatch.setattr(queries, "_land", lambda df, *to: (plans.append(plan_of(df)), land(df, *to)))
    sf_dir = "/root/testdata/sf0.001"
    queries._land_sales(spark, sf_dir, 1, folder)
    assert "upper(" not in plans[0]
    place = f"{folder}/{queries.FEEDS['sales'].folder}"
    assert 0 < len(files_in(spark, place, ".csv")) <= 8
    landed = spark.read.option("header", True).csv(place).withColumn("file", F.col("_metadata.file_path"))
    assert landed.groupBy(F.upper(F.trim("transaction_id"))).agg(F.countDistinct("file").alias("n")).where("n > 1").isEmpty()
    delivery = queries._part(queries.feed(spark, sf_dir, "sales"), 1)
    assert landed.count() == delivery.count()
