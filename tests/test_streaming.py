from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException

from tillwork.plans import clean, marts
from tillwork.operators.diff import CHANGE
from tillwork.sources import tables
from tillwork.sources.tables import compact, expire_versions, read_table, write_table
from tillwork.streaming.alerts import stream_low_stock
from tillwork.streaming.clicks import stream_clickstream
from tillwork.streaming.progress import GENERATION, current_rows, follow_table

START = datetime(2026, 1, 1)
RAW = ("customer_id string, device_type string, event_id string, event_type string, page_url string,"
       " product_id string, session_id string, timestamp string, _rescued_data string, ingesttime timestamp, file_name string")


def click(number, minute, event="add_to_cart", product="p1", spelling="e{}"):
    return ("c1", "desktop", spelling.format(number), event, "/", product, "S", "2026-01-01T00:00:00", None,
            START + timedelta(minutes=minute), f"f{minute}")


def drain(spark, df, folder):
    query = (df.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start())
    query.awaitTermination()


def test_click_stream_equals_batch_on_copies(spark, folder, layers):
    waves = [[click(i, 0) for i in range(50)] + [click(i, 0, spelling=" E{} ") for i in range(50)],
             [click(i, 30) for i in range(25, 75)], [click(0, 40)] * 100]
    table = layers("silver", "clicks")
    late = [click(500, -3 * 24 * 60)]  # three days behind the newest
    for wave in [*waves, late]:
        spark.createDataFrame(wave, RAW).repartition(4).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(RAW).parquet(f"{folder}/in")
        stream_clickstream(source, table, f"{folder}/ck")
    batch = clean.bronze_clickstream(spark.read.parquet(f"{folder}/in"))
    names = [n for n in batch.columns if n not in ("_ingest_timestamp", "_source_file", "_silver_processed_at")]
    assert rows(read_table(spark, table), *names) == rows(batch, *names)
    assert batch.count() == 76


def test_alert_stream_equals_batch(spark, folder, layers):
    clicks, products, inventory, alerts = (layers("gold", n) for n in ("clicks", "products", "inventory", "alerts"))
    write_table(spark.createDataFrame([("P1", 10), ("P2", 10)], "product_id string, reorder_threshold int"), products, "merge", "product_id")
    stock = spark.createDataFrame([("P1", 3), ("P2", 50)], "product_id string, stock_quantity int")
    write_table(marts.stamped(stock), inventory, "append")

    def add(*found):
        silver = clean.bronze_clickstream(spark.createDataFrame(list(found), RAW))
        write_table(marts.transfer_silver_to_gold_fact_clicks(silver), clicks, "append", "event_id")

    def run():
        stream_low_stock(spark, clicks, products, inventory, alerts, f"{folder}/ck")
        return rows(read_table(spark, alerts), "event_id", "available_stock")

    add(click(1, 0), click(2, 0, product="p2"), click(3, 0, event="purchase"))
    assert run() == [("E1", 3)]
    add(click(4, 5), click(1, 5))
    assert run() == run() == [("E1", 3), ("E4", 3)]
    batch = marts.low_stock_alert(read_table(spark, products), read_table(spark, clicks), read_table(spark, inventory))
    assert rows(batch, "event_id", "available_stock") == run()
    # A new snapshot counts for clicks that come after it.
    write_table(marts.stamped(spark.createDataFrame([("P1", 99), ("P2", 1)], stock.schema)), inventory, "append")
    add(click(6, 9), click(7, 9, product="p2"))
    assert run() == [("E1", 3), ("E4", 3), ("E7", 1)]


def test_low_stock_on_a_streaming_frame(spark, folder):
    products = spark.createDataFrame([("P1", 10)], "product_id string, reorder_threshold int")
    stock = spark.createDataFrame([("P1", 3)], "product_id string, stock_quantity int")
    silver = clean.bronze_clickstream(spark.createDataFrame([click(1, 0), click(2, 0, event="search")], RAW))
    facts = marts.transfer_silver_to_gold_fact_clicks(silver)
    facts.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(facts.schema).parquet(f"{folder}/in")
    drain(spark, marts.low_stock_alert(products, stream, stock), folder)
    assert rows(spark.read.parquet(f"{folder}/out"), "event_id") == [("E1",)]


def test_alerts_go_on_after_compaction_and_expiry(spark, folder, layers):
    clicks, products, inventory, alerts = (layers("gold", n) for n in ("clicks", "products", "inventory", "alerts"))
    write_table(spark.createDataFrame([("P1", 10)], "product_id string, reorder_threshold int"), products, "merge", "product_id")
    stock = "product_id string, stock_quantity int"
    for number, quantity in enumerate((50, 3, 2)):
        write_table(marts.stamped(spark.createDataFrame([("P1", quantity)], stock)), inventory, "append")
        silver = clean.bronze_clickstream(spark.createDataFrame([click(number, 0)], RAW))
        write_table(marts.transfer_silver_to_gold_fact_clicks(silver), clicks, "append", "event_id")
        for table in (inventory, clicks) if number == 2 else ():
            compact(spark, table)
            expire_versions(spark, table, keep=2)
        stream_low_stock(spark, clicks, products, inventory, alerts, f"{folder}/ck")
    assert rows(read_table(spark, alerts), "event_id", "available_stock") == [("E1", 3), ("E2", 2)]


def test_the_click_stream_keeps_its_state(spark, folder, layers, monkeypatch):
    """After a batch that failed once its rows were published, nothing is lost or doubled."""
    table = layers("silver", "clicks")

    def run(found):
        if found:
            spark.createDataFrame(found, RAW).write.mode("append").parquet(f"{folder}/in")
        stream_clickstream(spark.readStream.schema(RAW).parquet(f"{folder}/in"), table, f"{folder}/ck")

    run([click(1, 0), click(1, 1), click(2, 0)])
    real = tables.write_table

    def dies(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("killed")

    monkeypatch.setattr("tillwork.streaming.clicks.write_table", dies)
    with pytest.raises(StreamingQueryException):
        run([click(2, 5), click(3, 5)])
    monkeypatch.setattr("tillwork.streaming.clicks.write_table", real)
    run([])
    run([click(i, 9) for i in (1, 2, 3, 4)])
    assert rows(read_table(spark, table), "event_id") == [("E1",), ("E2",), ("E3",), ("E4",)]
    state = [p for p in Path(f"{folder.removeprefix('file:')}/ck/state").rglob("*") if p.suffix in (".zip", ".changelog")]
    assert state  # RocksDB's


def follow(spark, table, folder, step):
    follow_table(spark, table, f"{folder}/ck", lambda changes, _: step(changes))


def test_followers_get_rows_before_and_after(spark, folder, layers):
    table, seen, kv = layers("silver", "t"), [], "k string, v int"

    def run():
        follow(spark, table, folder, lambda c: seen.extend(rows(c, "k", "v", CHANGE)))

    write_table(spark.createDataFrame([("a", 1), ("b", 1)], kv), table, "append", "k", newer_by="v")
    run()
    compact(spark, table)
    run()
    assert seen == [("a", 1, "insert"), ("b", 1, "insert")]
    write_table(spark.createDataFrame([("a", 3), ("b", 0), ("c", 1)], kv), table, "append", "k", newer_by="v")
    write_table(
        spark.createDataFrame([("c", 9)], kv), table, "merge", "k", replaced_keys=spark.createDataFrame([("b",)], "k string")
    )
    run()
    assert sorted(seen[2:]) == sorted([
        ("a", 1, "update_pre"), ("a", 3, "update_post"), ("b", 1, "delete"), ("c", 1, "insert"), ("c", 1, "update_pre"),
        ("c", 9, "update_post")])


def test_the_feed_replayed_on_an_old_state_gives_the_new_one(spark, folder, layers):
    table, copy, kv = layers("silver", "t"), layers("silver", "copy"), "k string, v int"

    def replay(changes):
        write_table(
            current_rows(changes, ["k"]), copy, "merge", "k", check_unique=False,
            replaced_keys=changes.select("k").distinct(),
        )

    steps = [
        lambda: write_table(spark.range(20).selectExpr("string(id) k", "int(id) v"), table, "merge", "k"),
        lambda: write_table(spark.createDataFrame([("3", -3), ("99", 9)], kv), table, "merge", "k"),
        lambda: write_table(spark.createDataFrame([], kv), table, "merge", "k", replaced_keys=spark.createDataFrame([("3",), ("4",)], "k string")),
        lambda: write_table(spark.createDataFrame([("3", 33)], kv), table, "append", "k"),
        lambda: write_table(spark.createDataFrame([("1", 1), ("99", 10), ("5", None)], kv), table, "overwrite", "k"),
    ]
    for number, step in enumerate(steps):
        step()
        if number != 1:  # some writes are replayed together
            follow(spark, table, folder, replay)
            assert rows(read_table(spark, copy)) == rows(read_table(spark, table))
    write_table(spark.createDataFrame([("x", 1)], kv), table, "overwrite")
    follow(spark, table, folder, replay)
    assert rows(read_table(spark, copy)) == [("x", 1)]


def test_follow_table_hands_over_only_new_rows(spark, folder, layers):
    table, seen = layers("silver", "t"), []
    for value in ("a", "b"):
        write_table(spark.createDataFrame([(value,)], "v string"), table, "append")
        for _ in range(2):
            follow(spark, table, folder, lambda batch: seen.extend(r["v"] for r in batch.collect()))
    assert seen == ["a", "b"]
