import uuid
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tillwork.operators.diff import CHANGE, table_diff
from tillwork.operators.clustering import clustered
from tillwork.sources import tables
from tillwork.sources.tables import (
    compact,
    create_layers,
    expire_versions,
    file_sizes,
    generations,
    read_table,
    same_key,
    table_folder,
    write_table,
)

KV = "k string, v string"


def frame(spark, *data, schema=KV):
    return spark.createDataFrame(list(data), schema)


def test_arguments(spark, layers):
    df = frame(spark, ("1", "a"))
    with pytest.raises(ValueError, match="unknown write mode"):
        write_table(df, layers("silver", "t"), "upsert", "k")
    with pytest.raises(ValueError, match="merge_key"):
        write_table(df, layers("silver", "t"), "merge")
    assert not spark.catalog.tableExists(layers("silver", "t"))


def test_layers_may_exist(spark, folder):
    create_layers(spark, folder, "again_")
    create_layers(spark, folder, "again_")
    assert spark.catalog.databaseExists("again_gold")


def test_upsert_with_missing_keys_twice(spark, layers):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a"), (None, "n")), table, "MERGE", "k")
    source = frame(spark, ("1", "b"), (None, "m"), ("3", "c"))
    for _ in range(2):
        write_table(source, table, "merge", ["k"])
        assert rows(read_table(spark, table)) == [("1", "b"), ("3", "c"), (None, "m")]


def test_upsert_on_several_keys_and_a_missing_part(spark, layers):
    table, schema = layers("gold", "t"), "d string, c string, v int"
    write_table(frame(spark, ("1", None, 1), ("1", "x", 2), (None, None, 3), schema=schema), table, "merge", ["d", "c"], ["d", "c"])
    write_table(frame(spark, ("1", None, 10), (None, None, 30), (None, "x", 4), schema=schema), table, "merge", ["d", "c"], ["d", "c"])
    assert rows(read_table(spark, table)) == sorted(
        [("1", None, 10), ("1", "x", 2), (None, None, 30), (None, "x", 4)], key=repr)


def test_merge_source_must_be_unique_and_whole(spark, layers):
    table = layers("silver", "t")
    twice = frame(spark, ("1", "a"), ("1", "b"))
    with pytest.raises(ValueError, match="several rows"):
        write_table(twice, table, "merge", "k")
    assert not spark.catalog.tableExists(table)
    write_table(frame(spark, ("1", "a")), table, "merge", "k")
    with pytest.raises(ValueError, match="several rows"):
        write_table(twice, table, "merge", "k")
    with pytest.raises(ValueError, match="missing"):
        write_table(frame(spark, ("1",), schema="k string"), table, "merge", "k")
    assert rows(read_table(spark, table)) == [("1", "a")]


def test_source_may_be_the_table_itself(spark, layers):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a"), ("2", "b")), table, "merge", "k")
    write_table(read_table(spark, table).withColumn("v", F.upper("v")), table, "merge", "k")
    assert rows(read_table(spark, table)) == [("1", "A"), ("2", "B")]
    write_table(read_table(spark, table).filter("k = '2'"), table, "overwrite")
    assert rows(read_table(spark, table)) == [("2", "B")]


def test_append_and_append_new(spark, layers):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a")), table, "append")
    write_table(frame(spark, ("1", "a")), table, "append")
    assert read_table(spark, table).count() == 2
    keyed = layers("silver", "keyed")
    for _ in range(2):
        write_table(frame(spark, ("1", "a"), (None, "n")), keyed, "append", "k")
    write_table(frame(spark, ("1", "changed"), ("2", "b"), (None, "m")), keyed, "append", "k")
    assert rows(read_table(spark, keyed)) == [("1", "a"), ("2", "b"), (None, "n")]


@pytest.mark.parametrize("mode", ["append", "overwrite", "merge"])
def test_new_columns_are_added(spark, layers, mode):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a")), table, mode, "k")
    write_table(frame(spark, ("2", "b", 7), schema="k string, v string, n int"), table, mode, "k")
    old = [] if mode == "overwrite" else [("1", "a", None)]
    assert rows(read_table(spark, table)) == [*old, ("2", "b", 7)]
    assert [t for _, t in read_table(spark, table).dtypes] == ["string", "string", "int"]


def test_overwrite_keeps_dropped_columns_as_nulls(spark, layers):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a")), table, "overwrite")
    write_table(frame(spark, ("2",), schema="k string"), table, "overwrite")
    assert rows(read_table(spark, table)) == [("2", None)]


def test_newer_rows_replace_older_ones_in_any_order(spark, layers):
    versions = [("1", 1, "a"), ("1", 3, "c"), ("1", 2, "b"), ("2", None, "n"), ("2", 1, "x"), (None, 1, "y"), (None, 0, "z")]
    for order in (versions, versions[::-1], versions[3:] + versions[:3]):
        table = layers("silver", f"t{uuid.uuid4().hex[:6]}")
        for row in order:
            write_table(frame(spark, row, schema="k string, at int, v string"), table, "append", "k", newer_by="at")
        assert rows(read_table(spark, table), "k", "v") == [("1", "c"), ("2", "x"), (None, "y")]


def test_replaced_keys_take_their_rows_along(spark, layers):
    table = layers("gold", "t")
    write_table(frame(spark, ("1", "a"), ("2", "b"), ("3", "c")), table, "merge", "k")
    gone = frame(spark, ("1",), ("2",), ("8",), schema="k string")
    write_table(frame(spark, ("2", "B")), table, "merge", "k", replaced_keys=gone)
    assert rows(read_table(spark, table)) == [("2", "B"), ("3", "c")]


def test_a_batch_counts_once(spark, layers):
    table = layers("bronze", "t")
    for name in ("b1", "b1", "b2"):
        write_table(frame(spark, (name, "x")), table, "append", batch=name)
    assert rows(read_table(spark, table)) == [("b1", "x"), ("b2", "x")]


def files_of(spark, table):
    return set(read_table(spark, table).inputFiles())


def test_a_small_delivery_of_new_keys_only_adds_files(spark, layers):
    table = layers("silver", "t")
    write_table(spark.range(1000).selectExpr("string(id) k", "id v"), table, "append", "k", newer_by="v")
    before = files_of(spark, table)
    write_table(spark.range(1000, 1010).selectExpr("string(id) k", "id v"), table, "append", "k", newer_by="v")
    assert before < files_of(spark, table)


def test_one_corrected_row_rewrites_one_bucket(spark, layers):
    """Bytes written follow the delivery: of 200 buckets one is written anew."""
    table = layers("silver", "t")
    write_table(spark.range(40_000).selectExpr("string(id) k", "id v"), table, "merge", "k", buckets=200)
    before, sizes = files_of(spark, table), file_sizes(spark, table).agg(F.sum("bytes")).first()[0]
    write_table(spark.sql("SELECT '77' k, -1L v"), table, "merge", "k")
    added = files_of(spark, table) - before
    assert len(before - files_of(spark, table)) == len(added) == 1
    folder = Path(f"{table_folder(spark, table).removeprefix('file:')}/{generations(spark, table)[-1]}")
    written = sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    assert written < sizes / 50
    assert rows(read_table(spark, table).filter("v < 0 OR k = '78'")) == [("77", -1), ("78", 78)]
    assert read_table(spark, table).count() == 40_000


def test_whole_rows_stay_where_they_are_in_large_keyed_writes(spark, layers, monkeypatch):
    """Kept rows are written by the tasks that read them, and states agree with those of a dict."""
    monkeypatch.setattr(tables, "SPREAD_BYTES", 0)
    monkeypatch.setattr(tables, "PASS_CHUNKS", 2)  # several passes
    plans, keep = [], tables._Write.keep
    monkeypatch.setattr(tables._Write, "keep", lambda write, laid: (plans.append(plan_of(laid)), keep(write, laid)))
    table, schema = layers("silver", "t"), "k string, at int, v string"
    expected: dict = {}

    def offer(numbers, at, mode, **options):
        given = [(None if i == 50 else str(i), at + i % 3, f"{mode} {at}") for i in numbers]
        write_table(frame(spark, *given, schema=schema).repartition(3), table, mode, "k", check_unique=False, **options)
        return {k: (at, v) for k, at, v in given}

    expected |= offer(range(0, 2000), 5, "append", buckets=2)
    expected |= offer(range(1500, 2500), 1, "merge")
    newer = offer(range(0, 2600, 7), 4, "append", newer_by="at")
    expected |= {k: row for k, row in newer.items() if k not in expected or row[0] > expected[k][0]}
    assert any(newer[k] != expected[k] for k in newer)  # some stayed
    expected = {**offer(range(0, 3000, 5), 9, "append"), **expected}
    gone = frame(spark, *[(str(i),) for i in range(100, 400)], (None,), schema="k string")
    merged = offer(range(300, 500), 20, "merge", replaced_keys=gone.unionAll(gone))
    expected = {k: row for k, row in expected.items() if k is not None and not 100 <= int(k) < 400} | merged
    state = {r["k"]: (r["at"], r["v"]) for r in read_table(spark, table).collect()}
    assert state == expected and read_table(spark, table).count() == len(expected)
    expected = offer(range(0, 1000, 2), 30, "overwrite")
    assert {r["k"]: (r["at"], r["v"]) for r in read_table(spark, table).collect()} == expected
    assert len(plans) > 8
    assert not [p for p in plans if "Exchange" in p.replace("BroadcastExchange", "")]


def test_digests_tell_missing_values_apart(spark, layers):
    table, schema = layers("gold", "t"), "k string, a string, b string"
    write_table(frame(spark, ("1", None, "x"), ("2", "y", None), schema=schema), table, "overwrite", "k")
    write_table(frame(spark, ("1", "x", None), ("2", "y", None), schema=schema), table, "overwrite", "k")
    assert rows(read_table(spark, table)) == [("1", "x", None), ("2", "y", None)]


def test_upserts_read_the_buckets_of_their_keys(spark, layers):
    table = layers("silver", "t")
    write_table(spark.range(400).selectExpr("string(id) k", "id v"), table, "merge", "k", buckets=40)
    stored = tables._stored(spark, table)
    one = stored.where(F.col(tables.BUCKET).isin([7]))
    assert 0 < len(one.inputFiles()) < len(stored.inputFiles()) / 10
    assert len(tables._in_places(stored, [(7, generations(spark, table)[0])]).inputFiles()) == len(one.inputFiles())


@pytest.mark.parametrize("fails_in", ["move_folder", "_apply"])
@pytest.mark.parametrize("mode", ["append", "merge", "overwrite"])
def test_a_write_that_dies_before_it_is_published(spark, layers, monkeypatch, mode, fails_in):
    """Readers see the old rows until the retry, and then the new ones once."""
    table, old = layers("silver", "t"), [("1", "a"), ("2", "b")]
    keys = None if mode == "append" else "k"
    write_table(frame(spark, *old), table, "append", keys)

    def die(*_):
        raise RuntimeError("killed")

    new = frame(spark, ("2", "B"), ("3", "c"))
    with monkeypatch.context() as patch:
        patch.setattr(tables, fails_in, die)
        with pytest.raises(RuntimeError, match="killed"):
            write_table(new, table, mode, keys, batch="b1")
        assert rows(read_table(spark, table)) == old
    expected = {
        "append": [*old, ("2", "B"), ("3", "c")], "merge": [("1", "a"), ("2", "B"), ("3", "c")],
        "overwrite": [("2", "B"), ("3", "c")],
    }[mode]
    for _ in range(2):
        write_table(new, table, mode, keys, batch="b1")
        assert rows(read_table(spark, table)) == sorted(expected, key=repr)


def test_the_next_writer_finishes_a_published_write(spark, layers, monkeypatch):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a")), table, "merge", "k")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_apply", lambda *_: None)
        write_table(frame(spark, ("1", "b"), ("2", "b")), table, "merge", "k")
    write_table(frame(spark, ("3", "c")), table, "merge", "k")
    assert rows(read_table(spark, table)) == [("1", "b"), ("2", "b"), ("3", "c")]


def test_tables_are_found_again_by_a_new_catalog(spark, folder):
    create_layers(spark, folder, "first_")
    write_table(frame(spark, ("1", "a")), "first_gold.t", "merge", "k")
    write_table(frame(spark, ("1", "b", 7), schema="k string, v string, n int"), "first_gold.t", "merge", "k")
    create_layers(spark, folder, "second_")
    assert rows(read_table(spark, "second_gold.t")) == [("1", "b", 7)]
    write_table(frame(spark, ("2", "c", 8), schema="k string, v string, n int"), "second_gold.t", "append", "k")
    create_layers(spark, folder, "first_")
    assert rows(read_table(spark, "first_gold.t")) == [("1", "b", 7), ("2", "c", 8)]


def test_old_generations_can_be_removed(spark, folder, layers):
    table = layers("silver", "t")
    for value in "abc":
        write_table(frame(spark, ("1", value)), table, "merge", "k", buckets=1)
    write_table(frame(spark, ("2", "d")), table, "merge", "k")
    before = generations(spark, table)
    expire_versions(spark, table, keep=1)
    assert generations(spark, table) == before[2:] and rows(read_table(spark, table)) == [("1", "c"), ("2", "d")]
    write_table(frame(spark, ("2", "e")), table, "merge", "k")
    # A new catalog finds the same state.
    create_layers(spark, folder, "expired_")
    assert rows(read_table(spark, "expired_silver.t")) == [("1", "c"), ("2", "e")]


def test_removed_and_overwritten_rows_stay_away_in_a_new_catalog(spark, folder, layers):
    table = layers("gold", "t")
    write_table(frame(spark, ("1", "a"), ("2", "b")), table, "merge", "k")
    write_table(frame(spark, schema=KV), table, "merge", "k", replaced_keys=frame(spark, ("1",), schema="k string"))
    plain = layers("gold", "plain")
    for value in "ab":
        write_table(frame(spark, (value, value)), plain, "append")
    write_table(frame(spark, ("c", "c")), plain, "overwrite")
    expire_versions(spark, table, keep=1)
    create_layers(spark, folder, "removed_")
    assert rows(read_table(spark, "removed_gold.t")) == [("2", "b")]
    assert rows(read_table(spark, "removed_gold.plain")) == [("c", "c")]


def test_old_readers_keep_their_files(spark, layers):
    table = layers("silver", "t")
    write_table(frame(spark, ("1", "a")), table, "merge", "k")
    before = spark.read.parquet(*files_of(spark, table))
    write_table(frame(spark, ("1", "b")), table, "merge", "k")
    assert rows(before) == [("1", "a")] and rows(read_table(spark, table)) == [("1", "b")]


def test_a_keyed_overwrite_writes_what_differs(spark, layers):
    table, schema = layers("gold", "t"), "k string, v string, _gold_updated_at int"
    write_table(frame(spark, *[(str(i), "a", 1) for i in range(50)], schema=schema), table, "overwrite", "k", buckets=16)
    before = files_of(spark, table)
    write_table(frame(spark, *[(str(i), "a", 2) for i in range(50)], schema=schema), table, "overwrite", "k")
    assert files_of(spark, table) == before
    write_table(frame(spark, *[(str(i), "b" if i == 7 else "a", 3) for i in range(1, 51)], schema=schema), table, "overwrite", "k")
    assert len(before & files_of(spark, table)) >= len(before) - 2
    assert read_table(spark, table).count() == 50
    assert rows(read_table(spark, table).filter("v = 'b' OR k IN ('0', '50')")) == [("50", "a", 3), ("7", "b", 3)]


def test_compaction_leaves_large_files_alone(spark, layers):
    table = layers("silver", "t")
    write_table(spark.range(50_000).selectExpr("string(id) k", "id v").coalesce(1), table, "append")
    large = files_of(spark, table)
    for at in range(3):
        write_table(spark.range(at * 10, at * 10 + 10).selectExpr("string(id) k", "-id v"), table, "append", option_dict={"maxRecordsPerFile": "2"})
    state = rows(read_table(spark, table))
    size = Path(next(iter(large)).removeprefix("file://")).stat().st_size
    compact(spark, table, ["k", "v"], target_bytes=size)
    left = files_of(spark, table)
    assert large < left and len(left) == len(large) + 1 and rows(read_table(spark, table)) == state
    compact(spark, table, target_bytes=size)
    assert files_of(spark, table) == left


def test_compaction_gives_no_task_more_rows_than_it_can_hold(spark, layers):
    """Rows that all look alike pack to next to nothing; they are still cut, and not compacted again."""
    table, text = layers("silver", "t"), "'x' || repeat('y', 200)"
    for _ in range(3):
        packed = spark.range(20_000).selectExpr("id % 100 k", f"{text} v", "array(id % 2) a")
        write_table(packed, table, "append", option_dict={"maxRecordsPerFile": "5000"})
    compact(spark, table, ["k"], target_bytes=1 << 20)
    left = files_of(spark, table)
    per_file = read_table(spark, table).groupBy("_metadata.file_path").agg(F.sum(F.octet_length("v")).alias("bytes"))
    assert len(left) >= 4 and per_file.agg(F.max("bytes")).first()[0] < 1.5 * 3 * (1 << 20)
    assert read_table(spark, table).count() == 60_000
    compact(spark, table, ["k"], target_bytes=1 << 20)
    assert files_of(spark, table) == left


def test_several_cluster_keys_all_narrow_the_files(spark, folder):
    """Row-group ranges of the second key are narrower than under a plain sort of both."""
    df = spark.range(0, 40_000, 1, 4).selectExpr("lpad(string(hash(id) % 5000), 6, '0') a", "hash(id, 7) % 5000 b")

    def width(laid, name):
        laid.write.parquet(f"{folder}/{name}")
        per_file = spark.read.parquet(f"{folder}/{name}").groupBy("_metadata.file_path").agg((F.max("b") - F.min("b")).alias("w"))
        return per_file.agg(F.avg("w")).first()[0]

    plain = width(df.repartitionByRange(16, "a", "b").sortWithinPartitions("a", "b"), "plain")
    z = width(clustered(df, ["a", "b"], partitions=16), "z")
    assert z < plain * 0.5
    assert rows(spark.read.parquet(f"{folder}/z").groupBy("a", "b").count()) == rows(df.groupBy("a", "b").count())


def test_options_reach_the_writer(spark, layers):
    table = layers("silver", "t")
    write_table(spark.range(10).coalesce(1), table, "append", option_dict={"maxRecordsPerFile": "2", "compression": "gzip"})
    files = read_table(spark, table).inputFiles()
    assert len(files) >= 5 and all(".gz." in f for f in files)
    compact(spark, table)
    assert len(read_table(spark, table).inputFiles()) < len(files)
    assert read_table(spark, table).count() == 10


def test_clustering_sorts_and_splits_a_hot_value(spark):
    """Two thirds of the rows share one value; no task gets them all."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 40000, 1, 4).select(
            F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id") % 10).alias("k"), "id")
        laid = clustered(df, ["k"]).withColumn("task", F.spark_partition_id())
        hot = laid.filter("k = 5").groupBy("task").count().collect()
        assert laid.count() == 40000 and len(hot) >= 4 and max(r["count"] for r in hot) < 9000
        ranges = laid.groupBy("task").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo", "hi").collect()
        assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_keyed_writes_use_equi_joins(spark, folder):
    spark.range(10).selectExpr("string(id) k", "id v").write.parquet(f"{folder}/a")
    spark.range(10).selectExpr("string(id) k", "id v").write.parquet(f"{folder}/b")
    a, b = spark.read.parquet(f"{folder}/a"), spark.read.parquet(f"{folder}/b")
    anti = plan_of(a.join(b.select("k"), same_key(a, b, ["k"]), "left_anti"))
    assert "BroadcastHashJoin" in anti and "NestedLoop" not in anti
    assert "v" not in anti[anti.rindex("ReadSchema"):]
    assert "SortMergeJoin" in plan_of(table_diff(a, b, ["k"]))


def test_table_diff(spark):
    old = frame(spark, ("1", "a"), ("2", "b"), ("4", "x"), (None, "n"), ("5", None))
    new = frame(spark, ("1", "a"), ("2", "c"), ("3", "d"), (None, "m"), ("5", None))
    assert rows(table_diff(old, new, ["k"])) == sorted([
        ("update_pre", "2", "b"), ("update_post", "2", "c"), ("insert", "3", "d"), ("delete", "4", "x"),
        ("update_pre", None, "n"), ("update_post", None, "m")], key=repr)
    assert table_diff(new, new, ["k"]).isEmpty()
    assert table_diff(old, new.select("v", "k"), ["k"]).columns == [CHANGE, "v", "k"]
