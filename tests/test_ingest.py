import json
import os
import time
from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from tillwork.sources.ingest import _headers, ingest_raw_to_bronze
from tillwork.sources.landing import land_csv, land_json_array, land_json_lines
from tillwork.sources.schemas import text_schema
from tillwork.sources.tables import compact, create_layers, read_table, write_table
from tillwork.sources.types import wider

SCHEMA = text_schema(["id", "name"])


class Landing:
    def __init__(self, spark, folder, layers, file_format, options=None, **extra):
        self.spark, self.path, self.format, self.options, self.extra = (
            spark, Path(folder) / "landing", file_format, options, extra)
        self.folder, self.table = folder, layers("bronze", "feed")
        self.path.mkdir(parents=True)

    def put(self, name, content):
        (self.path / name).write_text(content)

    def run(self, *columns):
        ingest_raw_to_bronze(self.spark, str(self.path), self.table, f"{self.folder}/checkpoint", self.format,
                             self.options, **self.extra)
        return rows(read_table(self.spark, self.table), *columns)


def test_csv_counts_each_file_once(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA)
    feed.put("a.csv", "id,name\n1, a \n2,\"x,y\"\n")
    feed.put("b.csv", "id,name\n3,\n")
    first = [("1", " a "), ("2", "x,y"), ("3", None)]
    assert feed.run("id", "name") == first
    feed.put("c.csv", "id,name\n4,d\n")
    for _ in range(2):
        assert feed.run("id", "name") == [*first, ("4", "d")]
    table = read_table(spark, feed.table)
    assert table.columns == ["id", "name", "_rescued_data", "ingesttime", "file_name", "file_time"]
    assert table.filter("ingesttime IS NULL OR file_name NOT LIKE '%/landing/%.csv'").isEmpty()
    assert table.select("file_name").distinct().count() == 3


ODD_NAMES = ("a1", "a[1]", "b {x,y} +%41 ü", "what?", "c*", "d\\e", "[!f]")


def test_names_of_files_are_no_patterns(spark, folder, layers):
    """Each file counts once, whatever other file its name would match as a pattern."""
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA)
    for number, name in enumerate(ODD_NAMES):
        feed.put(f"{name}.csv", f"id,name\n{number},x\n")
    expected = [(str(i),) for i in range(len(ODD_NAMES))]
    for _ in range(2):
        assert feed.run("id") == expected


@pytest.mark.parametrize("options", [{}, {"multiLine": "true"}])
def test_names_of_json_files_are_no_patterns(spark, folder, layers, options):
    feed = Landing(spark, folder, layers, "json", options, schema=SCHEMA)
    for number, name in enumerate(ODD_NAMES):
        feed.put(f"{name}.json", json.dumps({"id": str(number), "name": "x"}) + "\n")
    assert feed.run("id") == [(str(i),) for i in range(len(ODD_NAMES))]


def test_files_in_subfolders_count_if_asked_for(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA)
    (feed.path / "[sub]").mkdir()
    feed.put("a.csv", "id,name\n1,a\n")
    feed.put("[sub]/b.csv", "id,name\n2,b\n")
    assert feed.run("id") == [("1",)]
    feed.options, feed.folder, feed.table = {"recursiveFileLookup": "true"}, f"{feed.folder}/again", f"{feed.table}_again"
    assert feed.run("id") == [("1",), ("2",)]


def test_a_lone_file_with_a_pattern_for_a_name(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", {"inferSchema": "true"})
    feed.put("a[1].csv", "id,name\n1,a\n")
    assert feed.run("id", "name") == [(1, "a")]


def test_headers_are_found_by_one_job(spark, folder, layers):
    """Hundreds of files, three headers: the number of jobs does not follow the files."""
    feed = Landing(spark, folder, layers, "csv", schema=text_schema(["id", "name", "more"]))
    for i in range(300):
        head, row = (("id,name", f"{i},n"), ("name,id", f"n,{i}"), ('"id","name","more"', f'{i},n,"x,y"'))[i % 3]
        feed.put(f"{i}.csv", f"\n{head}\n{row}\n")
    files = [f"file:{p}" for p in feed.path.iterdir()]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    groups = _headers(spark, files, {"header": "true"})
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert {k: len(v) for k, v in groups.items()} == {("id", "name"): 100, ("name", "id"): 100, ("id", "name", "more"): 100}
    assert jobs < 12
    found = feed.run("id", "name", "more")
    assert found == sorted([(str(i), "n", "x,y" if i % 3 == 2 else None) for i in range(300)], key=repr)


def test_headers_with_other_separators_and_comments(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", {"sep": "|", "comment": "#"}, schema=text_schema(["id", "a|b", "c"]))
    feed.put("a.csv", '# made today\nid|"a|b"|c\n1|x|y\n')
    assert feed.run("id", "`a|b`", "c") == [("1", "x", "y")]


def test_csv_takes_columns_from_the_first_files(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", {"sep": ";"})
    feed.put("a.csv", "id;name\n1;a\n")
    assert feed.run("id", "name", "_rescued_data") == [("1", "a", None)]


def test_csv_new_column(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA)
    feed.put("a.csv", "id,name\n1,a\n")
    feed.run()
    feed.put("b.csv", "id,name,age,city\n2,b,7,Rome\n")
    feed.put("c.csv", "id,name\n3,c\n")
    feed.put("d.csv", "id,name,age\n4,d,9\n5,e,9,x,y\n")
    found = feed.run("id", "name", "age", "city", "_rescued_data")
    assert found[:4] == [("1", "a", None, None, None), ("2", "b", "7", "Rome", None),
                         ("3", "c", None, None, None), ("4", "d", "9", None, None)]
    # Values beyond a file's own header have no column.
    assert found[4][:4] == ("5", "e", "9", None) and "x,y" in found[4][4]
    feed.put("e.csv", "id,name,age,city\n6,f,8,Oslo\n")
    assert feed.run("id", "city")[-1] == ("6", "Oslo")


def test_csv_columns_go_by_name(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=text_schema(["id", "name", "age"]))
    feed.put("a.csv", "id,age,name\n1,7,a\n")
    feed.put("b.csv", "NAME,Id\nb,2\n")
    feed.put("c.csv", "id,name\nid,name\n3,c\n")
    feed.put("d.csv", "id,name,Name\n4,d,other\n")
    feed.put("e.csv", "")
    assert feed.run("id", "name", "age", "_rescued_data") == [
        ("1", "a", "7", None), ("2", "b", None, None), ("3", "c", None, None), ("4", "d", None, '{"Name":"other"}'),
        ("id", "name", None, None)]


def test_csv_unknown_columns_of_a_fixed_feed_are_rescued(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA, add_new_columns=False)
    feed.put("a.csv", "city,id,name\nRome,1,a\n,2,b\n")
    assert feed.run("id", "name", "_rescued_data") == [("1", "a", '{"city":"Rome"}'), ("2", "b", None)]


def test_files_count_whatever_their_age(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA)
    feed.put("a.csv", "id,name\n1,a\n")
    feed.run()
    for name, days, content in (("b.csv", 10, "id,name\n2,b\n"), ("c.csv", 400, "id,name,old\n3,c,x\n")):
        feed.put(name, content)
        then = time.time() - days * 86400
        os.utime(feed.path / name, (then, then))
    for _ in range(2):
        assert feed.run("id", "name", "old") == [("1", "a", None), ("2", "b", None), ("3", "c", "x")]


def test_types_are_inferred_once_and_misfits_rescued(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", {"inferSchema": "true"})
    feed.put("a.csv", "id,price,name\n1,2.5,a\n")
    feed.run()
    feed.put("b.csv", "id,price,name\n2,free,7\n")
    assert feed.run("id", "price", "name", "_rescued_data") == [
        (1, 2.5, "a", None), (2, None, "7", '{"price":"free"}')]


@pytest.mark.parametrize("a, b, both", [
    ("int", "bigint", "bigint"), ("bigint", "decimal(10,2)", "decimal(22,2)"), ("int", "decimal(3,2)", "decimal(12,2)"),
    ("decimal(5,4)", "decimal(8,1)", "decimal(11,4)"), ("decimal(38,0)", "decimal(5,4)", "double"), ("int", "double", "double"),
    ("decimal(20,0)", "double", "double"), ("double", "string", "string"), ("boolean", "int", "string"),
    ("date", "timestamp", "timestamp"), ("date", "int", "string"), ("float", "double", "double")])
def test_the_wider_of_two_types(a, b, both):
    a, b, both = (StructType.fromDDL(f"x {t}")["x"].dataType for t in (a, b, both))
    assert wider(a, b) == wider(b, a) == both and wider(both, a) == wider(both, b) == both


def test_types_widen_and_nothing_is_rescued(spark, folder, layers):
    """Whole numbers, then large ones, then decimals, then text; files that fit stay as they are."""
    feed = Landing(spark, folder, layers, "csv", {"inferSchema": "true"}, widen_types=True)
    steps = [("1,7", "int"), ("2,3000000000", "bigint"), ("3,2.5", "double"), ("4,free", "string"), ("5,8", "string")]
    values = [["7"], ["7", "3000000000"], ["7.0", "3.0E9", "2.5"], ["7.0", "3.0E9", "2.5", "free"], ["7.0", "3.0E9", "2.5", "free", "8"]]
    for number, ((line, kind), expected) in enumerate(zip(steps, values)):
        before = set(read_table(spark, feed.table).inputFiles()) if number else set()
        feed.put(f"{number}.csv", f"id,price\n{line}\n")
        feed.run()
        table = read_table(spark, feed.table)
        assert dict(table.dtypes)["price"] == kind
        assert rows(table.orderBy("id").selectExpr("id", "string(price)", "_rescued_data")) == [
            (i + 1, v, None) for i, v in enumerate(expected)]
        kept = before <= set(table.inputFiles())
        assert kept == (number not in (2, 3))  # a bigint is not read as a double, nor a number as text


def test_a_new_catalog_knows_the_wider_types(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", {"inferSchema": "true"}, widen_types=True)
    for number, value in enumerate(("7", "x")):
        feed.put(f"{number}.csv", f"id,v\n{number},{value}\n")
        feed.run()
    create_layers(spark, folder, "wider_")
    assert rows(read_table(spark, "wider_bronze.feed"), "id", "v") == [(0, "7"), (1, "x")]


def test_a_table_that_lost_its_entry_is_found_by_the_next_write(spark, folder, layers):
    table = layers("silver", "t")
    write_table(spark.createDataFrame([(1, "a")], "k int, v string"), table, "merge", "k")
    spark.sql(f"DROP TABLE {table}")
    write_table(spark.createDataFrame([(2, "b")], "k int, v string"), table, "merge", "k")
    assert rows(read_table(spark, table)) == [(1, "a"), (2, "b")]


def test_keys_that_differ_in_case_are_rescued(spark, folder, layers):
    feed = Landing(spark, folder, layers, "json", schema=SCHEMA)
    feed.put("a.jsonl", '{"id": 1, "Name": "a"}\n{"id": 2, "name": "b", "NAME": "c"}\n')
    assert feed.run("id", "name", "_rescued_data") == [("1", None, '{"Name":"a"}'), ("2", "b", '{"NAME":"c"}')]


def test_ingest_goes_on_after_other_writes(spark, folder, layers):
    feed = Landing(spark, folder, layers, "csv", schema=SCHEMA)
    feed.put("a.csv", "id,name\n1,a\n")
    feed.run()
    compact(spark, feed.table)
    write_table(spark.createDataFrame([("9", "batch")], "id string, name string"), feed.table, "append")
    feed.put("b.csv", "id,name\n2,b\n")
    assert feed.run("id", "name") == [("1", "a"), ("2", "b"), ("9", "batch")]


def test_json_lines_new_column_and_broken_line(spark, folder, layers):
    feed = Landing(spark, folder, layers, "json", schema=SCHEMA)
    feed.put("a.jsonl", '{"id": 1, "name": "a"}\n{"id": 2, "na\n')
    assert feed.run("id", "name", "_rescued_data") == [("1", "a", None), (None, None, '{"id": 2, "na')]
    feed.put("b.jsonl", '{"id": 3, "name": "c", "age": 7}\n{"id": 4}\n')
    assert feed.run("id", "name", "age", "_rescued_data") == [
        ("1", "a", None, None), ("3", "c", "7", None), ("4", None, None, None), (None, None, None, '{"id": 2, "na')]


def test_json_lines_fixed_columns(spark, folder, layers):
    feed = Landing(spark, folder, layers, "json", schema=SCHEMA, add_new_columns=False)
    feed.put("a.jsonl", '{"id": 1, "age": 7, "city": null}\n{"id": 2, "name": "b"}\n')
    found = feed.run("id", "name", "_rescued_data")
    assert found[1] == ("2", "b", None) and json.loads(found[0][2])["age"] == "7"


def test_typed_columns_rescue_what_does_not_fit(spark, folder, layers):
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("day", DateType())])
    feed = Landing(spark, folder, layers, "csv", schema=schema)
    feed.put("a.csv", "id,name,day\n1,a,2025-03-04\nx,b,soon\n,c,\n2,d,never\n")
    found = feed.run("id", "name", "day", "_rescued_data")
    assert found == sorted([(1, "a", date(2025, 3, 4), None), (None, "b", None, '{"id":"x","day":"soon"}'),
                            (None, "c", None, None), (2, "d", None, '{"day":"never"}')], key=repr)


def test_json_documents(spark, folder, layers):
    feed = Landing(spark, folder, layers, "json", {"multiLine": "true"}, schema=SCHEMA)
    feed.put("a.json", '[\n {"id": 1,\n "name": "a"},\n {"id": 2, "name": "b"}\n]')
    feed.put("b.json", '{"id": 3,\n "name": "c"}')
    assert feed.run("id", "name") == [("1", "a"), ("2", "b"), ("3", "c")]
    feed.put("c.json", '[{"id": 4, "name": "d", "tier": "gold"}]')
    feed.put("d.json", '[{"id": 5, ')
    found = feed.run("id", "tier", "_rescued_data")
    assert found[:4] == [("1", None, None), ("2", None, None), ("3", None, None), ("4", "gold", None)]
    assert found[4][0] is None and found[4][2].startswith('[{"id": 5')


def test_other_formats(spark, folder, layers):
    feed = Landing(spark, folder, layers, "xml", schema=SCHEMA)
    with pytest.raises(ValueError, match="not supported"):
        feed.run()


@pytest.mark.parametrize("land, file_format, options", [
    (land_csv, "csv", {}), (land_json_lines, "json", {}), (land_json_array, "json", {"multiLine": "true"})])
def test_landing_round_trip(spark, folder, layers, land, file_format, options):
    data = [(str(i), v) for i, v in enumerate(["a", " b ", 'q"uo,te', None, "", "ä"])]
    df = spark.createDataFrame(data, "id string, name string").repartition(3)
    feed = Landing(spark, folder, layers, file_format, options, schema=SCHEMA)
    land(df, str(feed.path))
    # CSV has no empty text: Spark reads it as null.
    expected = [(i, v or None) for i, v in data] if file_format == "csv" else data
    assert feed.run("id", "name") == sorted(expected, key=repr)


def test_stream_failure_is_not_swallowed(spark, folder, layers):
    feed = Landing(spark, folder, layers, "json", {"mode": "FAILFAST", "multiLine": "true"}, schema=SCHEMA, add_new_columns=False)
    feed.put("a.json", '[{"id": ')
    with pytest.raises(StreamingQueryException):
        feed.run()


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_a_large_batch_is_written_without_a_shuffle(spark, folder, layers, monkeypatch, file_format):
    """The tasks that read a batch write it; a small one is shuffled to fewer files."""
    feed = Landing(spark, folder, layers, file_format, schema=SCHEMA)
    for at in range(4):
        lines = [f'{i},"n {i}"' if file_format == "csv" else json.dumps({"id": str(i), "name": f"n {i}"}) for i in range(at * 50, at * 50 + 50)]
        feed.put(f"{at}.{file_format}", "\n".join([*(["id,name"] if file_format == "csv" else []), *lines]) + "\n")
    monkeypatch.setattr("tillwork.sources.ingest.SCAN_BYTES", 1, raising=False)
    expected = sorted(((str(i), f"n {i}") for i in range(200)), key=repr)
    assert feed.run("id", "name") == expected
    assert len(read_table(spark, feed.table).inputFiles()) == 4
    monkeypatch.undo()
    feed.put(f"4.{file_format}", ("id,name\n" if file_format == "csv" else "") + ('x,y\n' if file_format == "csv" else '{"id": "x", "name": "y"}\n') * 2)
    assert feed.run("id", "name") == [*expected, ("x", "y"), ("x", "y")]
    assert len(read_table(spark, feed.table).inputFiles()) == 5
