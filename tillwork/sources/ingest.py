"""Incremental file ingest: landing folder -> bronze table.

A file stream lists the files that arrived since the last run, however old they are, and hands
them over in batches. A batch is read by the reader of its format, its columns are found by
name, and it is committed to the table under the batch's name, so each file counts once. Feed
columns are kept as text, as cleaning is the next step's work, unless the feed's schema or an
inferred one types them.

The column list of a feed is remembered beside its checkpoint and grows with the files.
Columns are told apart without regard to case; a second spelling is rescued, not lost.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import AtomicType, StringType, StructField, StructType

from tillwork.session import literal_path
from tillwork.sources.schemas import ARRIVAL, FILE_TIME, RESCUED, SOURCE_FILE, text_schema
from tillwork.sources.tables import widen_columns, write_table
from tillwork.sources.types import widened

_CORRUPT = "_corrupt_record"
_EXTRA = "_extra_value"
_LOG_SCHEMA = "version LONG, feed_schema STRING"
_FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
HEADER_OPTIONS = ("multiline", "encoding", "charset")  # with these a line of text is no record
# From so many bytes of files for each core on, a batch goes to the table without a shuffle.
SCAN_BYTES = 16 << 20
# Options of the reader that are the file stream's own.
STREAM_OPTIONS = ("maxfilespertrigger", "pathglobfilter", "recursivefilelookup")


class SchemaLog:
    """The columns a feed has had, with their types; append-only."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def last(self) -> StructType | None:
        row = self._last()
        return StructType.fromJson(json.loads(row["feed_schema"])) if row else None

    def _last(self):
        try:
            log = self.spark.read.schema(_LOG_SCHEMA).json(self.folder)
        except AnalysisException:
            return None
        return log.orderBy(F.desc("version")).first()

    def add(self, schema: StructType) -> None:
        last = self._last()
        row = self.spark.range(1).select(
            F.lit(last["version"] + 1 if last else 1).cast("long").alias("version"),
            F.lit(schema.json()).alias("feed_schema"),
        )
        row.write.mode("append").json(self.folder)


def _flag(options: dict[str, str], name: str) -> bool:
    given = {key.lower(): str(value).lower() == "true" for key, value in options.items()}
    return given.get(name.lower(), False)


def _without(options: dict[str, str], *names: str) -> dict[str, str]:
    return {k: v for k, v in options.items() if k.lower() not in names}


def _known(names: list[str], columns: list[str]) -> tuple[dict[str, str], list[str]]:
    """File names of known columns, by column, and the names that are none.

    The same spelling goes first; a second name for a column is none.
    """
    found, lower = {n: n for n in names if n in columns}, {c.lower(): c for c in columns}
    for name in names:
        column = lower.get(name.lower())
        if column and column not in found:
            found[column] = name
    taken = set(found.values())
    return found, [n for n in names if n not in taken]


def _grown(names: list[str], columns: list[str]) -> list[str]:
    """``columns`` with the new ones among ``names``; the first spelling names a column."""
    out, lower = list(columns), {c.lower() for c in columns}
    for name in names:
        if name and name.lower() not in lower:
            out.append(name)
            lower.add(name.lower())
    return out


# CSV


def _paths(files: list[str]) -> list[str]:
    """Names of files as readers take them: none is a pattern."""
    return [literal_path(f) for f in files]


def _headers(spark: SparkSession, files: list[str], options: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header.

    One job finds the first line of each file, whatever their number: the lines of a file's
    first block, reduced to the earliest one where they are read. Each different line is then
    taken apart by the CSV reader.
    """
    plain = {**_without(options, "header", "inferschema"), "header": "false"}
    if any(k.lower() in HEADER_OPTIONS for k in options):
        lines = [(path, None) for path in files]
    else:
        given = {k.lower(): v for k, v in options.items()}
        texts = {k: v for k, v in options.items() if k.lower() == "linesep"}
        first = (
            spark.read.options(**texts).text(_paths(files))
            .where(F.col("_metadata.file_block_start") == 0)
            .select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
            .where(F.trim("value") != "")
        )
        if given.get("comment"):
            first = first.where(~F.col("value").startswith(given["comment"]))
        by_line = first.groupBy("file").agg(F.min_by("value", "at").alias("line")).collect()
        at = {_uri(unquote(r["file"])): r["line"] for r in by_line}  # an empty file has no line
        lines = [(path, at[_uri(path)]) for path in files if _uri(path) in at]
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    known: dict[str, tuple[str, ...]] = {}
    for path, line in lines:
        if line is None:
            found = tuple(spark.read.options(**plain).csv(_paths([path])).first() or ())
        elif line in known:
            found = known[line]
        else:
            found = known[line] = _values(spark, line, plain)
        if found:
            groups[tuple((name or "").strip() for name in found)].append(path)
    return dict(groups)


def _values(spark: SparkSession, line: str, options: dict[str, str]) -> tuple[str | None, ...]:
    """The values of one line of CSV."""
    given = {k.lower(): v for k, v in options.items()}
    places = line.count(given.get("sep", given.get("delimiter", ","))) + 1
    schema = ", ".join(f"_{i} STRING" for i in range(places))
    row = spark.range(1).select(F.from_csv(F.lit(line), schema, _without(options, "header")).alias("row")).first()["row"]
    found = list(row or ())
    if given.get("quote", '"') in line:  # quoted separators make fewer values
        while found and found[-1] is None:
            found.pop()
    return tuple(found)


def _uri(path: str) -> str:
    """One spelling for a path of the file stream and of file metadata."""
    return re.sub("^file:/+", "file:/", path)


def _depth(path: str) -> int:
    """Folders above a path, whatever its file system."""
    return re.sub(r"^\w[\w+.-]*:(//[^/]*)?", "", path).strip("/").count("/")


def _csv_rows(spark, files, names, columns, options, has_header) -> DataFrame:
    """Files of one header: values by name, what has no column as JSON, long rows as they are."""
    places = [f"_{i}" for i in range(len(names))]
    rows = (
        spark.read.schema(text_schema([*places, _EXTRA, _CORRUPT]))
        .options(**_without(options, "header", "inferschema"))
        .options(header=str(has_header).lower(), columnNameOfCorruptRecord=_CORRUPT)
        .csv(_paths(files))
    )
    found, rest = _known(list(names), columns)
    at = {n: F.col(p) for n, p in reversed(list(zip(names, places)))}
    extra = [at[n].alias(n) for n in dict.fromkeys(rest)]
    rescued = F.when(F.col(_EXTRA).isNotNull(), F.coalesce(F.col(_CORRUPT), F.col(_EXTRA)))
    if extra:
        unknown = F.when(F.coalesce(*[at[n] for n in dict.fromkeys(rest)]).isNotNull(), F.to_json(F.struct(*extra)))
        rescued = F.coalesce(rescued, unknown)
    return rows.select(
        *[(at[found[c]] if c in found else F.lit(None).cast("string")).alias(c) for c in columns],
        rescued.alias(RESCUED),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
    )


def _read_csv(spark, files, options, columns, grow) -> tuple[DataFrame | None, list[str]]:
    has_header = _flag(options, "header")
    if has_header:
        groups = _headers(spark, files, options)
    else:
        groups = {tuple(columns): files}
    if grow or not columns:
        for names in sorted(groups, key=len):
            columns = _grown(list(names), columns)
    out = None
    for names, paths in sorted(groups.items()):
        part = _csv_rows(spark, paths, names, columns, options, has_header)
        out = part if out is None else out.unionByName(part)
    return out, columns


# JSON


def _documents(spark: SparkSession, files: list[str], options: dict[str, str]) -> DataFrame:
    """``value``: one JSON document each, from lines or from whole files and their arrays."""
    meta = [
        F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_modification_time").alias(FILE_TIME)
    ]
    if not _flag(options, "multiLine"):
        return spark.read.options(**_without(options, "mode")).text(_paths(files)).select("value", *meta)
    whole = spark.read.text(_paths(files), wholetext=True).select(F.trim("value").alias("whole"), *meta)
    parse = {"mode": options["mode"]} if "mode" in options else {}
    listed = F.from_json("whole", "array<string>", parse)
    is_list = F.ltrim("whole").startswith("[")
    return whole.where("whole <> ''").withColumn(
        "values", F.when(is_list, F.coalesce(listed, F.array("whole"))).otherwise(F.array("whole"))
    ).select(F.explode("values").alias("value"), SOURCE_FILE, FILE_TIME)


def _read_json(spark, files, options, columns, grow) -> tuple[DataFrame, list[str]]:
    """Broken documents are rescued as they are, keys without a column as JSON."""
    lines = _documents(spark, files, options)
    if grow or not columns:
        keys = lines.select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
        columns = _grown(sorted(r["key"] for r in keys.collect() if r["key"] != _CORRUPT), columns)
    schema = text_schema([*columns, _CORRUPT])
    parse = {"columnNameOfCorruptRecord": _CORRUPT} | ({"mode": options["mode"]} if "mode" in options else {})
    parsed = lines.select(
        F.from_json("value", schema, parse).alias("doc"),
        F.array_except(F.json_object_keys("value"), F.array(*[F.lit(n) for n in columns])).alias("unknown"),
        "value", SOURCE_FILE, FILE_TIME,
    )
    # Taken apart once more where there are unknown keys only.
    extra = F.to_json(F.map_filter(F.from_json("value", "map<string,string>"), lambda key, _: F.array_contains("unknown", key)))
    rescued = F.when(F.size("unknown") > 0, extra).otherwise(F.col(f"doc.{_CORRUPT}"))
    return parsed.select(
        *[F.col(f"doc.{n}").alias(n) for n in columns], rescued.alias(RESCUED), SOURCE_FILE, FILE_TIME
    ), columns


# Types


def _inferred(spark, files, file_format, options) -> StructType:
    """The types Spark finds in the first batch of files; nested values stay text."""
    reader = spark.read.options(**_without(options, *STREAM_OPTIONS))
    found = (reader.json(_paths(files)) if file_format == "json" else reader.csv(_paths(files))).schema
    plain = [f for f in found if f.name != _CORRUPT]
    return StructType([
        StructField(f.name.strip(), f.dataType if isinstance(f.dataType, AtomicType) else StringType()) for f in plain
    ])


def _typed(rows: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the types of ``schema``; text that does not fit is rescued as JSON."""
    types = {f.name: f.dataType for f in schema if f.dataType != StringType() and f.name in rows.columns}
    if not types:
        return rows
    misfits: dict[str, Column] = {
        name: F.when(F.col(name).try_cast(kind).isNull(), F.col(name)) for name, kind in types.items()
    }
    any_misfit = F.coalesce(*misfits.values()).isNotNull()
    rescued = F.to_json(F.struct(*[text.alias(name) for name, text in misfits.items()]))
    return rows.withColumns(
        {
            **{name: F.col(name).try_cast(kind) for name, kind in types.items()},
            RESCUED: F.when(any_misfit, rescued).otherwise(F.col(RESCUED)),
        }
    )


def ingest_raw_to_bronze(
    spark: SparkSession,
    source_path: str,
    target_table: str,
    checkpoint_path: str,
    file_format: str,
    extra_read_options: dict[str, str] | None = None,
    schema: StructType | None = None,
    add_new_columns: bool = True,
    widen_types: bool = False,
) -> None:
    """Append the files of ``source_path`` that are new since the last call.

    ``file_format`` is ``csv`` or ``json`` (JSON lines, or one document or array per
    file with option ``multiLine``). ``schema`` names the feed's columns; without it
    they are taken from the first files, with their types if option ``inferSchema`` is
    true. A column with a type other than string is cast, and a value that does not fit
    goes to ``_rescued_data``. CSV columns go by the names in each file's header, in any
    order and case. With ``add_new_columns=False`` the columns stay fixed and unknown data
    goes to ``_rescued_data``. With ``widen_types`` and inferred types, a column whose new
    values need a wider type gets it, and its stored values with it; nothing is rescued for
    its type.
    """
    if file_format not in ("csv", "json"):
        raise ValueError(f"file format {file_format!r} is not supported; use csv or json")
    options = {"header": "true"} if file_format == "csv" else {}
    options.update(extra_read_options or {})
    own = {k: v for k, v in options.items() if k.lower() in STREAM_OPTIONS}
    options = _without(options, *STREAM_OPTIONS)
    log = SchemaLog(spark, f"{checkpoint_path}/schema")
    read = _read_csv if file_format == "csv" else _read_json

    nested = _flag(own, "recursiveFileLookup")
    deepest = _depth(source_path) + 1

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        found = [r for r in batch.collect() if nested or _depth(r["path"]) <= deepest]
        files = sorted(r["path"] for r in found)
        if not files:
            return
        # The scan's tasks then read, and write, enough each.
        large = sum(r["length"] for r in found) >= SCAN_BYTES * session.sparkContext.defaultParallelism
        logged = log.last()
        feed = logged or schema
        if feed is None:
            plain = _without(options, "inferschema")
            feed = _inferred(session, files, file_format, options if _flag(options, "inferSchema") else plain)
            if not _flag(options, "inferSchema"):
                feed = StructType([StructField(f.name, StringType()) for f in feed])
        elif widen_types and _flag(options, "inferSchema"):
            feed = widened(feed, _inferred(session, files, file_format, options))
            types = {f.name: f.dataType for f in feed if f.name in logged.names and f != logged[f.name]}
            if types and session.catalog.tableExists(target_table):
                widen_columns(session, target_table, types)
        rows, columns = read(session, files, options, feed.names, add_new_columns)
        if rows is None:
            return
        feed = StructType([*feed, *[StructField(n, StringType()) for n in columns if n not in feed.names]])
        if feed != logged:
            log.add(feed)
        rows = _typed(rows, feed).select(
            *columns, RESCUED, F.current_timestamp().alias(ARRIVAL), SOURCE_FILE, FILE_TIME
        )
        write_table(rows, target_table, "append", batch=f"{checkpoint_path}#{number}", rebalance=not large)

    query = (
        spark.readStream.format("binaryFile").schema(_FILES).options(**own)
        # Otherwise a file whose name looks like a pattern brings its neighbours along. Files in
        # subfolders are left out above.
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")  # the default leaves out files a week older than the newest
        .load(source_path).select("path", "length")  # the content isn't read here
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{checkpoint_path}/write")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if spark.catalog.tableExists(target_table):
        spark.catalog.refreshTable(target_table)
