"""Catalog tables on plain parquet: create, overwrite, append, upsert, compact.

A table is an external parquet table, partitioned by hash bucket of its keys and by the write
that brought the rows. The catalog says where each partition lies, and that is all a reader
needs. A write puts its files aside, in a folder of its own (a generation), and publishes them
last: the folder gets its place by one rename, then the catalog gets its partitions, all new
ones in one statement, replaced ones by a new location each. A job that fails before leaves the
table as it was; a job that fails between is finished by the next writer, from the folder.

A generation holds ``rows`` by partition, ``gone`` (partitions without rows now) and ``changes``
(replaced and removed rows, before and after). Below ``rows``, the batch ``new`` stands for the
generation itself and has the rows it added; other batches are partitions written anew because
some of their rows were replaced or removed. The new rows and ``changes`` are the table's change
feed; other jobs follow them with a file stream (``streaming.progress``). An upsert reads the buckets
of its keys and writes the partitions that hold them; all other files stay as they are.

Names of folders say which partition is which, so a session whose catalog doesn't outlive it
registers the tables again from them. One writer per table at a time.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from tillwork.operators.clustering import clustered
from tillwork.operators.diff import CHANGE
from tillwork.session import (
    folder_bytes,
    literal_path,
    make_folder,
    move_folder,
    remove_folder,
    scratch_folder,
    subfolders,
    write_file,
)
from tillwork.sources.schemas import BATCH, BUCKET, CLOCKS, PLACE
from tillwork.sources.types import read_as

# Layer names and write modes.
LAYERS = ("bronze", "silver", "gold")
WRITE_MODES = ("merge", "append", "overwrite")

NEW = "new"
BUCKETS = 8  # of a keyed table, unless its first write says otherwise
CODEC = {"compression": "zstd"}  # of files, unless a write's options say otherwise
TARGET_FILE_BYTES = 128 * 1024 * 1024
UNPACKED = 3  # a file's rows take at most so many times its target size in a task that sorts them
LAYOUT = "number LONG, keys ARRAY<STRING>, buckets INT, table_schema STRING"
APPLIED = "tillwork.applied"  # table property: the last generation the catalog knows
# Rows by their place: the file, as a number, and the row in it, from 1.
FILE, AT, CHUNK = "__file", "__at", "__chunk"
CHUNK_ROWS = 1 << 15  # of a bitmap of Spark's
PASS_CHUNKS = 1024  # bitmaps of 4 KB and 32,768 rows each that a pass over stored rows sends to the tasks
TOLD = {BUCKET: -1, BATCH: "told"}  # where a pass over stored rows puts its changes for a moment
# From so many bytes for each core and bucket on, rows in files go to the table without a shuffle.
SPREAD_BYTES = 1 << 20


# The catalog


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    """One database per layer, its tables under ``root/<layer>``.

    Tables that an earlier process wrote there are registered from their folders.
    """
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{root}/{layer}'")
        try:
            listed = spark.read.schema(LAYOUT).json(f"{literal_path(f'{root}/{layer}')}/*/layout")
        except AnalysisException:
            continue  # no table yet
        table = F.element_at(F.split("_metadata.file_path", "/"), -3).alias("table")
        for row in listed.select(table).distinct().collect():
            _register(spark, f"{prefix}{layer}.{row['table']}")


def _register(spark: SparkSession, name: str) -> None:
    """Give the catalog a table that is known from its folder."""
    if not spark.catalog.tableExists(name):
        layout = _last_layout(spark, name)
        schema = StructType.fromJson(json.loads(layout["table_schema"]))
        _catalog_entry(spark, name, schema, layout["keys"], layout["buckets"])
    _settle(spark, name)


def table_folder(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{table}"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _catalog_entry(spark: SparkSession, name: str, schema: StructType, keys: Sequence[str], buckets: int) -> None:
    spark.sql(
        f"CREATE TABLE {name} ({_columns(schema)}, {BUCKET} INT, {BATCH} STRING) USING parquet"
        f" PARTITIONED BY ({BUCKET}, {BATCH}) LOCATION '{table_folder(spark, name)}'"
        f" TBLPROPERTIES ('tillwork.keys' = '{json.dumps(list(keys))}', 'tillwork.buckets' = '{buckets}')"
    )


def table_keys(spark: SparkSession, name: str) -> list[str]:
    """The keys that a table's writes go by."""
    return json.loads(_properties(spark, name)["tillwork.keys"])


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _write_layout(spark: SparkSession, name: str, number: int, schema: StructType, keys: Sequence[str], buckets: int) -> None:
    """Noted when a table is made and when columns are added."""
    row = {"number": number, "keys": list(keys), "buckets": buckets, "table_schema": schema.json()}
    write_file(spark, f"{table_folder(spark, name)}/layout/{number:012d}.json", json.dumps(row))


def _stored(spark: SparkSession, name: str) -> DataFrame:
    """The table with its partition columns, also when another session of this application wrote it."""
    spark.catalog.refreshTable(name)
    return spark.read.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Current state of a table."""
    return _stored(spark, name).drop(*PLACE)


def table_schema(spark: SparkSession, name: str) -> StructType:
    return StructType([f for f in spark.table(name).schema if f.name not in PLACE])


# Generations


def generations(spark: SparkSession, name: str) -> list[str]:
    return [n for n in subfolders(spark, table_folder(spark, name)) if n[0].isdigit()]


def known_batch(spark: SparkSession, name: str, batch: str) -> bool:
    """Whether a write of this name has been published."""
    return any(g.endswith(f"-{_token(batch)}") for g in generations(spark, name))


def _partitions(spark: SparkSession, folder: str, kind: str) -> list[tuple[int, str, str]]:
    """``(bucket, batch, folder)`` of the partitions in ``rows`` or ``gone`` of a generation."""
    own, found = folder.rpartition("/")[2], []
    for bucket in subfolders(spark, f"{folder}/{kind}"):
        path = f"{folder}/{kind}/{bucket}"
        for name in subfolders(spark, path):
            batch = name.partition("=")[2]
            found.append((int(bucket.partition("=")[2]), own if batch == NEW else batch, f"{path}/{name}"))
    return found


def _spec(bucket: int, batch: str) -> str:
    return f"PARTITION ({BUCKET} = {bucket}, {BATCH} = '{batch}')"


def _apply(spark: SparkSession, name: str, generation: str) -> None:
    """Tell the catalog about a generation. May be repeated."""
    folder = f"{table_folder(spark, name)}/{generation}"
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    gone = [
        _spec(b, batch) for b, batch, _ in _partitions(spark, folder, "gone") if f"{BUCKET}={b}/{BATCH}={batch}" in known
    ]
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone)}")
    added = []
    for bucket, batch, path in _partitions(spark, folder, "rows"):
        if f"{BUCKET}={bucket}/{BATCH}={batch}" in known:
            spark.sql(f"ALTER TABLE {name} {_spec(bucket, batch)} SET LOCATION '{path}'")
        else:
            added.append((bucket, batch, path))
    if added:
        places = " ".join(f"{_spec(bucket, batch)} LOCATION '{path}'" for bucket, batch, path in added)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{APPLIED}' = '{generation}')")
    spark.catalog.refreshTable(name)


def _settle(spark: SparkSession, name: str) -> list[str]:
    """Finish what a failed writer, or one with another catalog, has left; the table's generations."""
    found = generations(spark, name)
    applied = _properties(spark, name).get(APPLIED, "")
    for generation in found:
        if generation > applied:
            _grow(spark, name, _last_schema(spark, name))
            _apply(spark, name, generation)
    return found


def _last_layout(spark: SparkSession, name: str):
    listed = spark.read.schema(LAYOUT).json(literal_path(f"{table_folder(spark, name)}/layout"))
    return listed.orderBy(F.desc("number")).first()


def _last_schema(spark: SparkSession, name: str) -> StructType:
    return StructType.fromJson(json.loads(_last_layout(spark, name)["table_schema"]))


def _grow(spark: SparkSession, name: str, schema: StructType) -> None:
    known = spark.table(name).columns
    new = StructType([f for f in schema if f.name not in known])
    if len(new):
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(new)})")


def _token(batch: str | None) -> str:
    return hashlib.md5(batch.encode()).hexdigest() if batch else uuid.uuid4().hex


class _Write:
    """One generation of a table: files put aside, then published."""

    def __init__(self, spark: SparkSession, name: str, batch: str | None, cluster_keys, options: dict[str, str]):
        self.spark, self.name, self.cluster_keys, self.options = spark, name, cluster_keys, options
        found = generations(spark, name)
        self.number = int(found[-1].partition("-")[0]) + 1 if found else 1
        self.generation = f"{self.number:012d}-{_token(batch)}"
        self.folder = table_folder(spark, name)
        self.aside = f"{self.folder}/_writing/{self.generation}"
        remove_folder(spark, self.aside)  # of an attempt that failed
        properties = _properties(spark, name)
        self.keys, self.buckets = json.loads(properties["tillwork.keys"]), int(properties["tillwork.buckets"])

    def bucket(self) -> Column:
        """The bucket of a row: by the hash of its keys, a missing key value counts as one."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)) if self.keys else F.lit(0)

    def rows(
        self, rows: DataFrame, places: Sequence[tuple[int, str]] = (), partitions: int | None = None, rebalance: bool = True
    ) -> None:
        """Rows with their bucket and batch: NEW ones, and all that the partitions ``places`` have from now on."""
        if self.cluster_keys or partitions:
            laid = clustered(rows, self.cluster_keys or [], PLACE, partitions, self.keys)
        elif not rebalance and not places:
            laid = rows
        else:
            laid = rows.hint("rebalance", *PLACE) if self.buckets > 1 or places else rows.hint("rebalance")
        self.keep(laid)
        self.leave(places)

    def keep(self, rows: DataFrame) -> None:
        """Rows with their bucket and batch, written by the tasks that bring them."""
        rows.write.mode("append").options(**{**CODEC, **self.options}).partitionBy(*PLACE).parquet(f"{self.aside}/rows")

    def keep_and_tell(self, rows: DataFrame) -> None:
        """Stored rows in one pass: those with a CHANGE go to the changes, the others are kept."""
        tells = F.col(CHANGE).isNotNull()
        self.keep(rows.withColumns({n: F.when(tells, F.lit(v)).otherwise(F.col(n)) for n, v in TOLD.items()}))
        aside = f"{self.aside}/rows/{BUCKET}={TOLD[BUCKET]}"
        if subfolders(self.spark, aside):
            move_folder(self.spark, f"{aside}/{BATCH}={TOLD[BATCH]}", f"{self.aside}/changes/{uuid.uuid4().hex}")
            remove_folder(self.spark, aside)

    def leave(self, places: Sequence[tuple[int, str]]) -> None:
        """Note those of ``places`` that have no rows from now on."""
        held = {(b, batch) for b, batch, _ in _partitions(self.spark, self.aside, "rows")} if places else set()
        for bucket, batch in places:
            if (bucket, batch) not in held:
                make_folder(self.spark, f"{self.aside}/gone/{BUCKET}={bucket}/{BATCH}={batch}")

    def is_spread(self, size: int) -> bool:
        """Whether the tasks that read so many bytes of files bring files of a good size for every bucket."""
        return size >= SPREAD_BYTES * self.buckets * self.spark.sparkContext.defaultParallelism

    def new(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, self.bucket()).withColumn(BATCH, F.lit(NEW))

    def changes(self, rows: DataFrame) -> None:
        rows.write.mode("append").options(**CODEC).parquet(f"{self.aside}/changes")

    def publish(self, schema: StructType) -> None:
        spark, name = self.spark, self.name
        if any(f.name not in spark.table(name).columns for f in schema):
            known = table_schema(spark, name)
            grown = StructType([*known, *[f for f in schema if f.name not in known.names]])
            _write_layout(spark, name, self.number, grown, self.keys, self.buckets)
            _grow(spark, name, grown)
        move_folder(spark, self.aside, f"{self.folder}/{self.generation}")
        _apply(spark, name, self.generation)


# Writes


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of all keys; a missing key value equals a missing one."""
    return reduce(and_, [left[key].eqNullSafe(right[key]) for key in keys])


class Stage:
    """DataFrames written once to the shared folder and read back; removed at the end.

    A keyed write reads its rows several times; from files that costs no recomputation,
    survives lost executors, and lets Spark see the size when it picks a join.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_) -> None:
        for folder in self.folders:
            remove_folder(self.spark, folder)

    def keep(self, df: DataFrame, purpose: str, *more: DataFrame) -> DataFrame:
        """The rows of ``df`` and then those of ``more``, which have its columns."""
        folder = scratch_folder(self.spark, purpose)
        self.folders.append(folder)
        for part in (df, *more):
            part.write.mode("append").options(**CODEC).parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    repeated = df.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{what}: several rows share one value of {list(keys)}")


def _to_table_types(df: DataFrame, schema: StructType) -> DataFrame:
    """Known columns in the table's types, then the new ones; absent columns become null."""
    given = set(df.columns)
    known = [
        (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(*known, *[n for n in df.columns if n not in schema.names])


def _place() -> Column:
    """A partition as text, on which a filter prunes partitions."""
    return F.concat_ws("/", F.col(BUCKET).cast("string"), BATCH)


def _in_places(df: DataFrame, places: Sequence[tuple[int, str]]) -> DataFrame:
    return df.where(_place().isin([f"{bucket}/{batch}" for bucket, batch in places]))


def _create(
    df: DataFrame, name: str, keys, buckets, cluster_keys, options, check: bool, batch: str | None, rebalance: bool,
    more: Sequence[DataFrame], from_files: bool,
) -> None:
    spark = df.sparkSession
    with Stage(spark) as stage:
        if from_files and cluster_keys:
            df = reduce(lambda a, b: a.unionByName(b), [df, *more])
        elif keys or cluster_keys or more:
            df = stage.keep(df, "create", *more)  # clustering reads its rows several times
        if keys and check:
            require_unique(df, keys, name)
        buckets = (buckets or BUCKETS) if keys else 1
        _write_layout(spark, name, 0, df.schema, keys, buckets)
        _catalog_entry(spark, name, df.schema, keys, buckets)
        _add_rows(df, name, cluster_keys, options, batch, rebalance, stage.folders[-1] if keys and stage.folders else None)


def _add_rows(
    df: DataFrame, name: str, cluster_keys, options: dict[str, str], batch: str | None, rebalance: bool,
    staged: str | None = None,
) -> None:
    write = _Write(df.sparkSession, name, batch, cluster_keys, options)
    if staged:
        rebalance = not write.is_spread(folder_bytes(df.sparkSession, staged))
    write.rows(write.new(df), rebalance=rebalance or write.buckets > 1 and not staged)
    write.publish(df.schema)


def _replace_all(df: DataFrame, name: str, cluster_keys, options: dict[str, str], batch: str | None) -> None:
    """All rows anew. A bucket's rows take the place of one of its partitions, the others go."""
    spark = df.sparkSession
    write = _Write(spark, name, batch, cluster_keys, options)
    places = _known_places(spark, name)
    first: dict[int, str] = {}
    for bucket, old in places:
        first.setdefault(bucket, old)
    chosen = F.lit(NEW)
    for bucket, old in first.items():
        chosen = F.when(F.col(BUCKET) == bucket, F.lit(old)).otherwise(chosen)
    write.rows(df.withColumn(BUCKET, write.bucket()).withColumn(BATCH, chosen), places)
    # Rows in a bucket that had none are new ones already.
    taken = df.where(write.bucket().isin(list(first))).withColumn(CHANGE, F.lit("insert"))
    before = read_table(spark, name).withColumn(CHANGE, F.lit("delete"))
    write.changes(before.unionByName(taken, allowMissingColumns=True))
    write.publish(df.schema)


def _known_places(spark: SparkSession, name: str) -> list[tuple[int, str]]:
    listed = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return sorted((int(b.partition("=")[2]), x.partition("=")[2]) for b, x in listed)


def _located(df: DataFrame) -> DataFrame:
    """Rows read from files, with their place."""
    return df.withColumns({FILE: F.xxhash64("_metadata.file_path"), AT: F.col("_metadata.row_index") + 1})


def _bitmaps(found: DataFrame, file: str, at: str, **marks: Column) -> DataFrame:
    """A bitmap for each of ``marks`` and 32,768 rows of a file; rows of ``found`` are places, also repeated ones."""
    places = found.withColumns({FILE: F.col(file), AT: F.col(at), CHUNK: F.bitmap_bucket_number(F.col(at)), **marks})
    bits = {n: F.bitmap_construct_agg(F.when(F.col(n), F.bitmap_bit_position(F.col(AT)))) for n in marks}
    # Brought together as places, which are smaller than the bitmaps of each task.
    return places.repartition(FILE, CHUNK).groupBy(FILE, CHUNK).agg(*[bit.alias(n) for n, bit in bits.items()])


def _marked(df: DataFrame, bitmaps: DataFrame, marks: Sequence[str]) -> DataFrame:
    """Rows read from files, with their marks; they stay where they are.

    The bitmaps go to every task, so their number is bounded by the caller.
    """
    located = _located(df).withColumn(CHUNK, F.bitmap_bucket_number(F.col(AT)))
    bit = F.bitmap_bit_position(F.col(AT)).cast("int")

    def words(name: str) -> Column:
        """A bitmap as 64-bit numbers, taken apart once and not for each row."""
        ends = F.sequence(F.lit(1), F.lit(CHUNK_ROWS // 8), F.lit(8))
        return F.transform(ends, lambda at: F.conv(F.hex(F.substring(F.col(name), at, F.lit(8))), 16, -10).cast("bigint"))

    def mark(name: str) -> Column:
        # The first byte of a word has its highest bits.
        word = F.get(F.col(name), F.shiftright(bit, 6))
        return F.coalesce(F.getbit(word, (bit % 64).bitwiseXOR(F.lit(56))) == 1, F.lit(False))

    of_files = bitmaps.select(FILE, CHUNK, *[words(n).alias(n) for n in marks])
    return located.join(F.broadcast(of_files), [FILE, CHUNK], "left").select(
        *df.columns, *[mark(n).alias(n) for n in marks]
    )


def _passes(sizes: Sequence[tuple[object, int]], most: int) -> list[list]:
    """Things with sizes in groups of at most ``most``, or of one that is larger."""
    groups, total = [], most
    for thing, size in sizes:
        if total + size > most:
            groups.append([])
            total = 0
        groups[-1].append(thing)
        total += size
    return groups


def _parts(rows: DataFrame, bitmaps: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Staged rows in parts, each with its bitmaps; parts are whole files."""
    held = {r[FILE]: r["count"] for r in bitmaps.groupBy(FILE).count().collect()}  # at most the staged files
    if sum(held.values()) <= PASS_CHUNKS:
        return [(rows, bitmaps)]
    path = F.col("_metadata.file_path")
    files = rows.select(path.alias("path"), F.xxhash64(path).alias(FILE)).distinct().collect()
    groups = _passes([(r, held.get(r[FILE], 0)) for r in sorted(files)], PASS_CHUNKS)
    return [
        (rows.where(path.isin([r["path"] for r in g])), bitmaps.where(F.col(FILE).isin([r[FILE] for r in g])))
        for g in groups
    ]


def latest_in_files(
    stage: Stage, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rows in files that are the last of their key by ``order_by``, and those of keys with several last ones.

    Keys, ``order_by`` and places are shuffled; a task sends a key's last rows only. Whole rows stay where
    they are. Each list has the rows in parts of whole files; tied rows come in one part.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(n).desc_nulls_last() for n in order_by])
    placed = _located(rows).select(*keys, *order_by, FILE, AT)
    last = placed.withColumn("__rank", F.rank().over(newest)).where("__rank = 1")
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    marks = _bitmaps(last.select(FILE, AT, several.alias("__tie")), FILE, AT, __alone=~F.col("__tie"), __tied=F.col("__tie"))
    marks = stage.keep(marks, "last")
    alone = [_marked(part, bits, ("__alone",)).where("__alone").drop("__alone") for part, bits in _parts(rows, marks)]
    ties = marks.where(F.bitmap_count("__tied") > 0)
    if ties.isEmpty():
        return alone, []
    # Versions of one key may lie in different files.
    tied = [_marked(part, bits, ("__tied",)).where("__tied").drop("__tied") for part, bits in _parts(rows, ties)]
    return alone, [stage.keep(tied[0], "tied", *tied[1:])]


def _placed(write: _Write, rows: DataFrame, places: Sequence[tuple[int, str]]) -> DataFrame:
    """Rows as new ones, or as rows of the first of ``places`` in their bucket if they replace others."""
    if len(places) == 1:
        bucket, batch = (F.lit(x) for x in places[0])
    else:
        first = {bucket: batch for bucket, batch in reversed(places)}
        bucket, batch = write.bucket(), F.create_map(*[F.lit(x) for place in first.items() for x in place])[write.bucket()]
    return rows.withColumns(
        {
            BUCKET: F.when(F.col("__replaces"), bucket).otherwise(write.bucket()),
            BATCH: F.when(F.col("__replaces"), batch).otherwise(F.lit(NEW)),
        }
    ).drop("__replaces")


def _put(
    parts: Sequence[DataFrame], name: str, keys: Sequence[str], cluster_keys, options, check: bool, batch: str | None,
    replace: bool, newer_by: str | None, removed: DataFrame | None,
) -> None:
    """Rows by key: new keys are added; known ones replaced, kept, or replaced by newer rows.

    Only keys meet, each with the place of its row in the files; of the table's keys those in the
    buckets of the offered ones are read. Which rows are known, replaced or removed then goes to
    the tasks as bitmaps over the files' rows, so no whole row is shuffled for it. Partitions that
    hold a replaced or removed row are written anew without it, in passes of whole partitions by the
    tasks that read them; a row that replaces another one goes to such a partition of its bucket.
    """
    spark = parts[0].sparkSession
    write = _Write(spark, name, batch, cluster_keys, options)
    schema = table_schema(spark, name)
    with Stage(spark) as stage:
        given = [_to_table_types(part, schema) for part in parts]
        rows = stage.keep(given[0], "put", *given[1:])
        size = folder_bytes(spark, stage.folders[-1])
        if check:
            require_unique(rows, keys, name)
        version = [newer_by] if newer_by else []
        asked = _located(rows).select(*keys, *version, FILE, AT)
        if removed is not None:
            types = StructType([schema[k] for k in keys])
            asked = asked.unionByName(_to_table_types(removed.select(*keys), types), allowMissingColumns=True)
        target = _stored(spark, name)
        if list(keys) == write.keys and write.buckets > BUCKETS:
            asked = stage.keep(asked, "asked")
            buckets = [r[0] for r in asked.select(write.bucket()).distinct().collect()]  # at most ``buckets``
            target = target.where(F.col(BUCKET).isin(buckets))
        known = _located(target).select(
            *keys, *[F.col(n).alias("__stored") for n in version], F.col(FILE).alias("__in"), F.col(AT).alias("__on")
        )
        goes = F.lit(replace)
        if newer_by:
            # As structs, a missing value comes before all others.
            goes = F.struct(asked[newer_by].alias("at")) > F.struct(known["__stored"].alias("at"))
        found = stage.keep(
            known.join(asked, same_key(known, asked, keys)).select(
                "__in", "__on", FILE, AT, (F.col(FILE).isNull() | goes).alias("__goes")
            ),
            "found",
        )
        offered = found.where(F.col(FILE).isNotNull())
        answers = stage.keep(
            _bitmaps(offered, FILE, AT, __replaces=F.col("__goes"), __stays=~F.col("__goes")), "answers"
        )
        hits = _bitmaps(found.where("__goes"), "__in", "__on", __hit=F.lit(True), __again=F.col(FILE).isNotNull())
        files = target.select(*PLACE, F.xxhash64("_metadata.file_path").alias(FILE)).distinct()
        hits = stage.keep(hits.join(files, FILE), "hits")
        sizes = hits.groupBy(*PLACE).count().collect()  # at most the table's partitions
        places = sorted((r[BUCKET], r[BATCH]) for r in sizes)
        chunks = {(r[BUCKET], r[BATCH]): r["count"] for r in sizes}
        parts = [
            _marked(part, marks, ("__replaces", "__stays")).where("NOT __stays").drop("__stays")
            for part, marks in _parts(rows, answers)
        ]
        if not places and all(part.isEmpty() for part in parts):
            return
        if places:
            size += _in_places(target, places).select(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
            ).distinct().agg(F.sum("bytes")).first()[0]
        old = [
            _marked(_in_places(target, group), _in_places(hits, group), ("__hit", "__again"))
            for group in _passes([(place, chunks[place]) for place in places], PASS_CHUNKS)
        ]
        added = [
            _placed(write, part, places if list(keys) == write.keys else places[:1]) if places
            else write.new(part.drop("__replaces"))
            for part in parts
        ]
        if write.is_spread(size):
            kind = F.when(F.col("__hit"), F.when(F.col("__again"), "update_pre").otherwise("delete"))
            for part in old:
                write.keep_and_tell(part.withColumn(CHANGE, kind).drop("__hit", "__again"))
            old = []
            for part in added:
                write.rows(part, rebalance=False)
        else:  # to few files
            kept = [part.where("NOT __hit").drop("__hit", "__again") for part in old]
            write.rows(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*kept, *added]))
        for part in parts if places else []:
            write.changes(part.where("__replaces").drop("__replaces").withColumn(CHANGE, F.lit("update_post")))
        for part in old:
            kind = F.when(F.col("__again"), "update_pre").otherwise("delete")
            write.changes(part.where("__hit").withColumn(CHANGE, kind).drop(*PLACE, "__hit", "__again"))
        write.leave(places)
        write.publish(rows.schema)


def write_table(
    df: DataFrame,
    table_name: str,
    write_mode: str,
    merge_key: str | Sequence[str] | None = None,
    cluster_keys: Sequence[str] | None = None,
    option_dict: dict[str, str] | None = None,
    check_unique: bool = True,
    newer_by: str | None = None,
    replaced_keys: DataFrame | None = None,
    batch: str | None = None,
    buckets: int | None = None,
    rebalance: bool = True,
    more: Sequence[DataFrame] = (),
    from_files: bool = False,
) -> None:
    """Write ``df`` to a catalog table, creating it when missing.

    ``merge`` updates rows by ``merge_key`` and inserts the rest; ``append`` adds rows,
    with ``merge_key`` only those with a new key, so a repeated run adds nothing;
    ``overwrite`` replaces the rows. Keys match null-safe and must be unique in ``df``.
    With ``merge_key`` an overwrite writes only what differs: rows that are the same but for
    their clock columns stay.

    With ``newer_by``, a column that both sides can be ordered by, a keyed write of either
    mode replaces a stored row by a newer one and never by an older or equal one, so the
    result doesn't depend on how deliveries are cut or ordered. With ``replaced_keys`` a
    merge removes the stored rows of these keys, also where ``df`` has none in exchange.

    New columns are added to the table. ``cluster_keys`` order the files of every write.
    ``option_dict`` goes to the parquet writer. Rows that are unique by construction, such as
    the result of a group by, need no ``check_unique``, which saves a shuffle of the keys. A
    write whose ``batch`` name the table knows is skipped. ``buckets`` counts when the table is
    made: the unit that an upsert reads and writes, so give a large table hundreds. Without
    ``rebalance`` rows added to a table of one bucket are written by the tasks that bring them,
    a file each, and not shuffled to files of a good size first. ``more`` has further rows in the
    columns of ``df``, for keyed writes that merge or append; they are staged one after another.
    ``from_files`` says that the rows come from files by steps within each row, so a table that is made
    clustered reads them again instead of staging them.
    """
    mode = write_mode.lower()
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {write_mode!r}; use one of {WRITE_MODES}")
    keys = [merge_key] if isinstance(merge_key, str) else list(merge_key or [])
    if mode == "merge" and not keys:
        raise ValueError(f"merging into {table_name} needs a merge_key")
    if more and (mode == "overwrite" or not keys):
        raise ValueError(f"{table_name}: only a keyed merge or append takes rows in several parts")
    spark, options = df.sparkSession, dict(option_dict or {})

    if not spark.catalog.tableExists(table_name) and "layout" in subfolders(spark, table_folder(spark, table_name)):
        _register(spark, table_name)
    if not spark.catalog.tableExists(table_name):
        _create(df, table_name, keys, buckets, cluster_keys, options, check_unique, batch, rebalance, more, from_files)
        return
    _settle(spark, table_name)
    if batch and known_batch(spark, table_name, batch):
        return
    schema = table_schema(spark, table_name)
    if mode == "overwrite":
        with Stage(spark) as stage:
            rows = stage.keep(_to_table_types(df, schema), "overwrite")
            if not keys:
                _replace_all(rows, table_name, cluster_keys, options, batch)
                return
            if check_unique:
                require_unique(rows, keys, table_name)
            changed = stage.keep(_changed(_stored(spark, table_name), rows, keys), "changed")
            if not changed.isEmpty():
                marks = stage.keep(_bitmaps(changed.where(F.col(FILE).isNotNull()), FILE, AT, __differs=F.lit(True)), "differ")
                differs = [
                    _marked(part, bits, ("__differs",)).where("__differs").drop("__differs") for part, bits in _parts(rows, marks)
                ]
                _put(
                    differs, table_name, keys, cluster_keys, options, False, batch, True, None,
                    changed.where("__held").select(*keys),
                )
    elif keys:
        missing = [n for n in schema.names if n not in df.columns]
        if mode == "merge" and missing:
            raise ValueError(f"{table_name}: a merge replaces whole rows, but columns {missing} are missing")
        _put(
            [df, *more], table_name, keys, cluster_keys, options, check_unique, batch, mode == "merge", newer_by,
            replaced_keys,
        )
    else:
        with Stage(spark) as stage:
            rows = _to_table_types(df, schema)
            rows = stage.keep(rows, "append") if cluster_keys else rows
            _add_rows(rows, table_name, cluster_keys, options, batch, rebalance)


def _changed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between a stored state and new rows in files, clock columns aside.

    ``__held`` marks keys that the stored state has; a new row is named by its place. Rows meet as
    digests of 128 bits, which name missing values apart from others.
    """
    content = [n for n in new.columns if n not in (*CLOCKS, *keys)]

    def digests(df: DataFrame) -> list[Column]:
        values = [F.col(n) if n in df.columns else F.lit(None).cast(new.schema[n].dataType) for n in content]
        missing = [value.isNull() for value in values]
        return [F.xxhash64(*values, *missing).alias("__d1"), F.xxhash64(F.lit(1), *missing, *values[::-1]).alias("__d2")]

    held = old.select(*[F.col(k).alias(f"__{k}") for k in keys], *digests(old), F.lit(True).alias("__held"))
    given = _located(new).select(*keys, *digests(new), FILE, AT)
    match = reduce(and_, [held[f"__{k}"].eqNullSafe(given[k]) for k in keys])
    same = (held["__d1"] == given["__d1"]) & (held["__d2"] == given["__d2"])
    return held.join(given, match, "full_outer").where(~F.coalesce(same, F.lit(False))).select(
        *[F.when(F.col(FILE).isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        FILE, AT, F.coalesce("__held", F.lit(False)).alias("__held"),
    )


# Upkeep


def widen_columns(spark: SparkSession, table_name: str, types: dict[str, DataType]) -> None:
    """Give columns wider types.

    Where Spark's reader can read the stored files in the new type, only the catalog changes.
    Otherwise the rows are written anew once. While the catalog's entry is replaced the table
    is missing for a moment. Jobs that follow the table must have read what was there before a
    change that writes rows anew.
    """
    _settle(spark, table_name)
    old = table_schema(spark, table_name)
    new = StructType([StructField(f.name, types.get(f.name, f.dataType)) for f in old])
    if new == old:
        return
    write = _Write(spark, table_name, None, None, {})
    places = _known_places(spark, table_name)
    anew = places and not all(read_as(f.dataType, new[f.name].dataType) for f in old if f.dataType != new[f.name].dataType)
    if anew:
        rows = _stored(spark, table_name)
        write.rows(rows.withColumns({n: F.col(n).cast(t) for n, t in types.items() if n in old.names}), places)
    _write_layout(spark, table_name, write.number, new, write.keys, write.buckets)
    if anew:
        move_folder(spark, write.aside, f"{write.folder}/{write.generation}")
    spark.sql(f"DROP TABLE {table_name}")  # the files are the table's own and stay
    _register(spark, table_name)


def file_sizes(spark: SparkSession, name: str) -> DataFrame:
    """``(_bucket, _batch, file, bytes)`` of all files of a table."""
    return _stored(spark, name).select(
        *PLACE, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).distinct()


def _unpacked_bytes(schema: StructType) -> Column:
    """About the bytes of a row in memory: 8 for each column, and what its texts and nested values hold."""
    size = F.lit(8 * len(schema))
    for field in schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (StringType, BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(value), F.lit(0))
    return size.cast("long")


def compact(
    spark: SparkSession,
    table_name: str,
    cluster_keys: Sequence[str] | None = None,
    option_dict: dict[str, str] | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rewrite the partitions of small files, those of a bucket together, in files of ``target_bytes``.

    Rows that are packed tightly give smaller files: each is sorted by one task, so its rows
    take at most UNPACKED times ``target_bytes`` in memory, and count as much. A partition counts where its files have less than half that size on average and, with the
    other such partitions of its bucket, there are at least two files to put together. Other
    files stay where they are. The write brings no rows, so jobs that follow the table read
    nothing again.
    """
    _settle(spark, table_name)
    schema = table_schema(spark, table_name)
    per_place = file_sizes(spark, table_name).groupBy(*PLACE).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    small = per_place.where(F.col("bytes") / F.col("files") < target_bytes / 2).collect()  # at most the table's partitions
    if not small:
        return
    stored = _stored(spark, table_name)
    unpacked = _in_places(stored, [(r[BUCKET], r[BATCH]) for r in small]).groupBy(*PLACE).agg(
        F.sum(_unpacked_bytes(schema)).alias("unpacked")
    )
    sized = spark.createDataFrame(small).join(unpacked, [*PLACE], "left").withColumn(
        "bytes", F.greatest("bytes", F.ceil(F.col("unpacked") / UNPACKED))
    )
    buckets = sized.where(F.col("bytes") / F.col("files") < target_bytes / 2).groupBy(BUCKET).agg(
        F.sum("bytes").alias("bytes"), F.sum("files").alias("files"), F.array_sort(F.collect_list(BATCH)).alias("batches")
    ).where("files > 1").collect()  # at most the table's partitions
    if not buckets:
        return
    places = [(r[BUCKET], b) for r in buckets for b in r["batches"]]
    first = F.lit(None).cast("string")
    for r in buckets:
        first = F.when(F.col(BUCKET) == r[BUCKET], F.lit(r["batches"][0])).otherwise(first)
    write = _Write(spark, table_name, None, cluster_keys, dict(option_dict or {}))
    rows = _in_places(stored, places).withColumn(BATCH, first)
    files = sum(-(-r["bytes"] // target_bytes) for r in buckets)
    write.rows(rows, places, max(files, len(buckets)))
    write.publish(schema)


def expire_versions(spark: SparkSession, table_name: str, keep: int = 2) -> None:
    """Delete the generations before the last ``keep`` that no partition of the table lies in.

    Jobs that follow the table must have read them, and readers of old states must have ended.
    Whoever follows the table for the first time later finds what the kept generations brought.
    """
    folder, found = table_folder(spark, table_name), _settle(spark, table_name)
    newest: dict[tuple[int, str], str] = {}
    for generation in found:
        for kind in ("rows", "gone"):
            for bucket, batch, _ in _partitions(spark, f"{folder}/{generation}", kind):
                newest[bucket, batch] = generation
    used = set(newest.values())
    for generation in found[: len(found) - keep] if keep else found[:-1]:
        if generation not in used:
            remove_folder(spark, f"{folder}/{generation}")
