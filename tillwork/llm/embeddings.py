"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Equal vectors are one row with a count. The rest is rotated to its principal axes and sorted
into blocks along the first one; each pair of blocks is a task, unless the gap between them
on that axis already rules out the threshold. Inside a task, tiles of rows are compared by
accumulating products a few leading dimensions at a time. What the other dimensions can add is
bounded by the product of the rows' norms over them (Cauchy-Schwarz); pairs that cannot reach
the threshold any more are left out of the next step, and a tile without any ends early. What
remains is decided by the full cosine of the original vectors in double precision.

A task gives, for each row, how many vectors it links to and one edge per row to its group in
the task (a spanning forest), never the pairs; the sums and the components follow from these
rows.

Defined results. Null, empty and zero vectors and those with null or non-finite components
link with nothing, as do vectors of different length. Rows that repeat a vec_id are vectors of
their own for the counts and share their component. A null vec_id links like any other but is
in a component only with itself; ids are above -2^62. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork.llm.common import components, staged, table

THRESHOLD = 0.9
BLOCK_ROWS = 4096
TILE = 512
STEPS = (0.25, 0.5)  # shares of the dimensions after which the bound is looked at
MARGIN = 1e-9  # bounds are kept this much wider than rounding needs
LINKED = "first long, links long, joined long"


def normal_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, v)``; v is the vector in double precision, null if it cannot link."""
    v = F.col(column).cast("array<double>")
    usable = (
        (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    zero_free = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # -0.0 equals 0.0
    return embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), zero_free).alias("v"),
    )


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes ``(first, dims, v, n)`` and members ``(vec_id, first)``.

    Equal vectors are found by a 128-bit hash, counted before the shuffle. The class's number
    is its least vec_id, unless it has none or a class before it by hash has the same one; then
    the number comes from the hash and lies below all ids.
    """
    key = F.md5(F.to_json(F.struct("v")))
    keyed = vectors.where("v is not null").withColumn("key", key)
    counted = staged(keyed.groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")), "vector-counts")
    owner = counted.where("least is not null").groupBy(F.col("least").alias("id")).agg(F.min("key").alias("owner"))
    stand_in = -F.lit(1 << 62) - F.xxhash64("key").bitwiseAND(F.lit((1 << 60) - 1))
    classes = staged(
        counted.join(owner, counted["least"] == owner["id"], "left").select(
            "key", "least", "n", F.when(F.col("key") == F.col("owner"), F.col("least")).otherwise(stand_in).alias("first")
        ),
        "vector-classes",
    )
    members = keyed.join(classes, "key").select("vec_id", "first")
    chosen = keyed.join(classes, (keyed["key"] == classes["key"]) & keyed["vec_id"].eqNullSafe(classes["least"])).select(
        classes["first"], F.size("v").alias("dims"), "v", "n"
    ).dropDuplicates(["first"])
    return staged(chosen, "vectors"), members


def same_id_edges(members: DataFrame) -> DataFrame:
    """``(a, b)``: classes that hold a vec_id in common, a star around the least one of each id."""
    shared = staged(
        members.where("vec_id is not null").groupBy("vec_id").agg(F.min("first").alias("a"), F.max("first").alias("most"))
        .where("a <> most"),
        "shared-ids",
    )
    return members.join(shared, "vec_id").where("first <> a").select("a", F.col("first").alias("b")).distinct()


def matrix(batch_column: pa.Array) -> np.ndarray:
    flat = batch_column.combine_chunks() if isinstance(batch_column, pa.ChunkedArray) else batch_column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def principal_axes(classes: DataFrame, dims: int) -> np.ndarray:
    """Axes by falling variance of the unit vectors, from second moments over all rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = unit(matrix(batch.column(0)))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    rows = classes.where(F.col("dims") == dims).select("v").coalesce(
        int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ).mapInArrow(moments, "m binary").collect()  # one small matrix a task
    total = sum(np.frombuffer(r["m"]).reshape(dims, dims) for r in rows)
    return np.linalg.eigh(total)[1][:, ::-1]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large and small numbers survive."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_pairs(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float):
    """Index pairs of rows of unit ``a`` and ``b`` with cosine >= threshold.

    ``ra`` and ``rb`` are the rows along the principal axes.
    """
    dims = a.shape[1]
    cuts = [max(1, int(dims * s)) for s in STEPS]
    rest_a = [np.linalg.norm(ra[:, c:], axis=1) for c in cuts]
    rest_b = [np.linalg.norm(rb[:, c:], axis=1) for c in cuts]
    found_i, found_j = [], []
    for i in range(0, len(a), TILE):
        for j in range(0, len(b), TILE):
            x, y = ra[i : i + TILE], rb[j : j + TILE]
            sums = x[:, : cuts[0]] @ y[:, : cuts[0]].T
            bound = sums + rest_a[0][i : i + TILE, None] * rest_b[0][None, j : j + TILE]
            p, q = np.nonzero(bound >= threshold - MARGIN)
            if len(p) and len(cuts) > 1 and cuts[1] > cuts[0]:
                more = sums[p, q] + np.einsum("ij,ij->i", x[p, cuts[0] : cuts[1]], y[q, cuts[0] : cuts[1]])
                still = more + rest_a[1][i + p] * rest_b[1][j + q] >= threshold - MARGIN
                p, q = p[still], q[still]
            if len(p):
                cosine = np.einsum("ij,ij->i", a[i + p], b[j + q])
                linked = cosine >= threshold
                found_i.append(i + p[linked])
                found_j.append(j + q[linked])
    empty = np.empty(0, np.int64)
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (empty, empty)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row each row is connected with, by edges i-j."""
    least = np.arange(n)
    while len(i):
        low = np.minimum(least[i], least[j])
        before = least.copy()
        np.minimum.at(least, least[i], low)
        np.minimum.at(least, least[j], low)
        least = least[least]
        if (least == before).all() and (least[i] == least[j]).all():
            break
    while (least[least] != least).any():
        least = least[least]
    return least


def block_links(classes: DataFrame, dims: int, axes: np.ndarray, threshold: float) -> DataFrame:
    """``(first, links, joined)`` from every task; ``joined`` is a row of the same component.

    Each row goes to the tasks of its block with every block whose distance on the first axis
    allows the threshold: unit vectors with that cosine are at most sqrt(2 - 2 threshold)
    apart on any axis.
    """
    spark = classes.sparkSession
    first_axis = [float(x) for x in axes[:, 0]]
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    product = F.aggregate(
        F.zip_with("v", F.array(*map(F.lit, first_axis)), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
    )
    placed = staged(classes.where(F.col("dims") == dims).withColumn("at", product / norm), "vector-places")
    blocks = placed.count() // BLOCK_ROWS + 1
    shares = [i / blocks for i in range(1, blocks)]
    cuts = sorted(set(placed.approxQuantile("at", shares, 0.1 / blocks))) if shares else []
    gap = (2 - 2 * threshold) ** 0.5 + 1e-6
    edges = [-float("inf"), *cuts, float("inf")]
    n = len(edges) - 1
    # A hot place on the axis can't be cut there: it is dealt to several blocks by hash.
    of_block = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col("at"))) if cuts else F.lit(0)
    sized = staged(placed.withColumn("block", of_block), "vector-blocks")
    parts = {r["block"]: r["count"] // (2 * BLOCK_ROWS) + 1 for r in sized.groupBy("block").count().collect()}
    names = [(b, s) for b in sorted(parts) for s in range(parts[b])]
    place = {x: k for k, x in enumerate(names)}
    pairs = [
        (place[x], place[y])
        for i, x in enumerate(names) for y in names[i:]
        if edges[y[0]] - edges[x[0] + 1] <= gap
    ]
    tasks: dict[int, list[int]] = {k: [] for k in range(len(names))}
    for t, (x, y) in enumerate(pairs):
        tasks[x].append(t)
        if x != y:
            tasks[y].append(t)
    salt = F.create_map(*[F.lit(x) for b in sorted(parts) for x in (b, parts[b])])
    start = F.create_map(*[F.lit(x) for b in sorted(parts) for x in (b, place[b, 0])])
    slot = F.element_at(start, F.col("block")) + F.pmod(F.xxhash64("first"), F.element_at(salt, F.col("block"))).cast("int")
    todo = spark.createDataFrame(
        [(k, t, k != pairs[t][0]) for k, ts in tasks.items() for t in ts], "slot int, task int, second boolean"
    )

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        second = group.column("second").to_numpy(zero_copy_only=False).astype(bool)
        x = unit(matrix(group.column("v")))
        r = x @ axes
        number = group.column("first").to_numpy()
        n = group.column("n").to_numpy()
        one = np.flatnonzero(~second)
        two = np.flatnonzero(second) if second.any() else one
        i, j = linked_pairs(x[one], x[two], r[one], r[two], threshold)
        i, j = one[i], two[j]
        if two is one:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, n[j], len(n)) + np.bincount(j, n[i], len(n))
        least = forest(len(n), i, j)
        used = np.flatnonzero(links > 0)
        return pa.table(
            {"first": number[used], "links": links[used].astype(np.int64), "joined": number[least[used]]}
        )

    return (
        sized.withColumn("slot", slot).join(F.broadcast(todo), "slot")
        .select("task", "second", "first", "v", "n")
        .groupBy("task").applyInArrow(compare, LINKED)
    )


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    vectors = normal_vectors(embeddings)
    classes, members = distinct_vectors(vectors)
    found = None
    for dims in sorted(r["dims"] for r in classes.select("dims").distinct().collect()):
        part = block_links(classes, dims, principal_axes(classes, dims), threshold)
        found = part if found is None else found.unionAll(part)
    alone = F.lit(0).cast("long")
    if found is None:  # there is no class
        return vectors.select("vec_id", alone.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = staged(found, "vector-links")
    links = found.groupBy("first").agg(F.sum("links").alias("links"))
    edges = found.where("first <> joined").select(F.col("first").alias("a"), F.col("joined").alias("b"))
    joined = components(edges.unionAll(same_id_edges(members)), "vector-components")
    least = joined.groupBy(F.col("node").alias("first")).agg(F.min("component").alias("component"))
    # The least real id of a component: stand-ins of classes without ids don't count.
    known = (
        classes.select("first", "n").join(links, "first", "left").join(least, "first", "left")
        .select("first", "n", F.coalesce("links", alone).alias("links"), F.coalesce("component", "first").alias("component"))
    )
    known = staged(known, "vector-known")
    real = known.where(F.col("first") > -(1 << 62)).groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(real, "component", "left")
    linked = members.join(known, "first").select(
        "vec_id",
        (F.col("links") + F.col("n") - 1).alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
    apart = vectors.where("v is null").select("vec_id", alone.alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(apart).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
