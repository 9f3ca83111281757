"""Hard negatives for anchors among embeddings, by a secondary-sort shuffle.

Scores are exact inner products of whole numbers, floor(256 * x) per component. Rows are dealt
into chunks by a hash; the anchors, a hundredth of the rows, go to every chunk and stream past
the chunk's rows in tiles. The first pass gives each anchor its best rows of the same label
per chunk, from which its positives follow. The second pass knows the positives' scores and
gives, per chunk, the first rows of another label in each positive's window.

What both passes found is shuffled by anchor and sorted by the packed key (anchor, descending
score, positives first, id). An iterator reads a task's rows once, in that order: a positive
opens its window, a negative goes to every window open that its score still reaches, full or
left-behind windows close. It holds the open windows of one anchor, at most ``positives`` of
them, never an anchor's rows. A chunk holds at most CHUNK_VALUES components.

Defined results. Rows with a null label, vector or id, or a null or non-finite component take
no part. Rows equal in id, label and numbers are one row; rows that share only the id are rows
of their own, also as anchors. Of vectors of different length the shorter one counts as
continued by zeros. Scores beyond 64 bits count as the largest or least such number. Labels
may be any number. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillwork.llm.common import staged, table

POSITIVES = 5
NEGATIVES = 5
LOW_SHARE = 80  # percent of the positive's score a negative needs at least
CHUNK_VALUES = 1 << 24
TILE_ROWS, TILE_ANCHORS = 8192, 256
EXACT = 2.0**52  # sums below are exact in doubles

FOUND = "anchor long, variant long, score long, kind int, id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_numbers(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``(id, label, q)``: rows that take part, each once, with numbers for components."""
    v = F.col(column).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        embeddings.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable)
        .select(
            F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
            F.transform(v, lambda x: F.floor(x * 256)).alias("q"),
        )
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``, as int64."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows, shorter ones continued by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]) if parts else np.zeros((0, 0), np.int64)


class Chunk:
    """The rows of a chunk by label and id, equal rows once."""

    def __init__(self, ids: list[np.ndarray], labels: list[np.ndarray], q: list[np.ndarray]):
        ids, labels, q = np.concatenate(ids), np.concatenate(labels), stacked(q)
        order = np.lexsort((*q.T[::-1], ids, labels)) if len(np.unique(ids)) < len(ids) else np.lexsort((ids, labels))
        ids, labels, q = ids[order], labels[order], q[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (q[1:] != q[:-1]).any(1)
        small = np.abs(q).max(initial=0) < 2**31
        self.ids, self.labels, self.q = ids[new], labels[new], q[new].astype(np.int32 if small else np.int64)


def first_per(group: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each group by falling score, then id."""
    order = np.lexsort((ids, ~score, group))
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < n]


def best_of_label(chunk: Chunk, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, n: int):
    """``(anchor index, row index, score)``: the first n other rows of each anchor's label."""
    found = []
    for label in np.unique(labels):
        mine = np.flatnonzero(labels == label)
        lo, hi = np.searchsorted(chunk.labels, [label, label + 1])
        best = (np.empty(0, np.int64),) * 3
        for at in range(lo, hi, TILE_ROWS):
            rows = np.arange(at, min(hi, at + TILE_ROWS))
            scores = products(q[mine], chunk.q[rows])
            if len(rows) > n:  # n others beside the anchor itself
                least = np.partition(scores, len(rows) - n - 1, axis=1)[:, len(rows) - n - 1]
                a, r = np.nonzero(scores >= least[:, None])
            else:
                a, r = (x.ravel() for x in np.indices(scores.shape))
            a, r, s = np.r_[best[0], a], np.r_[best[1], rows[r]], np.r_[best[2], scores[a, r]]
            itself = np.flatnonzero(chunk.ids[r] == ids[mine[a]])
            itself = itself[[
                np.array_equal(*_even(chunk.q[r[i]], q[mine[a[i]]])) for i in itself
            ]] if len(itself) else itself
            kept = np.setdiff1d(np.arange(len(a)), itself)
            kept = kept[first_per(a[kept], s[kept], chunk.ids[r[kept]], n)]
            best = a[kept], r[kept], s[kept]
        found.append((mine[best[0]], best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _even(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(len(x), len(y))
    return np.pad(x, (0, width - len(x))), np.pad(y, (0, width - len(y)))


def first_in_windows(a, r, s, ids, windows: list[np.ndarray], n: int) -> np.ndarray:
    """Places of the rows that are among the first ``n`` of a window of their anchor.

    ``a`` is the anchor's index, ``windows[a]`` its positives' scores; windows overlap, a row
    is given once.
    """
    order = np.lexsort((ids, ~s, a))
    a, s = a[order], s[order]
    anchors, starts = np.unique(a, return_index=True)
    taken = np.zeros(len(order), bool)
    for anchor, lo, hi in zip(anchors, starts, np.r_[starts[1:], len(a)]):
        falling = ~s[lo:hi]
        for top in windows[anchor]:
            first = lo + int(np.searchsorted(falling, ~top))
            last = lo + int(np.searchsorted(falling, ~least(top), "right"))
            taken[first : min(last, first + n)] = True
    return order[taken]


def least(top: int) -> int:
    """The least score in the window of a positive's score."""
    return -(-LOW_SHARE * int(top) // 100)


def in_windows(chunk: Chunk, labels: np.ndarray, q: np.ndarray, windows: list[np.ndarray], n: int):
    """``(anchor index, row index, score)``: the first n rows of other labels in each window."""
    top = np.array([max(w, default=-1) for w in windows], np.int64)
    low = np.array([min((least(x) for x in w if x >= 0), default=0) for w in windows], np.int64)
    best = (np.empty(0, np.int64),) * 3
    for at in range(0, len(chunk.ids), TILE_ROWS):
        rows = np.arange(at, min(len(chunk.ids), at + TILE_ROWS))
        scores = products(q, chunk.q[rows])
        a, r = np.nonzero(
            (scores <= top[:, None]) & (scores >= low[:, None]) & (chunk.labels[rows][None] != labels[:, None])
        )
        a, r, s = np.r_[best[0], a], np.r_[best[1], rows[r]], np.r_[best[2], scores[a, r]]
        kept = first_in_windows(a, r, s, chunk.ids[r], windows, n)
        best = a[kept], r[kept], s[kept]
    return best


def _passed_chunks(batches: Iterator[pa.RecordBatch], step) -> Iterator[pa.RecordBatch]:
    """Rows of each chunk come first and are gathered; its anchors follow and go by in tiles."""
    parts, chunk, now = ([], [], []), None, None
    for batch in batches:
        kinds = batch.column(0).to_numpy(zero_copy_only=False) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
        cuts = np.r_[0, np.flatnonzero(np.diff(kinds)) + 1, len(kinds)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(lo, hi - lo)
            number, kind = divmod(int(kinds[lo]), 2)
            if number != now:
                parts, chunk, now = ([], [], []), None, number
            ids, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            if kind == 0:
                for held, new in zip(parts, (ids, labels, matrix(part.column(4)))):
                    held.append(new)
                continue
            if chunk is None and parts[0]:
                chunk, parts = Chunk(*parts), ([], [], [])
            if chunk is None:
                continue
            for at in range(0, len(ids), TILE_ANCHORS):
                tile = part.slice(at, TILE_ANCHORS)
                i, r, s, kind_of = step(chunk, tile)
                anchors = tile.column(2).to_numpy(zero_copy_only=False)[i]
                variants = tile.column(5).to_numpy(zero_copy_only=False)[i]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors, pa.int64()), pa.array(variants, pa.int64()), pa.array(s, pa.int64()),
                        pa.array(np.full(len(s), kind_of), pa.int32()), pa.array(chunk.ids[r], pa.int64()),
                    ],
                    [x.split()[0] for x in FOUND.split(",")],
                )


def against_chunks(rows: DataFrame, anchors: DataFrame, chunks: int, step) -> DataFrame:
    """What ``step(chunk, anchors)`` finds for all anchors in all chunks."""
    none = F.lit(None)
    own = rows.select(
        F.pmod(F.xxhash64("id", "label", "q"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("kind"),
        "id", "label", "q", none.cast("long").alias("variant"), none.cast("array<long>").alias("windows"),
    )
    sent = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("kind"),
        "id", "label", "q", "variant", "windows",
    )
    return (
        own.unionAll(sent).repartitionById(chunks, "chunk").sortWithinPartitions("chunk", "kind")
        .mapInArrow(lambda batches: _passed_chunks(batches, step), FOUND)
    )


def _ids_labels_q(tile: pa.RecordBatch):
    return *(tile.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)), matrix(tile.column(4))


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of the packed key; windows open at positives and take negatives."""
    names, kinds = zip(*[x.split() for x in MINED.split(",")])
    types = [pa.int32() if k == "int" else pa.int64() for k in kinds]
    anchor, opened, windows = None, 0, []
    for batch in batches:
        out = []
        for *now, score, kind, found in zip(*[c.to_pylist() for c in batch.columns]):
            if now != anchor:
                anchor, opened, windows = now, 0, []
            if kind == 0:
                if opened < POSITIVES:
                    opened += 1
                    windows.append([found, score, least(score), 0])
                continue
            windows = [w for w in windows if w[3] < NEGATIVES and score >= w[2]]
            for window in windows:
                window[3] += 1
                out.append((now[0], window[0], window[3], found, window[1], score))
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


def hard_negatives(rows: DataFrame, is_anchor) -> DataFrame:
    """One row per anchor, positive and negative, from ``(id, label, q)``."""
    spark = rows.sparkSession
    # Equal rows are met before the shuffle, so many copies of a row stay one.
    rows = staged(rows.dropDuplicates(), "numbers")
    size = rows.agg(F.sum(F.size("q").cast("long"))).first()[0] or 0
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // CHUNK_VALUES))
    anchors = rows.where(is_anchor).withColumn("variant", F.xxhash64("label", "q"))

    def positives(chunk: Chunk, tile: pa.RecordBatch):
        return *best_of_label(chunk, *_ids_labels_q(tile), POSITIVES), 0

    def negatives(chunk: Chunk, tile: pa.RecordBatch):
        _, labels, q = _ids_labels_q(tile)
        windows = [np.array(w or [], np.int64) for w in tile.column(6).to_pylist()]
        return *in_windows(chunk, labels, q, windows, NEGATIVES), 1

    near = against_chunks(rows, anchors.withColumn("windows", F.lit(None).cast("array<long>")), chunks, positives)
    best = staged(first_by_score(near, POSITIVES), "positives")
    tops = best.groupBy("anchor", "variant").agg(F.collect_list("score").alias("windows"))
    known = anchors.join(
        tops, (anchors["id"] == tops["anchor"]) & (anchors["variant"] == tops["variant"])
    ).select("id", "label", "q", anchors["variant"], "windows")
    others = against_chunks(rows, known, chunks, negatives)
    # Rising order of ~score is falling order of score, also for the least number.
    key = F.struct("anchor", "variant", F.bitwise_not("score").alias("falling"), "kind", "id")
    return (
        best.unionAll(others).repartition("anchor", "variant")
        .withColumn("key", key).sortWithinPartitions("key").drop("key")
        .mapInArrow(streamed, MINED)
    )


def first_by_score(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("anchor", "variant").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def mined(embeddings: DataFrame) -> DataFrame:
    """For every hundredth id; every seventh id is given the next label first."""
    rows = whole_numbers(embeddings)
    moved = rows.withColumn(
        "label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return hard_negatives(moved, F.col("id") % 100 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, r.id, r.label = a.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM usable a, usable r WHERE a.id % 100 = 0 AND r.id <> a.id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
