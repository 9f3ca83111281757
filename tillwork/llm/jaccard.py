"""N-gram Jaccard join with PartEnum signatures.

A document's set is its distinct word shingles, as 64-bit hashes, and is named by a 64-bit
digest of them, so equal sets are one set. Sizes are cut into bands whose limits grow by 1 / threshold, so linked sets
are in the same or in neighbouring bands, and a set signs once with its own band and once with
the next. For a pair of bands with largest size u, linked sets differ in at most
``k = floor(2 u (1 - t) / (1 + t))`` elements. The domain is partitioned into ``groups`` by
hash, each into PARTS parts, and for every group and each choice of all parts but one the
elements there make a signature. With 2 * groups > k some group holds at most one difference
and one of its choices none, so linked sets share a signature.

An empty choice makes no signature, as any two sets would share it. Then a pair can only be
missed if every group spends enough differences: none if the group is empty, one if all its
elements lie in one part, else two. A set whose groups spend at most k in all is signed again
by its smallest elements (prefix filter), which finds such pairs exactly.

Signatures leave a task as packed arrays, dealt by their hash. Each set also has a parity
sketch, whose distance to another never exceeds that of the sets. Sets that share a signature
are compared with the least of them: by sketch, then by their texts. Where sharing sets are
still in different components after that, pairs of different components are compared by
sketch, and those that pass by their texts. So groups of any size link completely without
their pairs being listed.

Defined results. Null, empty and wordless texts have the empty set and link with nothing.
Fewer words than a shingle make one of them all. Rows that repeat a doc_id tie their sets
together, as they are one document. A null doc_id names no document: the row keeps its size,
links with nothing and has a null component. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import (
    U64, components, scrambled, shingle_set, smaller_batches, staged, table, utf8,
)

WORDS = 5
THRESHOLD = (80, 100)  # links have NUMERATOR * union <= DENOMINATOR * intersection
PARTS = 3
SLACK = 1.06  # groups beyond the least number, so that few sets need signing again
SIGNATURES_PER_TASK = 1_500_000
SKETCH_BITS = 1024
SHARE_ROWS = 500  # partners of a pivot that are compared in one place
BLOCK = 2048  # sharing sets compared at once
MAP_BITS = 1 << 24  # of a bitmap of documents, as of those whose texts are asked for: 4 MB as rows


def bands(t: tuple[int, int], largest: int) -> list[int]:
    """Least sizes of the bands: 1 and then the next size that a set of the last can't link down to."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * t[1] // t[0])))
    return starts


def plan(t: tuple[int, int], upper: int) -> tuple[int, int]:
    """``(k, groups)`` for sets of at most ``upper`` elements."""
    k = 2 * upper * (t[1] - t[0]) // (t[1] + t[0])
    return k, max(1, int(np.ceil((k + 1) / 2 * SLACK)))


def signatures(elements: np.ndarray, t: tuple[int, int], starts: list[int]) -> np.ndarray:
    """All signatures of a set given as sorted hashes."""
    n = len(elements)
    band = int(np.searchsorted(starts, n, "right")) - 1
    mixed = np.concatenate(([U64(0)], np.cumsum(scrambled(elements ^ U64(0x5851F42D4C957F2D)))))
    out = []
    for space in (band, band + 1):
        upper = starts[space + 1] - 1 if space + 1 < len(starts) else -(-starts[space] * t[1] // t[0])
        k, groups = plan(t, upper)
        seed = U64((space + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        if k == 0:
            out.append(scrambled(np.array([mixed[-1] ^ seed])))
            continue
        cells = groups * PARTS
        # Elements are sorted and the cell grows with the element: cells are runs.
        cell = ((elements >> U64(32)) * U64(cells)) >> U64(32)
        ends = np.searchsorted(cell, np.arange(1, cells + 1, dtype=U64))
        bounds = np.concatenate(([0], ends))
        sums = (mixed[bounds[1:]] - mixed[bounds[:-1]]).reshape(groups, PARTS)
        counts = (bounds[1:] - bounds[:-1]).reshape(groups, PARTS)
        whole, size = sums.sum(1, keepdims=True), counts.sum(1, keepdims=True)
        choice = scrambled((whole - sums) ^ (seed + np.arange(cells, dtype=U64).reshape(groups, PARTS)))
        out.append(choice[size - counts > 0])
        filled = (counts > 0).sum(1)
        if int(np.minimum(filled, 2).sum()) <= k:
            least_common = -(-n * t[0] // t[1])
            out.append(scrambled(elements[: n - least_common + 1] ^ scrambled(np.array([seed + U64(1)]))))
    return np.concatenate(out)


def set_name(elements: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(elements: np.ndarray) -> bytes:
    """The parity of the number of elements in each of SKETCH_BITS cells."""
    odd = np.bincount((elements % U64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n, name, sketch)``; the name of an empty set is null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, 256):
            sets = [shingle_set(text, words) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_name(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n", "name", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n long, name long, sketch binary")


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane, so that the empty high bytes of small ones compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def signed(docs: DataFrame, words: int, t: tuple[int, int], starts: list[int], tasks: int) -> DataFrame:
    """``(task, sigs, sets, counts)``: packed signatures, the sets they belong to in the same
    order, and how many are each set's, by hash range.

    A set that occurs again in the same task is signed once. Inside a task of the next step
    32 bits of a signature are kept; two that agree by chance only cost a comparison.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owners, size, done = [], [], 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            sigs, own = np.concatenate(held), np.concatenate(owners)
            task = ((sigs >> U64(32)) * U64(tasks)) >> U64(32)
            order = np.argsort(task, kind="stable")
            sigs, own, task = sigs[order].astype("<u4"), own[order], task[order]
            runs = np.flatnonzero(np.concatenate(([True], (task[1:] != task[:-1]) | (own[1:] != own[:-1]))))
            names, lengths = own[runs], np.diff(np.append(runs, len(own)))
            starts_ = np.flatnonzero(np.concatenate(([True], task[1:] != task[:-1])))
            ends = np.append(starts_[1:], len(task))
            of = np.searchsorted(runs, np.append(starts_, len(task)))  # each task's runs
            yield pa.RecordBatch.from_arrays(
                [pa.array(task[starts_].astype(np.int32)),
                 pa.array([sigs[a:b].tobytes() for a, b in zip(starts_, ends)], pa.binary()),
                 pa.array([names[a:b].tobytes() for a, b in zip(of, of[1:])], pa.binary()),
                 pa.array([planes(lengths[a:b]) for a, b in zip(of, of[1:])], pa.binary())],
                ["task", "sigs", "sets", "counts"],
            )
            held.clear()
            owners.clear()

        for batch in smaller_batches(batches, 256):
            for text in batch.column(0).to_pylist():
                elements = shingle_set(text, words)
                name = set_name(elements)
                if not len(elements) or name in done:
                    continue
                done.add(name)
                found = signatures(elements, t, starts)
                held.append(found)
                owners.append(np.full(len(found), name, np.int64).view(U64))
                size += len(found)
            if size >= 2_000_000:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return docs.where("doc_id is not null").select("text").mapInArrow(
        sign, "task int, sigs binary, sets binary, counts binary"
    )


def sharing(packed: DataFrame, tasks: int) -> DataFrame:
    """``(mark, n, least, part, sets)``: for each signature of several sets, these sets in order.

    A list of ``n`` sets comes in parts of at most BLOCK; equal lists have equal marks.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by task; each task's arrays are met by themselves.
        task, sigs, owners = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != task and sigs:
                    yield from lists(np.concatenate(sigs), np.concatenate(owners))
                    sigs, owners = [], []
                task = row[0]
                sigs.append(np.frombuffer(row[1], "<u4"))
                owners.append(np.repeat(np.frombuffer(row[2], U64), from_planes(row[3])))
        if sigs:
            yield from lists(np.concatenate(sigs), np.concatenate(owners))

    def lists(sigs: np.ndarray, owners: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((owners.view(np.int64), sigs))
        sigs, owners = sigs[order], owners[order].view(np.int64)
        new = np.concatenate(([True], (sigs[1:] != sigs[:-1]) | (owners[1:] != owners[:-1])))
        sigs, owners = sigs[new], owners[new]
        first = np.flatnonzero(np.concatenate(([True], sigs[1:] != sigs[:-1])))
        sizes = np.diff(np.append(first, len(sigs)))
        several = sizes > 1
        seen, out = set(), []
        for a, n in zip(first[several], sizes[several]):
            data = owners[a : a + n]
            mark = hashlib.blake2b(data.tobytes(), digest_size=16).digest()
            if mark not in seen:
                seen.add(mark)
                for part, at in enumerate(range(0, n, BLOCK)):
                    out.append((mark, int(n), int(data[0]), part, data[at : at + BLOCK]))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
        for at in range(0, len(out), 1000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out[at : at + 1000]), kinds)],
                ["mark", "n", "least", "part", "sets"],
            )

    return packed.repartition(tasks, "task").sortWithinPartitions("task").mapInArrow(
        meet, "mark binary, n long, least long, part int, sets array<long>"
    )


def close(pairs: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """The ``pairs (a, b)`` whose sizes and sketches allow a link; ``sets`` (name, n, sketch)."""
    own = [sets.select(F.col("name").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            one, two = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u8").reshape(len(n), -1) for k in ("s_a", "s_b")
            )
            kept = pa.array(may_link(np.bitwise_count(one ^ two).sum(1, dtype=np.int64), n, t))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"]
            )

    return pairs.join(own[0], "a").join(own[1], "b").mapInArrow(compare, "a long, b long")


def may_link(apart: np.ndarray, total: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """Linked sets differ in at most ``total (1 - t) / (1 + t)`` elements, their sketches in no more."""
    return apart * (t[0] + t[1]) <= total * (t[1] - t[0])


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with a column ``maybe``: false for most doc_ids that are not among ``ids``, true for all that are.

    A bitmap of MAP_BITS bits, in at most MAP_BITS / 64 rows whatever the tables, goes to every
    task, so few texts are shuffled for an exact join that follows.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))
    place, bit = F.shiftright(slot, 6).cast("int"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {MAP_BITS}) % 64 as int))")
    bits = ids.select(place.alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    found = docs.withColumn("place", place).join(F.broadcast(bits), "place", "left")
    maybe = F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))
    return found.withColumn("maybe", maybe).drop("place", "bits")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, t: tuple[int, int]) -> DataFrame:
    """The linked ones of ``pairs (a, b)`` of set names; ``classes`` (name, doc_id) of one document each.

    Texts go to the share of their pivot ``a``, where the pivot's set is held while its
    partners stream past; a pivot of many pairs has many shares.
    """
    shares = pairs.groupBy("a").agg((F.floor(F.count("*") / SHARE_ROWS) + 1).alias("shares"))
    dealt = pairs.join(shares, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share"))
    wanted = dealt.select(F.col("b").alias("name"), "a", "share", F.lit(1).alias("role")).unionAll(
        dealt.select(F.col("a").alias("name"), "a", "share", F.lit(0).alias("role")).distinct()
    )
    wanted = staged(wanted.join(classes.select("name", "doc_id"), "name"), "wanted")
    offered = marked(docs.select("doc_id", "text"), wanted).where("maybe")
    rows = offered.join(wanted, "doc_id").select("a", "share", "role", "name", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, None
        for batch in smaller_batches(batches, 256):
            out = []
            for a, share_, role, name, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingle_set(text, words)
                if set_name(found) != name:  # another row of a repeated doc_id
                    continue
                if role == 0:
                    pivot, own = (a, share_), found
                    continue
                if (a, share_) != pivot:
                    raise ValueError("a pair came without its pivot")
                both = len(np.intersect1d(own, found, assume_unique=True))
                if t[1] * both >= t[0] * (len(own) + len(found) - both):
                    out.append((a, name))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return rows.repartition("a", "share").sortWithinPartitions("a", "share", "role").mapInArrow(
        compare, "a long, b long"
    )


def passing(open_lists: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Pairs ``(a, b)`` of a list in different components whose sketches allow a link.

    ``open_lists`` (mark, name, component, n, sketch). Lists longer than BLOCK are cut into
    blocks by hash, and each two blocks meet, so a task holds two blocks at a time. Lists
    stream past in order of their number; two lists that get one number are only compared
    more than they need be.
    """
    sized = open_lists.groupBy("mark").agg(F.floor(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = open_lists.join(sized, "mark").withColumn(
        "block", F.pmod(F.xxhash64("name"), F.col("blocks") + 1).cast("int")
    )
    faced = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks")))).select(
        F.xxhash64("mark", F.least("block", "other"), F.greatest("block", "other")).alias("list"),
        "name", "component", "n", "sketch",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            lists, *columns = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            columns.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), "<u8").reshape(len(lists), -1))
            cuts = [0, *(np.flatnonzero(lists[1:] != lists[:-1]) + 1).tolist(), len(lists)]
            for a, b in zip(cuts, cuts[1:]):
                if held and lists[a] != number:
                    yield from found(held)
                    held = []
                number = lists[a]
                held.append([c[a:b] for c in columns])
        if held:
            yield from found(held)

    def found(parts: list) -> Iterator[pa.RecordBatch]:
        name, part, n, bits = (np.concatenate(c) for c in zip(*parts))
        for at in range(0, len(name), 64):
            rows = slice(at, at + 64)
            apart = np.zeros((len(name[rows]), len(name)), np.int64)
            for word in bits.T:
                apart += np.bitwise_count(word[rows, None] ^ word[None, :])
            fits = may_link(apart, n[rows, None] + n[None, :], t)
            fits &= (part[rows, None] != part[None, :]) & (name[rows, None] < name[None, :])
            i, j = np.nonzero(fits)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(name[at + i]), pa.array(name[j])], ["a", "b"])

    spark = open_lists.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), open_lists.count() // 200_000 + 1)  # rows of 160 bytes
    return (
        faced.repartition(tasks, "list").sortWithinPartitions("list").mapInArrow(compare, "a long, b long").distinct()
    )


def apart_pairs(lists: DataFrame, place: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Pairs that may link, of sets of one list that ``place (node, component)`` keeps apart."""
    # Lists go by a number from here on, which is shorter; two that share one are compared as one.
    members = lists.where("n > 2").select(F.xxhash64("mark").alias("mark"), F.explode("sets").alias("name"))
    members = members.join(place.withColumnRenamed("node", "name"), "name", "left").select(
        "mark", "name", F.coalesce("component", "name").alias("component")
    )
    several = members.groupBy("mark").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    apart = staged(members.join(several.where("low <> high").select("mark"), "mark"), "apart")
    return passing(apart.join(sets.select("name", "n", "sketch"), "name"), t)


def linked_components(docs: DataFrame, words: int = WORDS, t: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    sets = staged(shingle_sets(docs, words), "sets")
    keyed = sets.where("name is not null and doc_id is not null")
    classes = staged(
        keyed.groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.first("sketch").alias("sketch")),
        "set-classes",
    )
    total, largest = classes.agg(F.sum("n"), F.max("n")).first()
    starts = bands(t, largest or 1)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int((total or 0) // SIGNATURES_PER_TASK) + 1)
    met = sharing(signed(docs, words, t, starts, tasks), tasks)
    lists = staged(met.dropDuplicates(["mark", "part"]), "sharing")
    pivots = lists.select(F.col("least").alias("a"), F.explode("sets").alias("b")).where("a <> b").distinct()
    pairs = staged(close(pivots, classes, t), "pairs")
    # Rows of one doc_id are one document: they tie their sets together.
    tied = keyed.groupBy("doc_id").agg(F.min("name").alias("a"), F.max("name").alias("z")).where("a <> z")
    tied = keyed.join(tied, "doc_id").select("a", F.col("name").alias("b")).where("a <> b")
    # Lists that these pairs leave apart bring their other pairs.
    more = apart_pairs(lists, components(pairs, "close"), classes, t)
    pairs = staged(pairs.unionAll(more).distinct(), "all-pairs")
    links = staged(verified(pairs, docs, classes, words, t).unionAll(tied), "links")
    place = components(links, "linked")
    # Pairs that passed for links but are none may have hidden pairs of their lists.
    hidden = staged(apart_pairs(lists, place, classes, t).join(pairs, ["a", "b"], "left_anti"), "hidden")
    if not hidden.isEmpty():
        links = staged(links.unionAll(verified(hidden, docs, classes, words, t)), "more-links")
        place = components(links, "linked-again")
    placed = staged(
        classes.join(place.withColumnRenamed("node", "name"), "name", "left")
        .select("name", "doc_id", F.coalesce("component", "name").alias("component")),
        "set-components",
    )
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = placed.join(least, "component").select("name", "component_id")
    return sets.join(answer, "name", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("name").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
        .alias("component_id"),
    )


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are the least of their component, all columns.

    What links with nothing stays, rows without a doc_id included. Of rows that repeat a
    kept doc_id the first by text stays.
    """
    found = staged(linked_components(docs.select("doc_id", "text")), "linked-documents")
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.count_if(F.col("doc_id") == F.col("component_id")).alias("kept")
    )
    # Rows of other ids stay as they are, where they are.
    odd = staged(ids.where("kept = 0 or rows > 1").select("doc_id", "kept"), "odd")
    # Rows travel as one struct, so no column of theirs meets one of ours.
    rows = docs.where("doc_id is not null").select(
        F.struct(*[docs[n] for n in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id")
    )
    rows = marked(rows, odd)
    turn = Window.partitionBy("doc_id").orderBy(F.col("row.text").asc_nulls_first())
    asked = (
        rows.where("maybe").join(odd, "doc_id", "left").where("kept is null or kept > 0")
        .withColumn("turn", F.row_number().over(turn)).where("turn = 1")
    )
    out = rows.where("not maybe").select("row").unionAll(asked.select("row")).select("row.*")
    return out.unionByName(docs.where("doc_id is null"))
