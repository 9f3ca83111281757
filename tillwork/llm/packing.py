"""Best-fit packing of tokenised documents by minimum bin slack.

One pass over the texts tokenises them and cuts them into pieces of at most ``capacity``
ids; each piece gets its rank among the pieces of its length in its task. What the packing
itself needs is only how many pieces there are of each length: at most ``capacity`` numbers,
however large the input. For these numbers the plan is made bin by bin: the longest piece
left opens the bin, a bitset subset-sum over the lengths left finds the fullest combination
that fits beside it, and the combination is removed as often as its pieces last. The plan is
a list of combinations with their repeats; a piece finds its place by arithmetic from its
length and its rank, so no task ever holds a bin's or a length's pieces together.

Defined results. A null text is empty and gives one piece, the end id alone. The first piece
of a longer document takes what the full pieces after it leave. Rows that repeat a document
are packed as documents of their own. An empty table gives no rows. Other columns of the
input are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import smaller_batches, staged, table

CAPACITY = 1024
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, turn long"
PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)

_tokenizers: dict = {}


def added_tokens(path: str) -> dict[str, int]:
    """The special tokens that a JSON file adds to its vocabulary."""
    with open(path, encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"] if x["special"]}


def tokenizer(path: str, pattern: str, special: dict[str, int]):
    """The tokenizer of a rank file, loaded once in a worker."""
    key = path, pattern, tuple(sorted(special.items()))
    if key not in _tokenizers:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        _tokenizers[key] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _tokenizers[key]


def pieces(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """The pieces of all documents; ``turn`` is a piece's rank in its task and length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path, pattern, special or {})
        task, turns = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in smaller_batches(batches, 256):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(model.encode_to_numpy(text or "", allowed_special="all"), end_id).astype("<u4")
                at, number = 0, 0
                size = len(ids) % capacity or capacity
                while at < len(ids):
                    crc = zlib.crc32(ids[at : at + size].tobytes())
                    rows.append((doc_id, number, at, size, crc, task, int(turns[size])))
                    turns[size] += 1
                    at, number, size = at + size, number + 1, capacity
            yield _batch(rows, PIECES)

    return staged(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES),
        "pieces",
    )


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [x.split() for x in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields]
    )


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """The fullest combination ``[(length, how many)]`` of the pieces left that fits ``room``.

    ``reach[i]`` has bit s when the first i lengths (longest first) can fill exactly s. Many
    pieces of a length enter as 1, 2, 4, ... of them at once. The walk back takes a group
    only where the sum can't be reached without it, so longer pieces are preferred.
    """
    groups = []
    for length in range(min(room, len(counts) - 1), 0, -1):
        left, step = min(int(counts[length]), room // length), 1
        while left > 0:
            take = min(step, left)
            groups.append((length, take))
            left, step = left - take, step * 2
    mask, reach = (1 << (room + 1)) - 1, [1]
    for length, take in groups:
        reach.append((reach[-1] | reach[-1] << (length * take)) & mask)
        if reach[-1] >> room & 1:
            break
    rest, chosen = reach[-1].bit_length() - 1, {}
    for i in range(len(reach) - 1, 0, -1):
        if not reach[i - 1] >> rest & 1:
            length, take = groups[i - 1]
            rest -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def plan_bins(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """``[(repeats, [(length, how many), ...])]`` for ``counts[length]`` pieces."""
    counts, plan = counts.copy(), []
    capacity = len(counts) - 1
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        chosen = dict(fullest(counts, capacity - longest))
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        repeats = min(int(counts[length]) // n for length, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= repeats * n
        plan.append((repeats, sorted(chosen.items(), reverse=True)))
    return plan


class Places:
    """Looks up the bin and offset of the ``rank``-th piece of a length."""

    def __init__(self, plan: list[tuple[int, list[tuple[int, int]]]], capacity: int):
        used, first = np.zeros(capacity + 1, np.int64), 0
        entries: dict[int, list[tuple]] = {}
        for repeats, chosen in plan:
            offset = 0
            for length, n in chosen:
                entries.setdefault(length, []).append((int(used[length]), n, first, offset))
                used[length] += repeats * n
                offset += length * n
            first += repeats
        self.entries = {k: np.array(v, np.int64).T for k, v in entries.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length):
            here = np.flatnonzero(length == size)
            start, n, first, offset = self.entries[int(size)]
            i = np.searchsorted(start, rank[here], "right") - 1
            inside = rank[here] - start[i]
            bins[here] = first[i] + inside // n[i]
            offsets[here] = offset[i] + inside % n[i] * size
        return bins, offsets


def pack(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece with its sequence and place there; ``path`` is a rank file."""
    cut = pieces(docs, path, pattern, capacity, end_id, special)
    by_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = by_task.select(
        "length", "task",
        (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("earlier"),
    )
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    places = Places(plan_bins(counts), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, offsets = places.find(
                batch.column("length").to_numpy(zero_copy_only=False),
                batch.column("rank").to_numpy(zero_copy_only=False),
            )
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bins), pa.array(offsets)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return (
        cut.join(before, ["length", "task"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("turn")).alias("rank"))
        .mapInArrow(place, PACKED)
    )


def pack_documents(docs: DataFrame, special: bool = False) -> DataFrame:
    """With the vocabulary of byte_bpe_50k.

    Its rank file is used: the ids are the same as by the JSON file, several times faster.
    With ``special`` the JSON file's added tokens have their own ids where they stand in a
    text, as by the library's default; without it they are text (encode_special_tokens).
    """
    import public_tokenizers

    return pack(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        special=added_tokens(public_tokenizers.path("byte_bpe_50k.json")) if special else None,
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), special=True)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, special=True)
