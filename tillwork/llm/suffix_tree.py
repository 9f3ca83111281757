"""Language-model scores by a probabilistic suffix tree over the bytes of words.

A text is its tokens: lower-cased (A-Z) words, each followed by a space, then an end symbol.
The tree predicts each byte from the longest context it holds. Contexts are the last up to
DEPTH bytes; one is looked at when it makes up at least MIN_SHARE of all training positions,
and kept when its next-symbol distribution diverges from that of its suffix (relative entropy
of at least MIN_DIVERGENCE, and too much for chance at its count). Kept contexts keep their
suffixes. Distributions are smoothed by the suffix's distribution, the root's by one count for
every byte, so every token has a probability: the product of its bytes'.

A token's probability is WORD_SHARE times its share of the training tokens plus the rest times
what the tree gives its spelling. Shares add up to 1 and spellings to no more than 1, so it is a
proper mixture: all new tokens together have the rest, dealt by the tree. Without training rows
the tree stands alone.

Counts of all grams of the training texts are summed over the cluster and grow with them; what
reaches the driver are the contexts of MIN_SHARE, at most DEPTH / MIN_SHARE of them however
large the corpus, with at most 256 symbols each.

For the base score, token counts are summed over the cluster, too. Tokens of at least
COMMON_SHARE of all are at most 1 / COMMON_SHARE in number and go to every task; the others
are joined.

Defined results. A null text is empty: one token, the end. Rows are scored one by one, so rows
that repeat a doc_id are scored each; a null doc_id counts as the empty text in the fold.
Without training rows every byte is equally likely, counts are 0 and the base score is 0. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import U64, fold, smaller_batches, staged, table, utf8

DEPTH = 6
MIN_SHARE = 5e-5
WORD_SHARE = 0.7
MIN_DIVERGENCE = 0.01  # nats a symbol
CHANCE = 12.0  # a divergence must also exceed this many nats over all occurrences
SMOOTHING = 4.0  # counts that the suffix's distribution is worth
COMMON_SHARE = 5e-7
FOLDS, HELD_OUT = 7, 2
START, END = 0xFF, 0xFE  # bytes that UTF-8 never has
END_TOKEN = b""
SLICE = 1 << 20
HELD_GRAMS = 4 << 20
SCORED = (
    "task int, turn long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double,"
    " rare array<binary>, spelled array<double>"
)


def normal(text: bytes) -> bytes:
    """Lower-cased words, each followed by a space."""
    return b" ".join([*text.lower().split(), b""])


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each after DEPTH start symbols and with an end symbol; its starts."""
    pad, end = bytes([START]) * DEPTH, bytes([END])
    data = b"".join([pad + t + end for t in texts])
    sizes = np.array([len(t) + 1 + DEPTH for t in texts])
    return np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes


def gram_codes(symbols: np.ndarray) -> np.ndarray:
    """Each symbol with the DEPTH before it as one number, start symbols left out."""
    n = len(symbols) - DEPTH
    code = np.zeros(n, U64)
    for i in range(DEPTH + 1):
        code = (code << U64(8)) | symbols[i : i + n].astype(U64)
    return code[symbols[DEPTH:] != START]


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(counts, first)


def count_grams(docs: DataFrame) -> DataFrame:
    """``(code, n)`` over all texts; tasks sum what they hold before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(codes), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[at : at + 100_000].astype(np.int64)), pa.array(counts[at : at + 100_000])],
                    ["code", "n"],
                )

        new, held = [], 0
        total = (np.empty(0, U64), np.empty(0, np.int64))

        def merged() -> tuple[np.ndarray, np.ndarray]:
            fresh = np.unique(np.concatenate(new), return_counts=True)
            return summed(np.concatenate((total[0], fresh[0])), np.concatenate((total[1], fresh[1])))

        for batch in smaller_batches(batches, 256):
            symbols, _ = stream([normal(t) for t in batch.column(0).to_pylist()])
            for at in range(0, len(symbols), SLICE):
                new.append(gram_codes(symbols[at : at + SLICE + DEPTH]) if at + DEPTH < len(symbols) else np.empty(0, U64))
                held += len(new[-1])
                if held > HELD_GRAMS:
                    total, new, held = merged(), [], 0
                    if len(total[0]) > HELD_GRAMS:
                        yield from out(*total)
                        total = (np.empty(0, U64), np.empty(0, np.int64))
        if new:
            yield from out(*merged())
        else:
            yield from out(*total)

    return staged(
        docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "grams"
    )


def count_tokens(docs: DataFrame) -> DataFrame:
    """``(token, c)`` over all texts; the end token is the empty one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"]
            )
            counts.clear()

        for batch in smaller_batches(batches, 256):
            for text in batch.column(0).to_pylist():
                counts.update(text.lower().split())
                counts[END_TOKEN] += 1
            if len(counts) > 500_000:
                yield from out()
        if counts:
            yield from out()

    return staged(
        docs.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c")), "tokens"
    )


@dataclass
class SuffixTree:
    """``child[node, byte]`` goes one byte further back; the last node stands for none.

    ``log10[node, byte]`` is the next byte's log-probability.
    """

    symbols: np.ndarray  # column of each byte
    child: np.ndarray
    log10: np.ndarray

    def spelled(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each token of the normal texts, one after the other."""
        data, _ = stream(texts)
        none, done = len(self.child) - 1, 0
        out = np.zeros(sum(t.count(b" ") + 1 for t in texts))
        for at in range(0, max(0, len(data) - DEPTH), SLICE):
            column = self.symbols[data[at : at + SLICE + DEPTH]]
            n = len(column) - DEPTH
            node = np.zeros(n, np.int32)
            last = node
            for back in range(1, DEPTH + 1):
                node = self.child[node, column[DEPTH - back : DEPTH - back + n]]
                last = np.where(node != none, node, last)
            value = self.log10[last, column[DEPTH:]].astype(np.float64)
            here = data[at + DEPTH : at + DEPTH + n]
            value[here == START] = 0
            ends = (here == 0x20) | (here == END)
            token = done + np.cumsum(ends) - ends  # start symbols fall to the text they precede
            out += np.bincount(np.minimum(token, len(out) - 1), value, len(out))
            done += int(ends.sum())
        return out


def grow_tree(grams: DataFrame) -> SuffixTree:
    """Levels from the longest context down; only contexts of MIN_SHARE leave the cluster."""
    total = grams.agg(F.sum("n")).first()[0] or 0
    levels, level = [], grams
    for depth in range(DEPTH, -1, -1):
        mask = (1 << 8 * (depth + 1)) - 1
        if depth < DEPTH:
            level = staged(
                level.groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(F.sum("n").alias("n")), "level"
            )
        context = Window.partitionBy(F.shiftright("code", 8))  # at most 256 rows each
        shared = level.withColumn("all", F.sum("n").over(context)).where(F.col("all") >= max(2.0, MIN_SHARE * total))
        found = (shared if depth else level).select("code", "n").toArrow()
        levels.append((found["code"].to_numpy().astype(U64), found["n"].to_numpy()))
    return build_tree(levels[::-1])


def build_tree(levels: list[tuple[np.ndarray, np.ndarray]]) -> SuffixTree:
    """``levels[d]``: codes (context and symbol) and counts for contexts of d bytes."""
    used = np.unique(np.concatenate([(c >> U64(8 * i) & U64(255)).astype(np.int64) for d, (c, _) in enumerate(levels) for i in range(d + 1)] + [np.array([START, END])]))
    symbols = np.full(256, len(used), np.int64)  # the last column stands for bytes never met
    symbols[used] = np.arange(len(used))
    width = len(used) + 1
    codes, counts = levels[0]
    root = np.ones(256)
    np.add.at(root, codes.astype(np.int64), counts)
    root /= root.sum()
    unseen = root[symbols == len(used)]
    first = np.append(root[used], unseen[0] if len(unseen) else 1.0)
    # Distributions of all contexts looked at, by level; ``None`` is filled from the suffix.
    known: dict[int, np.ndarray] = {1: first}  # a leading 1 byte tells contexts of different length apart
    keep: dict[int, bool] = {1: True}
    order: list[list[int]] = [[1]]
    for depth, (codes, counts) in enumerate(levels[1:], 1):
        order.append([])
        contexts = codes >> U64(8)
        sort = np.argsort(contexts, kind="stable")
        contexts, column, counts = contexts[sort], symbols[(codes[sort] & U64(255)).astype(np.int64)], counts[sort]
        cuts = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(contexts) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(contexts)) if len(cuts) else []):
            name = int(contexts[a]) | 1 << 8 * depth
            suffix = int(contexts[a]) & (1 << 8 * (depth - 1)) - 1 | 1 << 8 * (depth - 1)
            below = known.get(suffix)
            if below is None:
                continue
            n = counts[a:b].sum()
            own = SMOOTHING * below
            np.add.at(own, column[a:b], counts[a:b])
            own /= n + SMOOTHING
            p = counts[a:b] / n
            divergence = float((p * np.log(p / below[column[a:b]])).sum())
            known[name] = own
            keep[name] = divergence >= MIN_DIVERGENCE and n * divergence >= CHANCE
            order[depth].append(name)
    for depth in range(len(order) - 1, 0, -1):  # suffixes of kept contexts are kept
        for name in order[depth]:
            if keep[name]:
                keep[name & (1 << 8 * (depth - 1)) - 1 | 1 << 8 * (depth - 1)] = True
    nodes = [name for names in order for name in names if keep[name]]
    number = {name: i for i, name in enumerate(nodes)}
    none = len(nodes)
    child = np.full((none + 1, width), none, np.int32)
    table_ = np.empty((none + 1, width), np.float32)
    table_[none] = 0
    for name, i in number.items():
        table_[i] = np.log10(known[name])
        depth = (name.bit_length() - 1) // 8
        if depth:
            suffix = name & (1 << 8 * (depth - 1)) - 1 | 1 << 8 * (depth - 1)
            farthest = name >> 8 * (depth - 1) & 255
            child[number[suffix], symbols[farthest]] = i
    return SuffixTree(symbols, child, table_)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        utf8("text").alias("text"),
    )
    training = rows.where("not held_out")
    tokens = count_tokens(training)
    tree = grow_tree(count_grams(training))
    n_all, distinct = tokens.agg(F.sum("c"), F.count("*")).first()
    n_all = n_all or 0
    common = tokens.where(F.col("c") >= max(1.0, COMMON_SHARE * n_all)).toArrow()
    values = dict(zip(common["token"].to_pylist(), map(float, common["c"].to_pylist())))
    size = n_all + distinct + 1
    word_share = WORD_SHARE if n_all else 0.0
    shared = spark.sparkContext.broadcast((tree, values))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, value = shared.value
        task, turn = TaskContext.get().partitionId(), 0
        for batch in smaller_batches(batches, 128):
            words = [text.lower().split() for text in batch.column(2).to_pylist()]
            spelled = model.spelled([b" ".join([*w, b""]) for w in words])
            for w in words:
                w.append(END_TOKEN)
            sizes = np.array([len(w) for w in words])
            flat = [w for own in words for w in own]
            c = np.array([value.get(w, -1.0) for w in flat])
            n, common_ = len(words), c >= 0
            owner = np.repeat(np.arange(n), sizes)
            mixed = np.log10(np.where(common_, word_share * c / max(1, n_all) + (1 - word_share) * 10.0**spelled, 1.0))
            rare = np.flatnonzero(~common_)
            cuts = np.searchsorted(owner[rare], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, task, np.int32)), pa.array(np.arange(turn, turn + n)),
                    batch.column(0), batch.column(1), pa.array(sizes),
                    pa.array(np.bincount(owner, common_, n).astype(np.int64)),
                    pa.array(np.bincount(owner[common_], np.log10(c[common_] + 1), n)),
                    pa.array(np.bincount(owner[common_], mixed[common_], n)),
                    pa.ListArray.from_arrays(cuts, pa.array([flat[i] for i in rare], pa.binary())),
                    pa.ListArray.from_arrays(cuts, pa.array(spelled[rare])),
                ],
                ["task", "turn", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "spelled"],
            )
            turn += n

    scored = staged(rows.mapInArrow(score, SCORED), "scored")
    rare = scored.select("task", "turn", F.explode(F.arrays_zip("rare", "spelled")).alias("r")).select(
        "task", "turn", F.col("r.rare").alias("token"), F.col("r.spelled").alias("spelled")
    )
    uncommon = tokens.where(F.col("c") < max(1.0, COMMON_SHARE * n_all))
    c = F.coalesce("c", F.lit(0))
    found = rare.join(uncommon, "token", "left").groupBy("task", "turn").agg(
        F.sum((c > 0).cast("long")).alias("more_known"),
        F.sum(F.log10(c + 1)).alias("more_base"),
        F.sum(
            F.when(
                c > 0,
                F.log10(F.lit(word_share / max(1, n_all)) * c + F.lit(1 - word_share) * F.pow(F.lit(10.0), F.col("spelled"))),
            ).otherwise(F.lit(math.log10(1 - word_share)) + F.col("spelled"))  # a long word's power may be 0
        ).alias("more_score"),
    )
    zero = F.lit(0.0)
    return scored.drop("rare", "spelled").join(found, ["task", "turn"], "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n_tokens") * F.lit(math.log10(size))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
