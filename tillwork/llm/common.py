"""Small helpers the operators share: folds, staged tables, shingles, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork.session import scratch_folder

U64 = np.uint64


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def utf8(column: str) -> Column:
    """Text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: what is read no longer depends on executors that may be lost.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SLICE = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, U64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


POWERS, POWERS_INVERSE = _powers(BASE, SLICE + 1), _powers(BASE_INVERSE, SLICE + 1)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, in text order.

    Differences of prefix sums of byte * BASE^position, divided by BASE^start; texts are
    cut at white space into slices, so the tables of powers stay small.
    """
    out, at, n = [], 0, len(text)
    raw = np.frombuffer(text, np.uint8)
    while at < n:
        end = min(n, at + SLICE)
        if end - at == SLICE:
            gaps = np.flatnonzero(SPACE[raw[at:end]])
            if not len(gaps):
                while end < n and not SPACE[raw[end]]:
                    end += 1
                out.append(np.array([_long_word_hash(LOWER[raw[at:end]])], U64))
                at = end
                continue
            end = at + int(gaps[-1]) + 1
        out.append(_slice_hashes(raw[at:end]))
        at = end
    return scrambled(np.concatenate(out)) if out else np.empty(0, U64)


def _long_word_hash(word: np.ndarray) -> int:
    """Of a word of at least one slice: its slices' hashes, chained."""
    chained = 0
    for i in range(0, len(word), SLICE):
        part = word[i : i + SLICE].astype(U64) + U64(1)
        chained = (chained * 0xD6E8FEB86659FD93 + int((part * POWERS[: len(part)]).sum()) + len(part)) % (1 << 64)
    return chained


def _slice_hashes(raw: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SPACE[raw]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum((LOWER[raw].astype(U64) + U64(1)) * POWERS[: len(raw)], out=sums[1:])
    return (sums[ends] - sums[starts]) * POWERS_INVERSE[starts]


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words.

    Fewer words give one shingle of them all; no words give none.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    width = min(size, len(words))
    rolled = np.full(n, U64(width))
    for i in range(width):
        rolled = rolled * U64(BASE) + words[i : i + n]
    return np.unique(scrambled(rolled))


def smaller_batches(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches cut to at most ``rows`` rows, so one batch of texts stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """``(node, component)`` for every node of undirected ``edges (a, b)``; component is the least node.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its
    least neighbour, then its smaller neighbours too. A round is two aggregates and two joins,
    staged; the number of rounds grows with the logarithm of a component's diameter. Hot nodes
    are joins on the node, which the adaptive skew join splits, and minima, which are reduced
    before the shuffle.
    """
    pairs = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(),
        purpose,
    )
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        larger = staged(larger, purpose)
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u")
        pairs = staged(
            smaller.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v")))
            .distinct(),
            purpose,
        )
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
