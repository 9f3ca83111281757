"""Document fingerprints by winnowing, with DataFrame functions only.

The words of a text are hashed, ``GRAM`` successive word hashes make a rolling gram hash, and
of every ``WIN`` successive grams the smallest is kept, the rightmost of equal ones, with its
position. Two texts that share ``GRAM + WIN - 1`` successive words share a kept gram; what is
shorter than ``GRAM`` words in common is never matched. Position and hash are one number, hash
first and position reversed, so a plain minimum breaks ties to the right. Grams and windows
are built by zipping an array with itself shifted, doubling the width each time, which costs
a few passes over the array whatever the widths.

The next document by doc_id is found without a total order in one task: rows are dealt to id
ranges, and each range also gets the first document of the following one as a sentinel, so a
window within a range sees every successor. The texts are shuffled once.

Defined results. Words are separated by white space as Java's ``\\s`` sees it; case counts. A
null text is empty; a text without words has the empty fingerprint. Texts of fewer than GRAM
words have one gram, of them all, and texts of fewer than WIN grams one window. Likeness is
the Jaccard index of the sets of gram hashes, 1 for two empty ones. Rows that share a doc_id
are ordered by text; null ids come last; after the last row comes the first; a lone row is its
own successor. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import table

GRAM = 3
WIN = 4
MULTIPLIER = 1_000_003
HASH_BITS = 31
POSITION_BITS = 31  # of the 62 bits of a non-negative number that are used
LAST_POSITION = (1 << POSITION_BITS) - 1


def shifted(values: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def over_windows(df: DataFrame, name: str, width: int, combine) -> DataFrame:
    """Replaces the array ``name`` by its combinations over ``width`` successive elements.

    ``combine(a, b, n)`` joins the combination ``a`` of some elements with ``b`` of the ``n``
    elements after them. A shorter array gives one element, the combination of all.
    """
    spans = {1: name}
    size = 1
    while size * 2 <= width:  # widths 2, 4, 8, ...
        made = f"{name}_{size * 2}"
        df = df.withColumn(made, _joined(spans[size], spans[size], size, size, combine))
        spans[size * 2], size = made, size * 2
    whole, done = spans[size], size
    while done < width:  # and what is left of the width from the largest spans that fit
        part = max(s for s in spans if s <= width - done)
        made = f"{name}_{done + part}"
        df = df.withColumn(made, _joined(whole, spans[part], done, part, combine))
        whole, done = made, done + part
        spans[done] = made
    short = F.aggregate(
        shifted(F.col(name), 1), F.get(name, F.lit(0)), lambda a, b: combine(a, b, 1)
    )
    out = F.when(F.size(name) == 0, F.col(name)).when(F.size(name) < width, F.array(short)).otherwise(F.col(whole))
    return df.withColumn(name, out).drop(*[s for s in spans.values() if s != name])


def _joined(first: str, second: str, done: int, part: int, combine) -> Column:
    """Pairs each element with the one ``done`` later; zipping pads, the padding is cut off."""
    later = shifted(F.col(second), done)
    padded = F.zip_with(F.slice(first, F.lit(1), F.size(later)), later, lambda a, b: combine(a, b, part))
    return padded


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the kept grams, hash in the high bits and reversed position in the low."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    mask = F.lit((1 << 40) - 1)
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(mask)))
    df = over_windows(
        df, out, GRAM, lambda a, b, n: (a * F.lit(pow(MULTIPLIER, n, 1 << 22)) + b).bitwiseAND(mask)
    )
    df = df.withColumn(
        out,
        F.transform(
            F.col(out),
            lambda g, i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(g), 64 - HASH_BITS), POSITION_BITS)
            + (F.lit(LAST_POSITION) - i),
        ),
    )
    df = over_windows(df, out, WIN, lambda a, b, n: F.least(a, b))
    return df.withColumn(out, F.array_distinct(out))


def hashes(grams: Column) -> Column:
    return F.array_distinct(F.transform(grams, lambda g: F.shiftright(g, POSITION_BITS)))


def likeness(a: str, b: str) -> Column:
    """Jaccard index of two arrays of distinct hashes."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def as_text(grams: Column) -> Column:
    """``hash@position`` of each kept gram, in text order."""
    return F.array_join(
        F.transform(
            grams,
            lambda g: F.concat(
                F.lower(F.hex(F.shiftright(g, POSITION_BITS))), F.lit("@"),
                (F.lit(LAST_POSITION) - g.bitwiseAND(F.lit(LAST_POSITION))).cast("string"),
            ),
        ),
        " ",
    )


def range_of(column: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the value, looked up in two steps."""
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def count_of(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= column))

    def longs(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    if not groups:
        return F.lit(0)
    group = count_of(longs([g[0] for g in groups]))
    inside = count_of(F.get(F.array(*[longs(g) for g in groups]), group - 1))
    return F.when(group == 0, 0).otherwise((group - 1) * width + inside)


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """``(doc_id, text, next_text)``; the driver holds a bound and an id for each range."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    quantiles = rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
    bounds = sorted({int(q) for q in quantiles})
    place = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(range_of(F.col("doc_id"), bounds))
    dealt = rows.withColumn("range", place.cast("int"))
    firsts = dealt.groupBy("range").agg(F.min("doc_id").alias("first")).orderBy("range").collect()
    # A range of null ids alone is the last one and starts with a null.
    before = {r["first"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}
    if not before:
        return rows.withColumn("next_text", F.lit(""))
    known = [k for k in before if k is not None]
    chosen = F.col("doc_id").isin(known) if known else F.lit(False)
    if None in before:
        chosen = F.col("doc_id").isNull() | F.coalesce(chosen, F.lit(False))
    earlier = F.create_map(*[F.lit(x) for k in known for x in (k, before[k])]) if known else None
    last = before.get(None, 0)
    sentinels = rows.where(chosen).groupBy("doc_id").agg(F.min("text").alias("text")).select(
        "doc_id", "text",
        (F.when(F.col("doc_id").isNull(), last).otherwise(F.element_at(earlier, F.col("doc_id"))) if known else F.lit(last))
        .cast("int").alias("range"),
        F.lit(True).alias("sentinel"),
    )
    successor = Window.partitionBy("range").orderBy("sentinel", F.col("doc_id").asc_nulls_last(), "text")
    return (
        dealt.withColumn("sentinel", F.lit(False)).unionByName(sentinels)
        .withColumn("next_text", F.lead("text").over(successor))
        .where("not sentinel").select("doc_id", "text", "next_text")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside that of its edited text, and both likenesses.

    The edited text has the second half replaced by the beginning of the next document.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, ranges).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn(
        "edited",
        F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)),
    ).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    for text, grams in (("text", "own"), ("edited", "changed"), ("next_text", "following")):
        rows = fingerprint(rows, text, grams).drop(text)
    rows = rows.withColumn("fingerprint", as_text(F.col("own"))).withColumn("edited_fingerprint", as_text(F.col("changed")))
    for grams in ("own", "changed", "following"):
        rows = rows.withColumn(grams, hashes(F.col(grams)))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
