"""Files in which rows that are near in several columns lie together."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

RANGE_BITS = 6  # each key is cut into 64 ranges
SAMPLE_ROWS = 8192  # from which the ranges' bounds are taken, or so many for each file
SAMPLE_ROWS_A_FILE = 32
SEED = 42  # of the sample
FILE_ROWS = 1 << 14  # of a file at least, as long as there are several
CELLS = 1 << 14  # pieces of the order, of which each file takes some
SPREAD = 1 << 20  # steps of the hash by which a large piece is cut


def range_bounds(sample: Sequence[Row], keys: Sequence[str], bits: int = RANGE_BITS) -> dict[str, list]:
    """Bounds that cut each key into 2^bits ranges of about equal numbers of rows."""
    bounds, ranges = {}, 1 << bits
    for key in keys:
        values = sorted(r[key] for r in sample if r[key] is not None)
        bounds[key] = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
    return bounds


def range_rank(key: str, bounds: Sequence) -> Column:
    """The number of bounds that a key is not below, by a binary search; a missing key has 0."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(F.col(key) < F.lit(bounds[middle]), search(lo, middle)).otherwise(search(middle + 1, hi))

    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(search(0, len(bounds))) if bounds else F.lit(0)


def z_rank(bounds: dict[str, Sequence], bits: int = RANGE_BITS) -> Column:
    """The keys' range ranks with their bits interleaved, the first key's bit first."""
    n, out = len(bounds), F.lit(0).cast("long")
    for place, (key, cuts) in enumerate(bounds.items()):
        rank = range_rank(key, cuts).cast("long")
        for bit in range(bits):
            here = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out + F.shiftleft(here, bit * n + n - 1 - place)
    return out


def _z_of(row: Row, bounds: dict[str, Sequence], bits: int = RANGE_BITS) -> int:
    """The z-rank of a row of the sample."""
    n, out = len(bounds), 0
    for place, (key, cuts) in enumerate(bounds.items()):
        rank = 0 if row[key] is None else bisect_right(cuts, row[key])
        out += sum((rank >> bit & 1) << (bit * n + n - 1 - place) for bit in range(bits))
    return out


def _numbers(values: Sequence, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _group(first: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.col(n).cast("string") for n in first])


def file_number(
    sample: Sequence[Row], bounds: dict[str, Sequence], first: Sequence[str], files: int, spread: Column,
    bits: int = RANGE_BITS,
) -> Column:
    """The file of a row, from 0: files follow the order of ``first`` and the z-rank, in equal numbers of rows.

    The order is cut into cells; a file takes neighbouring ones. A cell with more rows than a file
    is dealt to several by ``spread``, a hash of the row.
    """
    groups = sorted({tuple(r[n] for n in first) for r in sample}, key=repr)
    left = bits * len(bounds)  # bits of a cell's number, fewer where there are many groups
    while left and len(groups) << left > CELLS:
        left -= 1
    drop = bits * len(bounds) - left
    number = {group: at for at, group in enumerate(groups)}
    cells = [(number[tuple(r[n] for n in first)] << left) + (_z_of(r, bounds, bits) >> drop) for r in sample]
    weights, size, before = Counter(cells), len(sample) / files, 0
    starts, widths = [], []
    for cell in range(len(groups) << left):
        rows = weights[cell]
        large = rows > size
        starts.append(round((before if large else before + rows / 2) / size, 6))
        widths.append(round(rows / size, 6) if large else 0)
        before += rows
    names = [F.lit("/".join(str(v) for v in group)) for group in groups]
    group = F.greatest(F.array_position(F.array(*names), _group(first)) - 1, F.lit(0)) if len(groups) > 1 else F.lit(0)
    cell = (group * (1 << left) + (F.shiftright(z_rank(bounds, bits), drop) if bounds else F.lit(0))).cast("int")
    part = F.pmod(spread, F.lit(SPREAD)) / SPREAD
    found = F.floor(F.get(_numbers(starts, "double"), cell) + part * F.get(_numbers(widths, "double"), cell))
    return F.least(F.greatest(found.cast("int"), F.lit(0)), F.lit(files - 1))


def clustered(
    df: DataFrame, keys: Sequence[str], first: Sequence[str] = (), partitions: int | None = None, spread: Sequence[str] = ()
) -> DataFrame:
    """Range-partition and sort so that file statistics can skip data on every key.

    One key orders the rows itself; several order them by their z-rank, so none of them is
    scattered over all files. ``first`` columns, such as partition columns of the files, come
    before. A hash of the whole row cuts what is too large for a file, so rows of one hot key value
    go to several tasks instead of one. ``spread`` names columns that tell rows apart, such as a
    table's key, which are hashed in place of the whole row.

    Whole rows are read once for it. Their number and a sample come from ``first`` and the keys
    alone; only the layout depends on them.
    """
    conf, rows = df.sparkSession.conf, df.count()
    files = partitions or int(conf.get("spark.sql.shuffle.partitions"))
    settings = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    if not partitions and all(conf.get(n) == "true" for n in settings):
        files = max(1, min(files, -(-rows // FILE_ROWS)))
    order, sort = [*first, *keys], [*first, *keys]
    if rows and (files > 1 or len(keys) > 1):
        share = min(1.0, max(SAMPLE_ROWS, SAMPLE_ROWS_A_FILE * files) / rows)
        sample = df.select(*order).sample(share, seed=SEED).collect()
        bounds = range_bounds(sample, keys)
        if files > 1 and sample:
            digest = F.xxhash64(*(spread or df.columns))
            df = df.repartitionById(files, file_number(sample, bounds, first, files, digest))
        if len(keys) > 1:
            df, sort = df.withColumn("__z", z_rank(bounds)), [*first, "__z", *keys]
    if files == 1:
        df = df.repartition(1)
    return df.sortWithinPartitions(*sort).drop("__z")
