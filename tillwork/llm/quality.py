"""Quality of documents by a generalised additive model with pairwise interactions.

A text becomes some twenty numbers: shares of kinds of characters, shapes of words and lines,
how much repeats. Each number is cut into bins at quantiles of the training rows. The model is
a constant, a table of additions per feature and a table per chosen pair of features. Tables
are learnt by cyclic boosting: feature after feature, round after round, a tree with a few
leaves over the feature's bins is fitted to the current gradients and a small share of it is
added to the table. Then pairs are ranked by what a tree over both features' bins would still
gain, and the best ones are boosted in the same way. Every fifth training row is set aside to
choose the number of rounds. A text's score is the logistic of the constant and the entries
its bins select, added up for a batch of texts at a time.

The model is fitted on the driver on at most TRAIN_ROWS labelled rows, chosen by a hash of
their id; all of them where there are fewer. Only their numbers are collected, no texts. The
texts are read in place: nothing but the sample's numbers is shuffled.

Defined results. A null text is empty; an empty text has the number 0 everywhere and a score
like any other. Long texts are read whole, class counts in slices. Labels other than 0 and 1
are left out, a document with both labels is a row of each. Rows that repeat a document are
scored one by one, alike. Where the training rows have one label only, the score is near that
label; without any it is 0.5. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm.common import BASE, SPACE, U64, fold, scrambled, smaller_batches, table, word_hashes

FOLDS, HELD_OUT = 5, 0
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
BINS, COARSE = 32, 8
PAIRS = 10
ROUNDS, PAIR_ROUNDS, PATIENCE = 400, 200, 30
RATE = 0.1
LEAVES, LEAST_ROWS, RIDGE = 4, 5, 1.0
SCORES = "doc_id long, held_out boolean, score double, predicted int"

# Classes of bytes.
LOWER, UPPER, DIGIT, BLANK, BREAK, SENTENCE, MARK, FIRST, NEXT = range(9)
CLASSES = np.full(256, MARK, np.uint8)
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58] = LOWER, UPPER, DIGIT
CLASSES[SPACE], CLASSES[10] = BLANK, BREAK
CLASSES[list(b".,;:'\"?-()")] = SENTENCE
CLASSES[128:192], CLASSES[192:] = NEXT, FIRST
NAMES = (
    "letters", "upper", "digits", "sentence", "marks", "shouts", "fences", "word_length", "word_ends", "mark_ends",
    "distinct", "top_word", "doubled", "repeated", "lines_repeated", "line_words", "short_lines", "entropy", "words",
)
SLICE = 1 << 20


def text_features(text: str) -> np.ndarray:
    """The numbers of one text, in the order of NAMES."""
    out = np.zeros(len(NAMES))
    data = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    words = word_hashes(data)
    if not len(words):
        return out
    counts = np.zeros(256, np.int64)
    ends = np.zeros(9, np.int64)  # classes of the words' last bytes
    for at in range(0, len(raw), SLICE):
        part = raw[at : at + SLICE]
        counts += np.bincount(part, minlength=256)
        after = raw[at + 1 : at + SLICE + 1]
        last = part[: len(after)][SPACE[after] & ~SPACE[part[: len(after)]]]
        ends += np.bincount(CLASSES[last], minlength=9)
    if not SPACE[raw[-1]]:
        ends[CLASSES[raw[-1]]] += 1
    by_class = np.bincount(CLASSES, counts, 9)
    letters = by_class[LOWER] + by_class[UPPER] + by_class[FIRST]
    shown = letters + by_class[DIGIT] + by_class[SENTENCE] + by_class[MARK]
    _, times = np.unique(words, return_counts=True)
    windows = words[:-3] * U64(BASE) ** U64(3) + words[1:-2] * U64(BASE) ** U64(2) + words[2:-1] * U64(BASE) + words[3:]
    n, lines = len(words), [x for x in data.split(b"\n") if x.strip()]
    share = counts[counts > 0] / len(raw)
    out[:] = (
        letters / max(shown, 1), by_class[UPPER] / max(letters, 1), by_class[DIGIT] / max(shown, 1),
        by_class[SENTENCE] / max(shown, 1), by_class[MARK] / max(shown, 1), counts[33] / n,
        counts[list(b"|<>{}[]\\")].sum() / n, shown / n, ends[SENTENCE] / n, ends[MARK] / n,
        len(times) / n, times.max() / n, np.count_nonzero(words[1:] == words[:-1]) / n,
        1 - len(np.unique(scrambled(windows))) / len(windows) if len(windows) else 0.0,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        sum(len(x) < 40 for x in lines) / len(lines), -(share * np.log2(share)).sum(), np.log1p(n),
    )
    return out


def features(texts: list[str | None]) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts]).reshape(len(texts), len(NAMES))


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """``(gain, cut)`` of the best cut of a row of bins; cut 0 where none is allowed."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(nl < LEAST_ROWS) | (n.sum() - nl < LEAST_ROWS)] = 0
    if not len(gain) or gain.max() <= 1e-12:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """``(gain, additions per bin)`` of a tree of at most LEAVES leaves over one feature's bins."""
    leaves, total = [(0, len(g))], 0.0
    cuts = {(0, len(g)): best_cut(g, h, n)}
    while len(leaves) < LEAVES:
        leaf = max(leaves, key=lambda x: cuts[x][0])
        gain, cut = cuts[leaf]
        if not cut:
            break
        total += gain
        leaves.remove(leaf)
        for part in ((leaf[0], leaf[0] + cut), (leaf[0] + cut, leaf[1])):
            leaves.append(part)
            cuts[part] = best_cut(*(x[part[0] : part[1]] for x in (g, h, n)))
    out = np.zeros(len(g))
    for lo, hi in leaves:
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return total, out


def shallow_tree_of_two(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The same over the bins of two features: one cut, then one in each part, along either."""

    def cut(box):
        sums = [[x[box].sum(axis) for x in (g, h, n)] for axis in (1, 0)]
        found = [best_cut(*s) for s in sums]
        axis = int(found[1][0] > found[0][0])
        gain, at = found[axis]
        if not at:
            return 0.0, [box]
        start = box[axis].start or 0
        stop = box[axis].stop
        parts = [slice(start, start + at), slice(start + at, stop)]
        return gain, [(p, box[1]) if axis == 0 else (box[0], p) for p in parts]

    total, leaves = cut((slice(0, g.shape[0]), slice(0, g.shape[1])))
    more = [cut(box) for box in leaves] if total else [(0.0, leaves)]
    out = np.zeros(g.shape)
    for gain, boxes in more:
        total += gain
        for box in boxes:
            out[box] = -g[box].sum() / (h[box].sum() + RIDGE)
    return total, out


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(y > 0, -z, z)))) if len(y) else 0.0


@dataclass
class Additive:
    """Bins and tables; ``score`` adds up what a batch's bins select."""

    constant: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(
            np.stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(cuts)], 1) if len(cuts) else x[:, :0].astype(int)
            for cuts in (self.cuts, self.coarse)
        )

    def raw(self, x: np.ndarray) -> np.ndarray:
        fine, coarse = self.binned(x)
        z = np.full(len(x), self.constant)
        for i, t in enumerate(self.tables):
            z += t[fine[:, i]]
        for i, j, t in self.pairs:
            z += t[coarse[:, i], coarse[:, j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.raw(x))


def quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(x) else np.empty(0)


class _Boost:
    """Cyclic boosting of tables; the rows set aside say how many rounds are kept."""

    def __init__(self, z: np.ndarray, y: np.ndarray, learn: np.ndarray):
        self.z, self.y, self.learn = z, y, learn

    def histograms(self, places: np.ndarray, size: int) -> list[np.ndarray]:
        at, p = places[self.learn], logistic(self.z[self.learn])
        return [np.bincount(at, w, size) for w in (p - self.y[self.learn], p * (1 - p), np.ones(len(at)))]

    def run(self, places: list[np.ndarray], shapes: list[tuple[int, ...]], grow, rounds: int) -> list[np.ndarray]:
        tables = [np.zeros(s) for s in shapes]
        kept, z, aside = [t.copy() for t in tables], self.z.copy(), ~self.learn
        best, waited = log_loss(self.z[aside], self.y[aside]), 0
        for _ in range(rounds):
            for i, (at, shape) in enumerate(zip(places, shapes)):
                sums = self.histograms(at, int(np.prod(shape)))
                step = RATE * grow(*[s.reshape(shape) for s in sums])[1]
                tables[i] += step
                self.z += step.ravel()[at]
            loss = log_loss(self.z[aside], self.y[aside])
            if not aside.any() or loss < best - 1e-6:
                best, waited, kept, z = loss, 0, [t.copy() for t in tables], self.z.copy()
            else:
                waited += 1
                if waited >= PATIENCE:
                    break
        self.z = z
        return kept


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Rows of ``x`` with labels 0 and 1; their order does not matter to the bins, only to ties."""
    if not len(y):
        return Additive()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Additive(float(np.log(rate / (1 - rate))))
    if y.min() == y.max():
        return model
    model.cuts = [quantile_cuts(x[:, i], BINS) for i in range(x.shape[1])]
    model.coarse = [quantile_cuts(x[:, i], COARSE) for i in range(x.shape[1])]
    fine, coarse = model.binned(x)
    learn = np.ones(len(y), bool)
    for label in (0, 1):  # every fifth row of either label is set aside
        learn[np.flatnonzero(y == label)[4::5]] = False
    boost = _Boost(np.full(len(y), model.constant), y.astype(float), learn)
    shapes = [(len(c) + 1,) for c in model.cuts]
    model.tables = boost.run(list(fine.T), shapes, shallow_tree, ROUNDS)

    sizes, gains = [len(c) + 1 for c in model.coarse], []
    for i, j in combinations(range(x.shape[1]), 2):
        at = coarse[:, i] * sizes[j] + coarse[:, j]
        sums = [s.reshape(sizes[i], sizes[j]) for s in boost.histograms(at, sizes[i] * sizes[j])]
        gains.append((-shallow_tree_of_two(*sums)[0], i, j))
    chosen = [(i, j) for gain, i, j in sorted(gains)[:PAIRS] if gain < 0]
    found = boost.run(
        [coarse[:, i] * sizes[j] + coarse[:, j] for i, j in chosen], [(sizes[i], sizes[j]) for i, j in chosen],
        shallow_tree_of_two, PAIR_ROUNDS,
    )
    model.pairs = [(i, j, t) for (i, j), t in zip(chosen, found)]
    # Tables with mean 0 over the training rows; the constant takes the rest.
    for i, t in enumerate(model.tables):
        mean = t[fine[:, i]].mean()
        model.constant, model.tables[i] = model.constant + mean, t - mean
    return model


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Additive:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality) outside the held-out fold."""
    sample = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
        .where(fold("doc_id", FOLDS) != HELD_OUT).distinct()
        .orderBy(F.xxhash64("doc_id"), "quality").limit(train_rows)
    )
    # The sample's ids are at most ``train_rows``, so they go to the texts.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("quality", F.col("text").cast("string"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, 256):
            x = features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["quality", "x"]
            )

    found = (
        rows.mapInArrow(count, "quality int, x array<double>")
        # A repeated id may bring more rows than the sample has ids.
        .orderBy(F.xxhash64("x"), "x", "quality").limit(train_rows).collect()
    )
    return fit(
        np.array([r["x"] for r in found]).reshape(len(found), len(NAMES)), np.array([r["quality"] for r in found], int)
    )


def score_documents(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some ten thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, 512):
            scores = shared.value.score(features(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                [x.split()[0] for x in SCORES.split(",")],
            )

    return docs.select(
        F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string")
    ).mapInArrow(score, SCORES)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_documents(docs, train(docs, labels))
