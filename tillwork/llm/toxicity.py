"""Toxicity: restore disguised words by a noisy-channel decoder, then score the restored text.

The character model is a trigram model over the letters of plain words, counted over all
training texts. A word with digits or signs between its letters, or with a letter three times
in a row, is a lattice: a sign may be itself, a letter it stands for, or nothing; a repeated
letter may be dropped. Single letters and signs set apart by blanks are a run, and its
blanks are in the lattice too: each is dropped or ends a word. Viterbi finds the path that is
likeliest under the character model and the channel's costs. A run is read with word ends at
par and favoured, and with its first or last letter as a word of its own; long runs and long
words are read in overlapping pieces. Each distinct disguised word is decoded once in a worker.

The scorer is a logistic regression on the words of the restored text and their beginnings.
Features come from a bounded sample of labelled training rows (``TRAIN_ROWS``, by hash order)
and are kept where they go with the label beyond chance (log-likelihood ratio), so the many
other words of a long text add nothing.

Defined results. Null, empty and wordless texts score the model's bias. Rows are independent,
so repeated rows repeat their result. Without rows of both labels every score is 0. Labels
that are null or repeated in conflict count once per row. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm.common import fold, smaller_batches, table

TRAIN_ROWS = 12_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
MIN_DOCS = 4
MIN_RATIO = 25.0  # log-likelihood ratio of a kept feature
STARTS = (3, 4, 5, 6, 7, 8)
MAX_FEATURES = 20_000
MEMORY = 200_000

# What a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
# Channel costs in natural logarithms.
COST_LEET, COST_KEPT_SIGN, COST_DROPPED_LEET, COST_DROPPED_SIGN, COST_DROPPED_REPEAT = 1.0, 8.0, 8.0, 2.0, 0.5
COST_DROPPED_GAP, GAIN_WORD_END = 4.0, 2.0  # a blank wider than the others; a word end where favoured

EDGES = " \t\n\r\v\f.,;:?!\"'()[]{}<>|*%&$#@^~`´_-+=/\\…“”„«»¿¡"
# A unit of a run is a letter, a digit or a sign that may stand for a letter. The parts exclude
# each other at any place, so a search takes linear time.
UNIT = r"(?:[^\W_]|[@$!|+(€£]|(?<=\s)\*(?=\s))"
GAP = r"(?:\s?[.\-_]{1,2}\s?|\*{1,2}\s?|\s\*(?!\s)|\s{1,3})"
SPACED = re.compile(rf"(?<!\S)(?:{UNIT}{GAP}){{2,}}{UNIT}(?=[.,;:?!]?(?:\s|\Z))")
PARTS = re.compile(rf"({UNIT})({GAP}|\Z)")
REPEATED = re.compile(r"([^\W\d_])\1\1")
LEADING = "$@€£|!"  # signs that may stand for a word's first letter
LONG_REPEAT = re.compile(r"([^\W\d_])\1{3,}")
WORD_LENGTH = 100  # longer words and runs are decoded in pieces that overlap by half

# The character model's letters: Latin with its common accents; 0 is any other character
# past them, 1 an edge.
LETTERS = sorted({c for n in range(0x180) if (c := chr(n).lower()).isalpha() and len(c) == 1 and ord(c) < 0x180})
INDEX = {c: i + 2 for i, c in enumerate(LETTERS)} | {"\0": 1}
SIZE = len(LETTERS) + 2
CLASS = np.array([INDEX.get(chr(n).lower(), 1) for n in range(0x180)] + [0], np.int64)
SCORES = "doc_id long, held_out boolean, score double, predicted int"


def triple_counts(text: str) -> np.ndarray:
    """How often each triple of character classes occurs, words standing between edges."""
    points = np.frombuffer(f"\n{text}\n".encode("utf-32-le"), "<u4")
    kind = CLASS[np.minimum(points, 0x180)]
    c, b = kind[1:], kind[:-1]
    a = np.where(b == 1, 1, np.concatenate(([1], kind[:-2])))
    used = (b != 1) | (c != 1)
    return np.bincount(((a * SIZE + b) * SIZE + c)[used], minlength=SIZE**3)


@dataclass
class CharacterModel:
    """Trigram log-probabilities over letters and word edges."""

    trigrams: np.ndarray
    memory: dict[str, str] = field(default_factory=dict)
    runs: dict[str, frozenset[tuple[str, ...]]] = field(default_factory=dict)

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> CharacterModel:
        """From counts of triples; every level is smoothed by the next shorter one."""
        cube = counts.reshape((SIZE,) * 3).astype(float)
        one = (cube.sum((0, 1)) + 1) / (cube.sum() + SIZE)
        pairs = cube.sum(0)
        two = (pairs + 5 * one) / (pairs.sum(1, keepdims=True) + 5)
        three = (cube + 5 * two[None]) / (cube.sum(2, keepdims=True) + 5)
        return cls(np.log(three).astype(np.float32))

    def restore(self, word: str) -> str:
        """The likeliest reading of a lower-case word."""
        known = self.memory.get(word)
        if known is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            known = self.memory[word] = self.viterbi(word)
        return known

    def viterbi(self, word: str, word_end: float = 0.0) -> str:
        """Best path through the lattice; a state is the last two letters read.

        A blank is dropped or, at the cost ``word_end``, ends a word; a tab is a wide blank and a
        line feed always ends a word.
        """
        index, table_ = INDEX, self.trigrams
        states: dict[tuple[str, str], tuple[float, tuple | None]] = {("\0", "\0"): (0.0, None)}
        run = any(c.isspace() for c in word)
        drops = not run or REPEATED.search("".join(word.split())) is not None
        before = ""
        for at, sign in enumerate(word):
            arcs: list[tuple[str, float]] = []
            if sign.isspace():
                after: dict[tuple[str, str], tuple[float, tuple | None]] = {}
                for (a, b), (score, path) in states.items():
                    end = ("\0", "\0")
                    new = score if b == "\0" else score - word_end + table_[index.get(a, 0), index.get(b, 0), 1]
                    if end not in after or new > after[end][0]:
                        after[end] = (new, path if b == "\0" else (path, " "))
                    if sign != "\n" and b != "\0":
                        after[a, b] = (score - (COST_DROPPED_GAP if sign == "\t" else 0.0), path)
                states = after
                continue
            if sign.isalpha():
                arcs.append((sign, 0.0))
                if at and before == sign and drops:
                    arcs.append(("", -COST_DROPPED_REPEAT))
            else:
                arcs.append((sign, -COST_KEPT_SIGN))
                arcs.append(("", -(COST_DROPPED_LEET if sign in STANDS_FOR else COST_DROPPED_SIGN)))
                arcs += [(c, -COST_LEET) for c in STANDS_FOR.get(sign, "")]
            before = sign
            following: dict[tuple[str, str], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                for letter, cost in arcs:
                    if letter:
                        state = (b, letter)
                        new = score + cost + table_[index.get(a, 0), index.get(b, 0), index.get(letter, 0)]
                        step = (path, letter)
                    else:
                        state, new, step = (a, b), score + cost, path
                    best = following.get(state)
                    if best is None or new > best[0]:
                        following[state] = (new, step)
            states = following
        ends = (
            (score + table_[index.get(a, 0), index.get(b, 0), 1], path) for (a, b), (score, path) in states.items()
        )
        path, letters = max(ends, key=lambda x: x[0])[1], []
        while path is not None:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters))

    def restore_run(self, run: str) -> frozenset[tuple[str, ...]]:
        """The words of a run in all its readings; see ``viterbi`` for its blanks."""
        known = self.runs.get(run)
        if known is None:
            if len(self.runs) >= MEMORY:
                self.runs.clear()
            blanks = [i for i, c in enumerate(run) if c.isspace()]
            forms = {run, *(run[:i] + "\n" + run[i + 1 :] for i in (blanks[0], blanks[-1]))}
            read = {self.viterbi(f, cost) for f in forms for cost in (0.0, -GAIN_WORD_END)}
            known = self.runs[run] = frozenset(tuple(r.split()) for r in read)
        return known


def overlapping(length: int, size: int = WORD_LENGTH) -> list[tuple[int, int]]:
    """Pieces that overlap by half and together hold everything."""
    return [(at, min(at + size, length)) for at in range(0, max(1, length - size // 2), size // 2)]


def run_words(units: list[tuple[str, str]], model: CharacterModel) -> set[str]:
    """The words of a run, given as units and the gaps after them.

    A word that a cut touches is whole in the piece beside it, so it is left out, unless it is
    all there is of its piece.
    """
    if not any(u.isalpha() for u, _ in units):
        return {"".join(u for u, _ in units)}
    out: set[str] = set()
    for at, end in overlapping(len(units)):
        piece = units[at:end]
        text = "".join(u + ("\t" if len(gap) > 1 and gap.isspace() else " ") for u, gap in piece[:-1]) + piece[-1][0]
        for words in model.restore_run(text) if len(piece) > 1 else [(piece[0][0],)]:
            if len(words) > 1:
                words = words[at > 0 : len(words) - (end < len(units))]
            out.update(words)
    return out


def spaced_words(text: str, model: CharacterModel) -> set[str]:
    """The words of the runs of single letters and signs set apart by blanks or signs."""
    out: set[str] = set()
    for m in SPACED.finditer(text):
        out |= run_words(PARTS.findall(m.group().lower()), model)
    return out


def readings(word: str, model: CharacterModel) -> set[str]:
    """A token as it stands, without the signs around it, and restored where it looks disguised."""
    core = word.strip(EDGES)
    if not core:
        return set()
    out = {core}
    if (not core.isalpha() and any(map(str.isalpha, core))) or REPEATED.search(core):
        out |= restored(core, model)
    if word[0] in LEADING and core[0] == word.lstrip(LEADING)[0]:
        out |= restored(word.rstrip(EDGES), model)
    return out


def restored(word: str, model: CharacterModel) -> set[str]:
    """The likeliest reading; of a long word those of its pieces."""
    if len(word) <= WORD_LENGTH:
        return {model.restore(word)}
    word = LONG_REPEAT.sub(r"\1\1\1", word)
    return {model.restore(word[a:b]) for a, b in overlapping(len(word))}


def restored_words(text: str, model: CharacterModel) -> set[str]:
    """The words of a text in all their readings."""
    return {r for w in {*text.lower().split(), *spaced_words(text, model)} for r in readings(w, model)}


def features(word: str) -> list[str]:
    """A word and its beginnings; a beginning ends with a dash."""
    return [word, *(word[:n] + "-" for n in STARTS if len(word) >= n)]


def text_features(text: str, model: CharacterModel) -> set[str]:
    return {f for w in restored_words(text, model) for f in features(w)}


@dataclass
class Scorer:
    """Weights of the kept features; scoring adds those that occur."""

    characters: CharacterModel
    weights: dict[str, float]
    bias: float
    memory: dict[str, tuple] = field(default_factory=dict)

    def score(self, text: str) -> float:
        found: set[str] = set()
        memory, weights = self.memory, self.weights
        raw = set(text.lower().split())
        for word in raw:
            kept = memory.get(word)
            if kept is None:
                kept = tuple(
                    f for r in readings(word, self.characters) for f in features(r) if f in weights
                )
                if len(memory) >= MEMORY:
                    memory.clear()
                memory[word] = kept
            if kept:
                found.update(kept)
        for word in spaced_words(text, self.characters):
            found.update(f for f in text_features(word, self.characters) if f in weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(weights[f] for f in sorted(found))))))


def likelihood_ratio(k1: int, n1: int, k2: int, n2: int) -> float:
    """G-square of k of n documents in two classes."""

    def part(k: float, n: float, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)

    p = (k1 + k2) / (n1 + n2)
    return 2 * (part(k1, n1, k1 / n1) + part(k2, n2, k2 / n2) - part(k1, n1, p) - part(k2, n2, p))


def chosen_features(counts: list[tuple[str, int, int]], n0: int, n1: int) -> list[str]:
    """Of ``(feature, clean documents, toxic documents)`` those that go with the label."""
    ratios = {f: likelihood_ratio(toxic, n1, clean, n0) for f, clean, toxic in counts if toxic * n0 > clean * n1}
    return sorted((f for f, r in ratios.items() if r >= MIN_RATIO), key=lambda f: (-ratios[f], f))[:MAX_FEATURES]


def fit(found: list[list[str]], labels: list[int], kept: list[str], characters: CharacterModel) -> Scorer:
    """Logistic regression by adaptive gradient steps on the kept features."""
    n1 = sum(labels)
    n0 = len(labels) - n1
    if not n1 or not n0:
        return Scorer(characters, {}, -30.0)
    place = {f: i for i, f in enumerate(kept)}
    rows, columns = [], []
    for i, names in enumerate(found):
        here = [place[f] for f in names]
        rows += [i] * len(here)
        columns += here
    rows, columns, y = np.array(rows, np.int64), np.array(columns, np.int64), np.array(labels, float)
    weights, bias, l2 = np.zeros(len(kept)), math.log(n1 / n0), 1.0
    speed, bias_speed = np.full(len(kept), 1e-8), 1e-8  # sums of squared gradients
    for _ in range(400):
        z = bias + np.bincount(rows, weights[columns], len(y)) if len(rows) else np.full(len(y), bias)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gradient = np.bincount(columns, error[rows], len(kept)) + l2 * weights if len(rows) else np.zeros(len(kept))
        speed += gradient**2
        weights -= 0.5 * gradient / np.sqrt(speed)
        bias_speed += error.sum() ** 2
        bias -= 0.5 * error.sum() / math.sqrt(bias_speed)
    return Scorer(characters, dict(zip(kept, weights.tolist())), float(bias))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Scorer:
    """The character model from all training texts, the scorer from a bounded sample.

    ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic). Rows whose crc32 fold is
    HELD_OUT are not looked at. The sample's ids are at most ``train_rows``, so they are
    broadcast to the texts and no text is shuffled.
    """
    training = docs.where(fold("doc_id", FOLDS) != HELD_OUT).select("doc_id", "text")
    characters = CharacterModel.from_counts(count_triples(training))
    sample = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
        .where(fold("doc_id", FOLDS) != HELD_OUT).distinct()
        .orderBy(F.xxhash64("doc_id"), "toxic").limit(train_rows)
    )

    rows = training.join(F.broadcast(sample), "doc_id").select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter(), Counter()]
        for batch in smaller_batches(batches, 256):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(text_features(text or "", characters))
        names = sorted(counts[0].keys() | counts[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([c[f] for f in part], pa.int64()) for c in counts)],
                ["feature", "clean", "toxic"],
            )

    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return fit([], [], [], characters)
    counted = (
        rows.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") * n0 > F.col("clean") * n1))
    )
    kept = chosen_features([tuple(r) for r in counted.collect()], n0, n1)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = set(kept)
        for batch in smaller_batches(batches, 256):
            names = [sorted(wanted & text_features(t or "", characters)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.list_(pa.string()))], ["toxic", "names"])

    found = rows.mapInArrow(find, "toxic int, names array<string>").orderBy("toxic", "names").collect()
    return fit([r["names"] for r in found], [r["toxic"] for r in found], kept, characters)


def count_triples(docs: DataFrame) -> np.ndarray:
    """Character triples over all of ``docs``; a task sends at most SIZE ** 3 numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE**3, np.int64)
        for batch in smaller_batches(batches, 64):
            counts += triple_counts("\n".join(t for t in batch.column(0).to_pylist() if t))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["triple", "n"])

    summed = docs.select("text").mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE**3, np.int64)
    found = summed.toPandas()
    counts[found["triple"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def score_documents(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in smaller_batches(batches, 512):
            scores = [model.score(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string")
    ).mapInArrow(score, SCORES)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_documents(docs, train(docs, labels))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic, all columns.

    The verdict is taken on each row's own text, so a text is judged alike wherever it
    stands and no join is needed.
    """
    scorer = train(docs, table(spark, sf_dir, "labels"))
    shared = spark.sparkContext.broadcast(scorer)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in smaller_batches(batches, 512):
            clean = [model.score(t or "") < THRESHOLD for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
