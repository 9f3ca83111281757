"""Language identification by a byte convolutional network in numpy.

Bytes are embedded, filters of several widths slide over them, each filter keeps its largest
response in a window (max pooling), and a softmax layer turns these into languages. A text is
cut into windows of a fixed number of bytes that cover all of it; its prediction is the mean
of its windows' probabilities, weighted by their letters' bytes, so one foreign passage does
not decide. The network is trained on a bounded sample of labelled texts (``PER_LANGUAGE``
rows of each language, by hash order, ``WINDOWS_PER_TEXT`` windows of each).

For prediction, embedding and filters are folded into one table per byte position of a
filter, which gives the same sums. All windows of a batch go through at once.

Defined results. ``und`` with score 0 for a null text, a text without letters, and every text
when no language could be learned. With one learned language that language has score 1. Rows
are independent; empty tables give no rows. Ties go to the language that sorts first. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import fold, smaller_batches, table

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 1500
SAMPLE_PARTS = 4  # Spark limits a group before the shuffle up to 1,000 rows
WINDOWS_PER_TEXT = 6
EPOCHS = 6
BATCH = 64
FOLDS, HELD_OUT = 4, 2
MIN_SCORE = 0.3  # a text whose best language has less is rejected by the pipeline
SLICE = 1024  # windows at a time
LETTERS = r"\p{L}"
GUESSES = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Network:
    """Weights: ``embedding`` (256, E), ``filters[w]`` (w, E, F), ``output`` (F * widths, languages)."""

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    offsets: dict[int, np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    def tables(self) -> dict[int, list[tuple[int, np.ndarray]]]:
        """For each width, what two bytes (or the odd last one) add at each place of a filter."""
        out = {}
        for w, f in self.filters.items():
            parts = [self.embedding @ f[i] for i in range(w)]
            out[w] = [
                (i, (parts[i][:, None, :] + parts[i + 1][None, :, :]).reshape(65536, -1))
                for i in range(0, w - 1, 2)
            ]
            if w % 2:
                out[w].append((w - 1, parts[w - 1]))
        return out

    def pooled(self, windows: np.ndarray, tables: dict) -> np.ndarray:
        """Largest response of every filter in every window (rows of bytes)."""
        out, pairs = [], windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        for w, parts in tables.items():
            n = windows.shape[1] - w + 1
            total = None
            for i, part in parts:
                found = part[(pairs if len(part) > 256 else windows)[:, i : i + n]]
                total = found if total is None else np.add(total, found, out=total)
            out.append(total.max(1) + self.offsets[w])
        return np.maximum(np.concatenate(out, 1), 0)

    def probabilities(self, windows: np.ndarray, tables: dict) -> np.ndarray:
        z = self.pooled(windows, tables) @ self.output + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """The bytes in rows of WINDOW; the last row starts earlier so that it is full, too.

    A text shorter than a window is repeated with a space between, which adds no new letters
    and no foreign neighbours.
    """
    raw = np.frombuffer(text, np.uint8)
    if len(raw) < WINDOW:
        raw = np.resize(np.append(raw, np.uint8(32)), WINDOW)
    whole = len(raw) // WINDOW
    rows = raw[: whole * WINDOW].reshape(whole, WINDOW)
    return np.concatenate([rows, raw[None, -WINDOW:]]) if len(raw) % WINDOW else rows


LETTER_BYTE = np.zeros(256, bool)
LETTER_BYTE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def guesses(texts: list[bytes], network: Network, tables: dict) -> list[tuple[str, float]]:
    """Best language and its mean probability for each text; texts without bytes are ``und``."""
    out, rows, owners = [("und", 0.0)] * len(texts), [], []
    if not network.languages:
        return out
    sums = np.zeros((len(texts), len(network.languages)))
    weights = np.zeros(len(texts))

    def flush() -> None:
        windows, owner = np.concatenate(rows), np.concatenate(owners)
        for at in range(0, len(windows), SLICE):
            part, whose = windows[at : at + SLICE], owner[at : at + SLICE]
            weight = LETTER_BYTE[part].sum(1) + 1e-3
            np.add.at(sums, whose, network.probabilities(part, tables) * weight[:, None])
            np.add.at(weights, whose, weight)
        rows.clear()
        owners.clear()

    held = 0
    for i, text in enumerate(texts):
        if text:
            for start in range(0, len(text), SLICE * WINDOW):  # a very long text in slices
                cut = windows_of(text[start : start + SLICE * WINDOW])
                rows.append(cut)
                owners.append(np.full(len(cut), i))
                held += len(cut)
                if held >= SLICE:
                    flush()
                    held = 0
    if rows:
        flush()
    for i in np.flatnonzero(weights):
        best = int(sums[i].argmax())
        out[i] = (network.languages[best], float(min(1.0, sums[i, best] / weights[i])))
    return out


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Training by Adam on shuffled batches; the classes weigh the same."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING)), "o": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), k)), "b": np.zeros(k)}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS))
        p[f"c{w}"] = np.zeros(FILTERS)
    first, second, t = {n: np.zeros_like(v) for n, v in p.items()}, {n: np.zeros_like(v) for n, v in p.items()}, 0
    share = np.bincount(labels, minlength=k) * k / max(1, len(labels))
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            x, y = windows[pick], labels[pick]
            grads, t = gradients(p, x, y, 1 / share[y]), t + 1
            for n, g in grads.items():
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                p[n] = p[n] - 0.01 * (first[n] / (1 - 0.9**t)) / (np.sqrt(second[n] / (1 - 0.999**t)) + 1e-8)
    single = {n: v.astype(np.float32) for n, v in p.items()}
    return Network(
        languages, single["e"], {w: single[f"f{w}"] for w in WIDTHS}, {w: single[f"c{w}"] for w in WIDTHS},
        single["o"], single["b"],
    )


def gradients(p: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Of the weighted cross-entropy. Only the window positions that won the pooling count."""
    n = len(x)
    pooled, winners = [], []
    for w in WIDTHS:
        m = x.shape[1] - w + 1
        total = sum((p["e"] @ p[f"f{w}"][i])[x[:, i : i + m]] for i in range(w)) + p[f"c{w}"]
        at = total.argmax(1)
        winners.append(at)
        pooled.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0])
    raw = np.concatenate(pooled, 1)
    hidden = np.maximum(raw, 0)
    z = hidden @ p["o"] + p["b"]
    z = np.exp(z - z.max(1, keepdims=True))
    error = z / z.sum(1, keepdims=True)
    error[np.arange(n), y] -= 1
    error *= weight[:, None] / n
    grads = {"o": hidden.T @ error, "b": error.sum(0), "e": np.zeros_like(p["e"])}
    back = (error @ p["o"].T) * (raw > 0)
    for j, w in enumerate(WIDTHS):
        own = back[:, j * FILTERS : (j + 1) * FILTERS]
        grads[f"c{w}"] = own.sum(0)
        grads[f"f{w}"] = np.zeros_like(p[f"f{w}"])
        for i in range(w):
            found = x[np.arange(n)[:, None], winners[j] + i]  # the byte each filter saw there
            grads[f"f{w}"][i] = np.einsum("nfe,nf->ef", p["e"][found], own)
            np.add.at(grads["e"], found, own[:, :, None] * p[f"f{w}"][i].T[None])
    return grads


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network:
    """From text and non-null language of the rows whose crc32 fold is not HELD_OUT.

    The sample's ids are at most ``per_language`` a language, an equal number from each of
    SAMPLE_PARTS parts by hash: so few that each task keeps only its first ones before the
    shuffle. They are broadcast to the texts; no text is shuffled.
    """
    rows = docs.where(fold("doc_id", FOLDS) != HELD_OUT).where("lang is not null and text is not null")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_PARTS)).alias("part")
    by_hash = Window.partitionBy("lang", "part").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        rows.select("doc_id", "lang", part).withColumn("turn", F.row_number().over(by_hash))
        .where(F.col("turn") <= max(1, per_language // SAMPLE_PARTS)).select("doc_id", "lang").distinct()
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, 64):
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if any(map(str.isalpha, text)):
                    found = windows_of(text.encode())
                    even = np.linspace(0, len(found) - 1, min(len(found), WINDOWS_PER_TEXT)).astype(int)
                    out += [(lang, row.tobytes()) for row in found[even]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["lang", "window"])

    sample = (
        rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
        .select("lang", "text").mapInArrow(cut, "lang string, window binary").toPandas()
        .sort_values(["lang", "window"])
    )
    languages = sorted(sample["lang"].unique())
    if not languages:
        return Network([], np.zeros(0), {}, {}, np.zeros(0), np.zeros(0))
    place = {x: i for i, x in enumerate(languages)}
    windows = np.frombuffer(b"".join(sample["window"]), np.uint8).reshape(-1, WINDOW)
    return fit(windows, sample["lang"].map(place).to_numpy(), languages)


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """One row per document; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        for batch in smaller_batches(batches, 256):
            found = guesses(batch.column(2).to_pylist(), shared.value, tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), lettered("text")
    ).mapInArrow(guess, GUESSES)


def lettered(column: str):
    """The text as bytes; empty if it is null or has no letter."""
    return F.when(F.col(column).rlike(LETTERS), F.col(column)).otherwise("").cast("binary").alias(column)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is found with at least MIN_SCORE, all columns."""
    shared = spark.sparkContext.broadcast(train(docs))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        for batch in smaller_batches(batches, 256):
            texts = [
                t.encode() if t and any(map(str.isalpha, t)) else b"" for t in batch.column(at).to_pylist()
            ]
            found = guesses(texts, shared.value, tables)
            kept = [lang != "und" and score >= MIN_SCORE for lang, score in found]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
