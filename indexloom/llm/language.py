"""Language of a text: sparse multinomial regression on TF-IDF character n-grams, calibrated."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks, ngrams
from indexloom.session import stage

ORDERS, BITS = (1, 2, 3), 16
# Rows of a language that are learnt from, about; and the least share of a text's n-grams.
SAMPLE_ROWS = 1500
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_EPOCHS, _ALPHA, _BETA, _L1, _L2, _CALIBRATION = 3, 2.0, 1.0, 0.02, 0.1, 10


@dataclass(frozen=True)
class LanguageModel:
    """Weights per hashed n-gram and language, its idf, a bias per language, and the temperature."""

    languages: tuple[str, ...]
    weights: np.ndarray
    idf: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        sums = np.zeros((len(texts), len(self.languages) + 1))
        table = np.hstack([self.weights * self.idf[:, None], self.idf[:, None]])
        for row, points, starts, ends in ngrams.segments(texts, max(ORDERS)):
            # Sums over each segment; the padding between two is summed apart and left out.
            cuts = np.stack([starts, ends], 1).ravel()
            for order in ORDERS:
                taken = table[ngrams.features(points, order, BITS)]
                np.add.at(sums, row, np.add.reduceat(taken, np.minimum(cuts, len(taken) - 1), axis=0)[::2])
        margins = (sums[:, :-1] / np.maximum(sums[:, -1:], 1e-12) * _SCALE + self.bias) / self.temperature
        margins = np.exp(margins - margins.max(axis=1, keepdims=True))
        return margins / margins.sum(axis=1, keepdims=True)


# Shares of a text's weight are small numbers; this makes them of the size that steps and penalties expect.
_SCALE = 100.0


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.where(~ngrams.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")


def inverse_frequencies(learnable: DataFrame) -> np.ndarray:
    """Smoothed idf of every hashed n-gram over all texts that may be learnt from."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(1 << BITS, np.int64), 0
        for _, texts in ngrams.text_lists(batches):
            n += len(texts)
            for _, table in ngrams.presence(texts, ORDERS, BITS):
                counts += table.sum(axis=0)
        seen = np.append(np.flatnonzero(counts), -1)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(np.append(counts[seen[:-1]], n))], names=["feature", "n"])

    # One row per hashed n-gram and one with the number of texts.
    counted = blocks.for_tasks(learnable).select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(1 << BITS)
    total = 0
    for r in counted:
        if r["feature"] < 0:
            total = r["n"]
        else:
            held[r["feature"]] = r["n"]
    return np.log((1 + total) / (1 + held)) + 1


def sample(learnable: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About `rows` texts of each language (all, if fewer), chosen by hash of id and text."""
    sizes = learnable.groupBy("lang").count().withColumn("share", F.lit(rows) / F.col("count")).select("lang", "share")
    chosen = (F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))) < F.col("share")
    return stage(learnable.join(stage(sizes), "lang").where(chosen).select("doc_id", "text", "lang"))


def fit(learnable: DataFrame, rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Learns from `text` and `lang`; None if there is no row.

    The idf counts all rows. The regression sees a sample of bounded size, row by row, by the
    follow-the-regularised-leader rule with absolute and squared penalties, so most weights are zero.
    Every tenth sampled row is kept apart and sets the temperature that makes probabilities honest.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ngrams.text_lists(batches):
            found, times = [], []
            for text in texts:
                held = np.zeros(1 << BITS, np.int64)
                for _, points, starts, ends in ngrams.segments([text], max(ORDERS)):
                    inside = blocks.ragged(starts, ends - starts)
                    for order in ORDERS:
                        held += np.bincount(ngrams.features(points, order, BITS)[inside], minlength=1 << BITS)
                f = np.flatnonzero(held)
                found.append(f.astype(np.uint16).tobytes())
                times.append(blocks.packed(held[f].astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(times, pa.binary()), batch.column("lang")], names=["found", "times", "lang"])

    learn = sample(learnable, rows)
    idf = inverse_frequencies(learnable)
    # Bounded by the sampled rows times the hashed n-grams.
    told = blocks.for_tasks(learn).repartition("doc_id").sortWithinPartitions("doc_id").select("text", "lang").mapInArrow(counts, "found binary, times binary, lang string").collect()
    if not told:
        return None
    languages = tuple(sorted({r["lang"] for r in told}))
    rows_seen = []
    for r in sorted(told, key=lambda r: (bytes(r["found"]), bytes(r["times"]), r["lang"])):
        found = np.frombuffer(r["found"], np.uint16).astype(np.int64)
        held = blocks.unpacked(bytes(r["times"]), np.uint32) * idf[found]
        rows_seen.append((found, held / max(held.sum(), 1e-12) * _SCALE, languages.index(r["lang"])))
    order = np.random.default_rng(0).permutation(len(rows_seen))
    apart = [rows_seen[i] for i in order[::_CALIBRATION]] if len(rows_seen) >= 10 * _CALIBRATION else []
    train = [rows_seen[i] for j, i in enumerate(order) if not apart or j % _CALIBRATION]
    weights, bias = _ftrl(train, len(languages))
    margins = np.array([x @ weights[found] + bias for found, x, _ in apart or train])
    return LanguageModel(languages, weights, idf, bias, _temperature(margins, np.array([y for _, _, y in apart or train])))


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(train: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal: each weight follows from the sums of its gradients and their squares."""
    size = (1 << BITS) + 1
    sums, squares = np.zeros((size, n_languages)), np.zeros((size, n_languages))

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= _L1, 0.0, (np.sign(z) * _L1 - z) / ((_BETA + np.sqrt(n)) / _ALPHA + _L2))

    for _ in range(_EPOCHS):
        for found, x, y in train:
            at, values = np.append(found, size - 1), np.append(x, 1.0)
            z, n = sums[at], squares[at]
            w = solved(z, n)
            error = _softmax(values @ w)
            error[y] -= 1
            g = values[:, None] * error
            sums[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / _ALPHA * w
            squares[at] = n + g * g
    weights = solved(sums, squares)
    return weights[:-1], weights[-1]


def _temperature(margins: np.ndarray, truth: np.ndarray) -> float:
    """The temperature under which the kept-apart rows are likeliest, by golden-section search."""

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(margins / np.exp(t))[np.arange(len(truth)), truth], 1e-12)).mean()

    low, high, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def languages(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Predicts the language of every whole text: doc_id, held_out, lang_pred, score (0 to 1).

    A null text and one without a letter are `und`, with score 1; where nothing could be learnt, so is
    all else, with score 0. Rows are judged by their text alone, repeated ones alike; a null doc_id is
    kept (and may be learnt from), no rows give no rows, other columns are not looked at.
    """
    model = fit(_learnable(docs), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ngrams.text_lists(batches):
            lettered = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
            if model is None:
                best, scores = np.full(len(texts), UNDETERMINED, object), np.where(lettered, 0.0, 1.0)
            else:
                likely = model.probabilities(texts)
                best = np.where(lettered, np.array(model.languages, object)[likely.argmax(axis=1)], UNDETERMINED)
                scores = np.where(lettered, likely.max(axis=1), 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    predicted = blocks.for_tasks(docs).select("doc_id", "text").mapInArrow(run, schema)
    return predicted.select("doc_id", ngrams.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
