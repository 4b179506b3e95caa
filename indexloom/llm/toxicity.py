"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks, ngrams
from indexloom.session import stage

ORDERS, BITS = (3, 4, 5), 18
# Bounds of what the classifier is fitted on: labelled rows of each class, and n-grams it weighs.
SAMPLE_ROWS, WEIGHED = 6000, 3000
THRESHOLD = 0.3
_STEPS, _RIDGE = 300, 1e-3


@dataclass(frozen=True)
class ToxicityModel:
    """`place` has the number of each weighed n-gram (else -1), `weights` what it adds if it occurs."""

    place: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows, found = _weighed(texts, self.place)
        return 1 / (1 + np.exp(-np.clip(np.bincount(rows, self.weights[found], len(texts)) + self.bias, -500, 500)))


def _weighed(texts: list[str | None], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which weighed n-grams occur in which text, each once."""
    keys = [np.zeros(0, np.int64)]
    for text, points, starts, ends in ngrams.segments(texts, max(ORDERS)):
        found = []
        for order in ORDERS:
            number = place[ngrams.features(points, order, BITS)]
            at = np.flatnonzero(number >= 0)
            row = np.searchsorted(starts, at, "right") - 1
            inside = at < ends[row] if len(at) else np.zeros(0, bool)
            found.append(text[row[inside]] * np.int64(1 << BITS) + number[at[inside]])
        keys.append(np.unique(np.concatenate(found)))
    return np.divmod(np.unique(np.concatenate(keys)), 1 << BITS)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """What to learn from: text, toxic (0 or 1), stands_for.

    At most `rows` labelled ids of each class, those with the least hash; `stands_for` says how many
    ids of its class each of them is drawn from. Rows held out, without a label or without an id are
    left out; an id labelled twice counts as toxic if it is so once.
    """
    given = stage(
        labels.where(~ngrams.held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    chosen = [
        given.where(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(rows)
        .withColumn("stands_for", F.lit(max(1.0, given.where(F.col("toxic") == toxic).count() / rows)))
        for toxic in (1, 0)
    ]
    # At most 2 * rows ids and labels, so safe to broadcast.
    return stage(docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("text", "toxic", "stands_for"))


def fit(learn: DataFrame, weighed: int = WEIGHED) -> ToxicityModel:
    """Learns from a `sample`, of bounded size.

    Tasks count in how many texts of each class every hashed n-gram occurs. The log ratio of the two
    smoothed shares is the n-gram's scale; the `weighed` n-grams that tell the classes apart best are
    kept, and a ridge-penalised logistic regression weighs the scaled presence of each. Where the two
    classes are drawn at different rates, the bias is put back to the odds among all labelled rows, so
    a score means the same whatever the size of the input. With rows of one class or none there is
    nothing to learn, and every score is the share of toxic rows (0 if none).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch, texts in ngrams.text_lists(batches):
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for i, table in ngrams.presence(texts, ORDERS, BITS):
                of_group = toxic[i : i + len(table)]
                counts[1] += table[of_group].sum(axis=0)
                counts[0] += table[~of_group].sum(axis=0)
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])], names=["feature", "clean", "toxic"])

    learn = blocks.for_tasks(learn)
    classes = learn.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.max("stands_for").alias("stands_for")).collect()
    sizes = {r["toxic"]: r["n"] for r in classes}
    empty = ToxicityModel(np.full(1 << BITS, -1, np.int32), np.zeros(0), 0.0)
    if len(sizes) < 2:
        return ToxicityModel(empty.place, empty.weights, 500.0 if sizes.get(1) else -500.0)
    # One row per hashed n-gram: 2 ** BITS at most, however much was read.
    counted = learn.mapInArrow(count, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    share = {c: (counted[c].to_numpy(float) + 1) / (sizes[v] + 2) for c, v in (("clean", 0), ("toxic", 1))}
    ratio = np.log(share["toxic"] / share["clean"])
    spread = np.abs(share["toxic"] - share["clean"]) / np.sqrt(share["toxic"] * (1 - share["toxic"]) / sizes[1] + share["clean"] * (1 - share["clean"]) / sizes[0])
    best = np.argsort(-spread, kind="stable")[:weighed]
    place = empty.place.copy()
    place[counted["feature"].to_numpy()[best]] = np.arange(len(best))
    scale = ratio[best]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ngrams.text_lists(batches):
            rows, found = _weighed(texts, place)
            cuts = np.searchsorted(rows, np.arange(len(texts) + 1)).tolist()
            held = [found[a:b].astype(np.uint16).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), batch.column("toxic")], names=["found", "toxic"])

    # Bounded by the sample's rows times the weighed n-grams, two bytes each.
    rows = learn.mapInArrow(look_up, "found binary, toxic int").orderBy("toxic", "found").collect()
    found = [np.frombuffer(r["found"], np.uint16) for r in rows]
    owner, flat = np.repeat(np.arange(len(rows)), [len(f) for f in found]), np.concatenate(found).astype(np.int64)
    target = np.array([r["toxic"] for r in rows], float)
    weights, bias = _logistic(owner, flat, scale, target)
    stands_for = {r["toxic"]: r["stands_for"] for r in classes}
    return ToxicityModel(place, weights * scale, bias + float(np.log(stands_for[1] / stands_for[0])))


def _logistic(owner: np.ndarray, flat: np.ndarray, scale: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression on presence times scale, by accelerated gradient steps."""
    n, values = len(target), scale[flat]
    # A bound on the curvature: a quarter of the largest squared length of a row.
    step = 4 / (np.bincount(owner, values**2, n).max() + 1 + 4 * _RIDGE)
    x = y = np.zeros(len(scale) + 1)
    for t in range(1, _STEPS + 1):
        margin = np.bincount(owner, y[flat] * values, n) + y[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - target) / n
        slope = np.append(np.bincount(flat, error[owner] * values, len(scale)) + _RIDGE / n * y[:-1], error.sum())
        following = y - step * n * slope / max(1.0, n / 50)
        y = following + (t - 1) / (t + 2) * (following - x)
        x = following
    return x[:-1], float(x[-1])


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Scores each whole text: doc_id, score (0 to 1), predicted (1 from `threshold` on).

    A null or empty text has no n-gram and gets the score of the model's bias. Rows are judged by their
    text alone, repeated ones alike; a null doc_id is kept, no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ngrams.text_lists(batches):
            scores = model.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return blocks.for_tasks(docs).select("doc_id", "text").mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fits on a bounded sample of the labelled rows and scores all: doc_id, held_out, score, predicted.

    Ids decide only which rows may be learnt from; a score depends on the text.
    """
    return score(docs, fit(sample(docs, labels, rows))).select("doc_id", ngrams.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, with all their columns, in one pass."""
    model = fit(sample(docs, labels, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ngrams.text_lists(batches):
            yield batch.filter(pa.array(model.scores(texts) < threshold))

    return blocks.for_tasks(docs).mapInArrow(run, docs.schema)
