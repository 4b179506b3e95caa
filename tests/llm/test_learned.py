"""Classifiers by accuracy on held-out rows, neighbours by recall."""

import zlib

import numpy as np
import pytest
from conftest import SF_DIR, make

from indexloom.llm import language, neighbours, ngrams, toxicity

BIG = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    toxic, clean = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    assert all((r.score >= 0.3) == r.predicted and 0 <= r.score <= 1 for r in rows)
    assert np.mean(np.array(clean) >= 0.3) < 0.02 and np.mean(np.array(toxic) >= 0.3) > 0.7


def test_toxic_scores_keep_the_odds_of_all_labels(spark):
    """Where the limits bind, the classes are drawn 1 to 1; the labels are 1 to 9, and half of the toxic texts are like the clean ones."""
    docs = make(spark, [(i, f"plain words of number {i % 7}" + " grrrr" * (i % 20 == 0), None, None) for i in range(2000)])
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(2000)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels, rows=100).collect()}
    assert all(r.predicted == (i % 20 == 0) and (i % 20 == 0 or 0.02 < r.score < 0.12) for i, r in found.items())
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels, rows=200).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = (np.mean([r.predicted for r in rows if r.toxic == t]) for t in (1, 0))
    assert clean < 0.1 and toxic > 0.7


def test_toxicity_of_odd_rows(spark, odd, nothing, repeated):
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    for docs in (odd, repeated):
        found = toxicity.toxicity(docs, labels).collect()
        assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    kept = toxicity.without_toxic(odd, labels)
    assert kept.columns == odd.columns
    assert toxicity.toxicity(nothing, labels).count() == 0
    unlabelled = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert {(r.score < 1e-9, r.predicted) for r in unlabelled} == {(True, 0)}


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    right = np.array([r.lang == r.lang_pred for r in rows])
    assert right.mean() > 0.97
    assert abs(np.mean([r.score for r in rows]) - right.mean()) < 0.03


def test_long_texts_are_scored_in_segments(odd, monkeypatch):
    """The segments of a text give what the text gives as a whole."""
    rng = np.random.default_rng(1)
    texts = [r.text for r in odd.collect()]
    model = language.LanguageModel(("a", "b", "c"), rng.standard_normal((1 << 16, 3)), 1 + rng.random(1 << 16), np.zeros(3), 1.0)
    place = np.where(np.arange(1 << 18) % 5, -1, np.arange(1 << 18) // 5).astype(np.int32)
    found = []
    for size in (1 << 16, 100, 7):
        monkeypatch.setattr(ngrams, "SEGMENT", size)
        flags = np.concatenate([t for _, t in ngrams.presence(texts[:10], (1, 2, 3), 12)])
        found.append((model.probabilities(texts), toxicity._weighed(texts, place), flags))
    for likely, (rows, numbers), flags in found[1:]:
        assert np.allclose(likely, found[0][0]) and (flags == found[0][2]).all()
        assert rows.tolist() == found[0][1][0].tolist() and numbers.tolist() == found[0][1][1].tolist()


def test_language_of_odd_rows(odd, nothing, repeated):
    found = {r.doc_id: r for r in language.languages(odd).collect()}
    assert len(found) == odd.count()
    for i in (0, 1, 2, 18):
        assert found[i].lang_pred == "und"
    assert {r.lang_pred for r in found.values()} <= {"en", "de", "und"}
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language.languages(repeated).count() == repeated.count()
    assert language.languages(nothing).count() == 0


def test_language_without_anything_to_learn(spark):
    docs = make(spark, [(1, "some words", None, None), (2, None, "en", None)])
    assert {(r.doc_id, r.lang_pred) for r in language.languages(docs).collect()} == {(1, "und"), (2, "und")}


def exact_neighbours(rows, k=5):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for q, v in good.items():
        if q % 50 == 0:
            near = sorted((-float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), i) for i, w in good.items() if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


@pytest.mark.parametrize("sf_dir", [SF_DIR, BIG])
def test_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    exact = exact_neighbours([(r.vec_id, r.embedding) for r in table.collect()]) if sf_dir == SF_DIR else None
    found = {}
    for r in neighbours.nearest(table, table.vec_id % 50 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    if exact is None:
        ids, vectors = zip(*((r.vec_id, r.embedding) for r in table.collect()), strict=True)
        ids, unit = np.array(ids), np.array(vectors, float)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        asks = np.flatnonzero(ids % 50 == 0)
        scores = unit[asks] @ unit.T
        scores[np.arange(len(asks)), asks] = -9
        exact = {int(ids[q]): [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s))[:5]] for q, s in zip(asks, scores, strict=True)}
    assert set(found) == set(exact)
    hits = 0
    for q, near in exact.items():
        got = sorted(found[q])
        assert [r for r, _, _ in got] == list(range(1, len(near) + 1))
        assert [s for _, _, s in got] == sorted((s for _, _, s in got), reverse=True)
        hits += len({i for i, _ in near} & {i for _, i, _ in got})
    assert hits >= 0.9 * sum(map(len, exact.values()))


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    same = rng.standard_normal(8).tolist()
    rows += [(i, same) for i in range(100, 130)] + [(200, [0.0] * 8), (250, [1.0, None] * 4), (300, None), (350, [float("nan")] * 8), (None, same), (400, [1.0, 2.0]), (401, [2.0, 1.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cell int")
    found = {}
    for r in neighbours.nearest(table, table.vec_id % 50 == 0).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == {0, 50, 100, 400}
    assert found[100] == [101, 102, 103, 104, 105] and found[400] == [401] and len(found[0]) == 5
    assert neighbours.nearest(table.limit(0), table.vec_id % 50 == 0).count() == 0
