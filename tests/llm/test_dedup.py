"""Exact copies, repeated strings and near copies against plain Python."""

import os

import brute
import numpy as np
import pytest
from conftest import SF_DIR, make, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexloom.llm import blocks, exact_dedup, jaccard, suffix_dedup
from indexloom.llm.components import components


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def digests(df, **more):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    rows = suffix_dedup.removed_spans(df, **more).select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("more", [{}, {"hot_anchor": 1, "array_bytes": 2000}])
def test_repeated_strings(spark, odd, more):
    assert digests(odd, **more) == brute.removed(pairs(odd))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert digests(docs, **more) == brute.removed(pairs(docs))


def test_spans_say_what_is_kept(odd):
    texts = dict(pairs(odd))
    for r in suffix_dedup.removed_spans(odd).collect():
        data, at, kept = brute.text_bytes(texts[r.doc_id]), 0, b""
        for s in r.spans:
            kept, at = kept + data[at : s.start], s.end
        assert kept + data[at:] == bytes(r.kept)


def different_segments(texts, width):
    """The runs of some texts one after the other, each different one once: bytes, sizes, windows, least owners."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, counts, _, document = suffix_dedup.window_runs(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), width)
    owners = {}
    for s, n, d in zip(starts.tolist(), counts.tolist(), document.tolist(), strict=True):
        piece = data[s : s + n + width - 1].tobytes()
        owners[piece] = min(d, owners.get(piece, d))
    sizes = np.array([len(p) for p in owners])
    return np.frombuffer(b"".join(owners), np.uint8), sizes, sizes - width + 1, np.array(list(owners.values()))


def windows(data, sizes, width):
    ends = np.cumsum(sizes)
    return [data[i : i + width].tobytes() for a, b in zip(ends - sizes, ends, strict=True) for i in range(a, b - width + 1)]


def test_only_windows_that_may_repeat_are_sorted(monkeypatch):
    """Texts that share strings shorter than a window give the suffix arrays nothing to do."""
    rng = np.random.default_rng(3)
    noise = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    phrase, passage = noise(40), noise(70)
    texts = [noise(60) + phrase + noise(60) for _ in range(50)]
    texts[7] += passage + noise(60)
    texts[31] += noise(30) + passage + noise(60)
    data, sizes, counts, owners = different_segments(texts, 50)
    asked = []
    sort = suffix_dedup.least_owners
    monkeypatch.setattr(suffix_dedup, "least_owners", lambda d, starts, counts, *more: asked.append(int(counts.sum())) or sort(d, starts, counts, *more))
    found = suffix_dedup._owners_by_anchor(data, sizes, counts, owners, 50, 1 << 20)
    least = {}
    for w, o in zip(windows(data, sizes, 50), np.repeat(owners, counts).tolist(), strict=True):
        least[w] = min(o, least.get(w, o))
    assert found.tolist() == [least[w] for w in windows(data, sizes, 50)]
    assert sum(asked) <= 2 * (70 - 49)


@pytest.mark.parametrize("width", [16, 23, 24, 50, 70])
@pytest.mark.parametrize("array_bytes", [1, 400, 1 << 20])
def test_least_owners_by_anchor(width, array_bytes):
    rng = np.random.default_rng(width)
    parts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (3, 30, 60, 90, 200)] + [b"ab" * 60, b"x" * 150]
    texts = [b"".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(1, 6))) for _ in range(30)]
    data, sizes, counts, owners = different_segments(texts, width)
    found = suffix_dedup._owners_by_anchor(data, sizes, counts, owners, width, array_bytes)
    least = {}
    for w, o in zip(windows(data, sizes, width), np.repeat(owners, counts).tolist(), strict=True):
        least[w] = min(o, least.get(w, o))
    assert found.tolist() == [least[w] for w in windows(data, sizes, width)]


@given(st.lists(st.integers(0, 3), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_suffix_array_and_common_prefixes(symbols):
    t = np.array(symbols, np.uint16)
    order, rank = suffix_dedup.suffix_array(t)
    assert order.tolist() == sorted(range(len(t)), key=lambda i: symbols[i:])
    shared = suffix_dedup.common_prefixes(t, order, rank, np.array([0]), np.array([len(t)]), 30)
    for a, b in zip(order, order[1:], strict=False):
        assert shared[b] == min(30, len(os.path.commonprefix([symbols[a:], symbols[b:]])))


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(1, 9)), max_size=60), st.integers(0, 4))
@settings(max_examples=60, deadline=None)
def test_quotient_filter_loses_nothing(items, bits):
    prints = {p >> bits for p, _ in items}
    values = np.array(sorted(prints), np.uint64)
    counts = np.arange(1, len(values) + 1)
    kept = exact_dedup.CountingQuotientFilter.unpack(exact_dedup.CountingQuotientFilter.of_sorted(values, counts, bits).pack())
    assert kept.fingerprints(0, bits).tolist() == values.tolist()
    assert kept.counts.tolist() == counts.tolist()
    if len(values):
        merged, sums = exact_dedup.merge_filters([kept, kept], 0, bits)
        assert merged.tolist() == values.tolist() and sums.tolist() == (2 * counts).tolist()


def test_exact_groups(odd):
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(odd).collect()}
    assert found == brute.exact_groups(pairs(odd))
    kept = exact_dedup.without_duplicates(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in found.values()}


def test_near_groups(spark, odd):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_documents(odd).collect()}
    assert found == brute.near_groups(pairs(odd))
    kept = jaccard.without_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {c for _, c in found.values()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_documents(docs).collect()} == brute.near_groups(pairs(docs))


def test_near_groups_of_many_edits(spark):
    """Copies of one text with more and more words changed: chains, near misses and links across size bands."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(words)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            w[at] = f"n{rng.integers(0, 40)}"
        rows.append((i, " ".join(w[: 120 - int(rng.integers(0, 30))]), "en", "s"))
    docs = make(spark, rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_documents(docs).collect()} == brute.near_groups([r[:2] for r in rows])


def test_pairs_that_share_many_signatures_are_taken_once(spark, monkeypatch):
    """Long texts that are a little too far from each other, and two that link."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(2400)]
    rows = []
    for i in range(30):
        w = list(words)
        for part in range(12):
            at = 200 * part + int(rng.integers(0, 170))
            w[at : at + 30] = [f"n{i}x{part}x{j}" for j in range(30)]
        rows.append((i, w))
    rows[12] = (12, rows[11][1][:2300] + ["end"])
    docs = make(spark, [(i, " ".join(w), "en", "s") for i, w in rows])
    asked, real = [], jaccard._candidates

    def candidates(left, right, which, percent):
        asked.append((left, right, which))
        return real(left, right, which, percent)

    monkeypatch.setattr(jaccard, "_candidates", candidates)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_documents(docs).collect()}
    assert found == brute.near_groups([(i, " ".join(w)) for i, w in rows]) and found[12][1] == 11
    left, right, which = asked[-1]
    assert left.count() > 100 * len(rows)
    assert left.alias("a").join(right.alias("b"), F.col("a.signature") == F.col("b.signature")).where(which).count() <= len(rows)


def test_pairs_are_taken_at_the_first_signature_that_they_share(spark):
    rng = np.random.default_rng(6)
    lists = [np.sort(rng.choice(400, int(rng.integers(1, 120)), replace=False)).tolist() for _ in range(40)]
    rows = [(t, i, 0, 0, 9, i, own[max(0, at - jaccard.EARLIER) : at], [0] * jaccard.SKETCH_WORDS, None) for i, own in enumerate(lists) for at, t in enumerate(own)]
    made = spark.createDataFrame(rows, "signature long, id long, after long, needed long, n long, component long, earlier array<long>, sketch array<long>, wide array<long>")
    which = (F.col("a.id") > F.col("b.id")) & jaccard._first_met_and_near(75)
    found = [tuple(r) for r in jaccard._candidates(made, made, which, 75).collect()]
    meet = {(i, j) for i in range(40) for j in range(i) if set(lists[i]) & set(lists[j])}
    assert sorted(found) == sorted(meet)
    met = made.alias("a").join(made.alias("b"), F.col("a.signature") == F.col("b.signature"))
    assert met.where(which).count() < met.where("a.id > b.id").count() / 2


@pytest.mark.parametrize("percent", [75, 60, 90])
def test_signatures_miss_no_link(percent):
    rng = np.random.default_rng(percent)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a = np.unique(rng.integers(0, 2**40, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**40, rng.integers(0, 5)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b) == both:
            continue
        seen = np.intersect1d(a, b)
        one, two = (jaccard.signatures(s, np.isin(s, seen).astype(np.uint8), percent)[0] for s in (a, b))
        assert len(np.intersect1d(one, two))
        differ = np.unpackbits((jaccard.parity_sketch(a) ^ jaccard.parity_sketch(b)).view(np.uint8)).sum()
        assert differ <= len(a) + len(b) - 2 * both


def test_repeated_rows_and_missing_ids(repeated):
    rows = exact_dedup.exact_duplicates(repeated).collect()
    assert len(rows) == repeated.count()
    assert {r.group_size for r in rows if r.doc_id == 13} == {2}
    assert len(suffix_dedup.removed_spans(repeated).collect()) == len(rows)
    assert len(jaccard.linked_documents(repeated).collect()) == len(rows)


def test_one_row_of_each_group_stays(spark):
    """Null and repeated ids: every text stays, and of each group one row."""
    texts = [" ".join(f"{w}{i}" for i in range(40)) for w in "abcdef"]
    rows = [
        (None, texts[0]), (1, texts[0] + " "), (None, texts[1]), (None, texts[2]), (None, texts[2]),
        (7, texts[3]), (7, texts[0]), (8, texts[4]), (8, texts[4]), (9, texts[5]), (None, None), (None, None),
    ]
    docs = make(spark, [(*r, "en", "s") for r in rows])
    found = exact_dedup.without_duplicates(docs)
    assert found.columns == docs.columns
    assert sorted(pairs(found), key=str) == sorted([(1, texts[0] + " "), (None, texts[1]), (None, texts[2]), (7, texts[3]), (8, texts[4]), (9, texts[5]), (None, None)], key=str)
    rows = [(*r, "en", "s") for r in rows[:10]] + [(9, texts[1] + " more", "en", "s"), (3, texts[5] + " more", "en", "s")]
    found = jaccard.without_near_duplicates(make(spark, rows))
    assert found.columns == docs.columns
    assert sorted(pairs(found), key=str) == sorted([(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (8, texts[4]), (3, texts[5] + " more")], key=str)
    once, twice = (sorted(map(str, pairs(exact_dedup.without_duplicates(make(spark, odd_rows() * n))))) for n in (1, 2))
    assert once == twice


def test_no_rows(nothing):
    for df in (exact_dedup.exact_duplicates, suffix_dedup.removed_spans, jaccard.linked_documents, exact_dedup.without_duplicates, jaccard.without_near_duplicates):
        assert df(nothing).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (3, 3), (None, 9), (7, 8), (8, 7), *((100 + i, 101 + i) for i in range(40)), *((300, 301 + i) for i in range(20))]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in found.items() if k < 100} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 8: 7}
    assert {v for k, v in found.items() if 100 <= k <= 140} == {100} and {v for k, v in found.items() if k >= 300} == {300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_span_hashes_tell_spans_apart():
    data = np.frombuffer(b"abcabcab", np.uint8)
    h = blocks.span_hashes(data, np.array([0, 3, 6]), np.array([3, 6, 8]))
    assert h[0] == h[1] != h[2]


def test_odd_rows_are_what_they_seem():
    assert odd_rows()[0][1] is None and len(odd_rows()[15][1]) > 100_000
