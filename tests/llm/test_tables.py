"""Queries against their SQL, mixing and URL rules on odd rows, and the whole pipeline."""

from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from conftest import SF_DIR, make
from pyspark.sql import functions as F

import corpus_pipeline
from indexloom.llm import mixing, queries, toxicity, url_filter

QUERIES, SQL = queries.registered(), queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], SF_DIR) == []


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


def test_mixing_of_odd_rows(spark, con, odd, repeated, nothing):
    con.register("odd_documents", odd.toPandas())
    assert differences(spark, con, lambda s, d: mixing.mix(odd), mixing.SQL.replace("FROM documents", "FROM odd_documents"), SF_DIR) == []
    taken, target = defaultdict(int), {}
    for r in mixing.mix(repeated).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_mixed_documents_repeat_rows(odd):
    repeats = {r.doc_id: r.repeats for r in mixing.mix(odd).collect()}
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    found = defaultdict(int)
    for r in mixed.collect():
        found[r.doc_id] += 1
    assert found == {d: n for d, n in repeats.items() if n}


def test_mixed_documents_without_ids_reach_the_target(spark):
    """Two thirds of a source have no id; the target runs out among them."""
    rows = [(i if i < 30 else None, f"text {i} of six or seven words", None, "a") for i in range(90)]
    docs = make(spark, rows + [(1000 + i, f"text {i} of six or seven words", None, "b") for i in range(120)])
    target = {r.source: r.target for r in mixing.mix(docs).collect()}
    taken = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        taken[r.source] += 7
    assert target["a"] > 7 * 90 and all(abs(taken[s] - target[s]) <= 3.5 for s in target)


def test_a_smaller_budget_takes_a_subset(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    few, many = ({r.doc_id: r.repeats for r in mixing.mix(docs, (w, 8)).collect()} for w in (1, 8))
    source = {r.doc_id: r.source for r in docs.collect()}
    grown = {s for s in set(source.values()) if sum(few[d] for d in few if source[d] == s) <= sum(many[d] for d in many if source[d] == s)}
    assert all(few[d] <= many[d] for d in few if source[d] in grown)


PAGES = [
    (1, "http://a.net/x", None), (2, "HTTP://Sub.EXAMPLE.org/es/1", ""), (3, "http://example.org/en/12?q#f", "no links"),
    (4, "http://b.com/fr/z", None), (5, "http://b.com/de/z", '<link rel="canonical" href="/alias">'), (6, "http://b.com/alias", "x"),
    (7, "http://c.net/1", '<META http-equiv=refresh content="0; URL=http://b.com/de/q">'), (8, "http://c.net/2", "<link href='1' rel='canonical'>"),
    (9, None, None), (10, "no scheme", None), (11, "http://b.com/de/w", '<link rel=canonical href="//d.org/ok">'), (12, "http://d.org/ok", None),
    (13, "https://C.net/2#top", None), (14, "http://e.net", None), (14, "http://e.net", None), (15, "http://myexample.org/es/", None),
    (16, "http://f.net/p", '<link rel="canonical" href="http://b.com/de/w">'),
]


def test_urls(spark, con):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, host string")

    def query(s, d):
        return url_filter.filter_urls(pages, url_filter.rules_frame(spark), url_filter.page_links(pages))

    con.register("odd_pages", pages.toPandas())
    assert differences(spark, con, query, url_filter.SQL.replace("FROM pages", "FROM odd_pages"), SF_DIR) == []
    found = {r.page_id: (r.rule, r.verdict, r.reason) for r in query(spark, "").collect()}
    assert found[2] == ("example.org/es/", "block", "rule") and found[3] == ("example.org/en/1", "block", "rule")
    assert found[6] == (None, "block", "alias") and found[8][1:] == found[13][1:] == ("block", "alias")
    assert found[12] == ("org/", "allow", "rule") and found[11] == ("com/de/", "block", "rule")
    # An explicit allow in the class wins over a block for a member without a rule.
    assert found[16] == (None, "allow", "alias")
    assert found[9] == found[10] == (None, "allow", "default") and found[15] == ("org/", "allow", "rule")


# Pages whose only tie to a blocked page is a tag written in some way, and pages that nothing ties.
ALIASES = [
    ("http://g1.net/a", '<meta content="0; url=http://z.com/de/1" http-equiv="Refresh">'),
    ("http://g2.net/a", "<LINK HREF=http://z.com/de/2 title='a > b' REL='alternate canonical'>"),
    ("http://g3.net/a", '<link rel=canonical href="http://z.com/de/3?x=1&amp;y=2">'),
    ("http://g4.net/a", '<meta http-equiv="refresh" content="9"><meta http-equiv=refresh content="1;url=/b"><meta http-equiv=refresh content="2,URL=\'http://z.com/de/4\'">'),
    ("http://g5.net/a", '<link rel="canonical" href="/other"><link rel="canonical" href="http://z.com/de/x/../5">'),
    ("http://z.com/m/n/6?q", '<link rel="canonical" href="../../de/./6">'),
    ("http://z.com/de2/7", '<link data-href="http://a.org/" rel="canonical" href="//Z.com&#x2F;de/7#f">'),
    ("http://g8.net/a?p=1", '<link rel="canonical" href="?p=2">'), ("http://g8.net/a?p=2", '<link rel="canonical" href="http://z.com/de/8">'),
    ("http://g9.net", "<link rel='canonical' href='x'>"), ("http://g9.net/x", '<meta http-equiv="refresh" content="0;url=http://z.com/de/9">'),
    ("http://g10.net/a/../b", '<link rel="canonical" href="http://z.com/de/10">'), ("http://g10.net/c", "<link rel=canonical href=./b/.>"), ("http://g10.net/b/", '<link rel=canonical href="/b">'),
]
FREE = [
    ("http://h1.net/a", '<link rel="noncanonical" href="http://z.com/de/1">'), ("http://h2.net/a", '<meta http-equiv="refresh" content="30">'),
    ("http://h3.net/a", '<a rel="canonical" href="http://z.com/de/3">'), ("http://h4.net/a", "<link rel=canonical href=#top>"), ("http://h5.net/a", '<link rel="canonical" href="mailto:x">'),
    ("http://h6.net/a", "canonical"), ("http://h7.net/a", '<link rel="canonical" href="">'), ("http://h8.net/a", '<link rel="canonical" data-href="http://z.com/de/1">'),
]


def test_aliases_however_the_tag_is_written(spark, con):
    tied = [(i, *p) for i, p in enumerate(ALIASES + FREE)]
    pages = spark.createDataFrame(tied, "page_id long, url string, html string")

    def query(s, d):
        return url_filter.filter_urls(pages, url_filter.rules_frame(spark), url_filter.page_links(pages))

    con.register("tied_pages", pages.toPandas())
    found = {r.page_id: (r.verdict, r.reason) for r in query(spark, "").collect()}
    assert {i: f for i, f in found.items() if f != ("block", "alias")} == {i: ("allow", "default") for i in range(len(ALIASES), len(tied))}
    assert differences(spark, con, query, url_filter.SQL.replace("FROM pages", "FROM tied_pages"), SF_DIR) == []


@pytest.mark.parametrize("path, plain", [("/a/./b", "/a/b"), ("/a/../../b", "/b"), ("/a/b/..", "/a/"), ("/..", "/"), ("/a/.", "/a/"), ("/a..b/...", "/a..b/..."), ("/", "/"), ("/a//../b", "/a/b")])
def test_dot_steps(spark, path, plain):
    assert spark.createDataFrame([(path,)], "p string").select(url_filter.without_dots(F.col("p"))).first()[0] == plain


def test_urls_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.filter_urls(pages, url_filter.rules_frame(spark), url_filter.page_links(pages)).count() == 0


def test_pipeline(spark, con):
    """Every stage against a plain version, on what the stage before it kept."""
    import brute
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = Tokenizer.from_file(queries._tokenizer("word_bpe_49k.json"))

    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.predicted}

    def repeats(docs):
        con.register("kept_documents", docs.toPandas())
        rows = con.execute(f"SELECT doc_id, repeats FROM ({mixing.SQL.replace('FROM documents', 'FROM kept_documents')}) AS q").fetchall()
        return {doc_id: n for doc_id, n in rows if n}

    expected = {
        "toxicity": lambda rows: Counter({r.doc_id for r in rows} - toxic),
        "exact_dedup": lambda rows: Counter({k for k, _ in brute.exact_groups([(r.doc_id, r.text) for r in rows]).values()}),
        "ngram_jaccard_join": lambda rows: Counter({c for _, c in brute.near_groups([(r.doc_id, r.text) for r in rows]).values()}),
        "source_mixing": lambda rows: Counter(repeats(docs)),
    }
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        after = function(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        assert Counter(r.doc_id for r in after.select("doc_id").collect()) == expected[name](before), name
        docs = after
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(clean & toxic) <= 0.02 * len(clean)
    entered = Counter((r.doc_id, r.text) for r in docs.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter({d: n for (d, _), n in entered.items()})
    tokens = {d: len(model.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in entered}
    assert all(r.doc_tokens == tokens[r.doc_id] for r in pieces)
    assert sum(r.length for r in pieces) == sum(n * tokens[d] for (d, _), n in entered.items())
    assert QUERIES["pipeline"](spark, SF_DIR).count() == len(pieces)
