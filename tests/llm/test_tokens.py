"""Token counts and packing against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR, make
from tokenizers import Tokenizer

from indexloom.llm import blocks, jaccard, packing, queries, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("table", ["odd", "given"])
def test_counts(spark, odd, table):
    docs = odd if table == "odd" else spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = Tokenizer.from_file(BYTES)
    expected = {r.doc_id: (len((r.text or "").encode()), len(model.encode(r.text or "", add_special_tokens=False))) for r in docs.collect()}
    found = token_counts.token_counts(docs, BYTES).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == expected
    assert all(r.over_limit == (r.n_tokens > 512) for r in found)


def test_pre_tokens_never_split_a_piece():
    """Every white-space and word character next to every other."""
    model = Tokenizer.from_file(BYTES)
    signs = ["a", "é", "1", ".", "'", " ", "  ", "\n", "\t", " ", " ", "\u0085", "\x1c", "　", "<|endoftext|>", "<", "日"]
    for x in signs:
        for y in signs:
            for z in signs:
                text = f"b{x}{y}{z}c"
                data = np.frombuffer(text.encode(), np.uint8)
                starts, ends, _ = token_counts.pre_tokens(data, np.array([0, len(data)]))
                parts = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
                assert sum(len(model.encode(p, add_special_tokens=False)) for p in parts) == len(model.encode(text, add_special_tokens=False)), repr(text)


def check_pieces(docs, rows, sequence):
    model = Tokenizer.from_file(WORDS)
    of_doc, of_sequence = {}, {}
    for r in rows:
        of_doc.setdefault(r.doc_id, []).append(r)
        of_sequence.setdefault(r.sequence_id, []).append(r)
    for doc in docs:
        ids = np.array([*model.encode(doc.text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        pieces = sorted(of_doc.pop(doc.doc_id), key=lambda r: r.start)
        assert b"".join(bytes(p.ids) for p in pieces) == ids.tobytes()
        assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        assert all(p.doc_tokens == len(ids) and len(p.ids) == 4 * p.length for p in pieces)
    assert not of_doc
    for pieces in of_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        total = sum(p.length for p in pieces)
        assert total <= sequence and total & (total - 1) == 0


@pytest.mark.parametrize("sequence", [4096, 64])
def test_packing(spark, odd, sequence):
    for docs in (odd, spark.read.parquet(f"{SF_DIR}/documents.parquet")):
        check_pieces(docs.collect(), packing.pack(docs, WORDS, sequence).collect(), sequence)


def thue_morse(a, b, n=10):
    """Words of 2 ** n letters whose polynomial hashes modulo 2 ** 64 are equal for any base."""
    bits = [bin(i).count("1") & 1 for i in range(1 << n)]
    return "".join(a if x else b for x in bits), "".join(b if x else a for x in bits)


@pytest.mark.parametrize("met", [False, True])
def test_words_that_hash_alike(spark, met, monkeypatch):
    """Different words of one hash get their own counts, ids and no link; also where every word has the same hash."""
    pairs = [thue_morse(a, b) for a, b in ("ab", "cd", "ex", "qz", "mn")]
    rows = [(2 * i + j, f"{w} and {w} again", "en", "s") for i, p in enumerate(pairs) for j, w in enumerate(p)]
    docs = make(spark, rows).coalesce(1)
    texts = [r[1] for r in rows]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts, ends, _ = blocks.words(data, np.cumsum([0, *map(len, texts)]))
    if met:
        monkeypatch.setattr(blocks, "span_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
        kinds, first, kind = blocks.distinct_spans(data, starts, ends)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        assert len(kinds) == len(set(words)) and [words[first[k]] for k in kind] == words
        return
    assert len(set(blocks.span_hashes(data, starts, ends).tolist())) == 12
    model = Tokenizer.from_file(BYTES)
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, BYTES).collect()} == {r[0]: len(model.encode(r[1], add_special_tokens=False)) for r in rows}
    check_pieces(docs.collect(), packing.pack(docs, WORDS).collect(), 4096)
    assert all(r.doc_id == r.component_id for r in jaccard.linked_documents(docs).collect())


def test_a_text_in_pieces(spark, odd, monkeypatch):
    """Texts that are longer than a block by themselves have the ids they have as a whole."""
    known, table = packing._KnownIds(WORDS), packing._projection(1 << 16)
    for r in odd.collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        whole = packing.encoded(data, np.array([0, len(data)]), known, table)
        cuts = blocks.at_white_space(data, 50)
        assert cuts[-1] == len(data) and all(blocks.SPACE[data[c - 1]] for c in cuts[:-1])
        parts = [packing.encoded(data[a:b], np.array([0, b - a]), known, table) for a, b in zip([0, *cuts], cuts, strict=False)]
        assert b"".join(ids[0] for ids, _ in parts) == whole[0][0]
        assert np.allclose(sum(v for _, v in parts), whole[1])


def test_the_query_on_packing(spark):
    """ids_crc32 is that of the ids as little-endian 32-bit numbers."""
    model = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.op10_packing(spark, SF_DIR).collect():
        ids = [*model.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_hilbert_curve_walks_to_neighbours():
    points = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_repeated_rows_and_no_rows(repeated, nothing):
    n = repeated.count()
    assert token_counts.token_counts(repeated, BYTES).count() == n
    packed = packing.pack(repeated, WORDS).collect()
    assert sum(r.start == 0 for r in packed) == n
    assert token_counts.token_counts(nothing, BYTES).count() == 0 and packing.pack(nothing, WORDS).count() == 0


def test_known_words_are_kept_in_few_bytes():
    """Also words that share a hash, of which one is kept."""
    known = packing._KnownIds(WORDS)
    words = [f"word{i}" for i in range(20000)] + ["one", "two"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = np.append(np.arange(20001, dtype=np.uint64), np.uint64(20000))
    expected = [e.ids for e in known.encode(words, add_special_tokens=False)]
    for _ in range(2):
        ids, lengths = known.look_up(hashes, data, ends - [len(w) for w in words], ends)
        assert lengths.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]
    assert known.hashes.tolist() == list(range(20001))
    held = sum(x.nbytes for x in vars(known).values() if isinstance(x, np.ndarray))
    assert held < 60 * len(words)
