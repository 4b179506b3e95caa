"""Pack documents into training sequences along a space-filling curve."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from indexloom.llm import blocks
from indexloom.llm.token_counts import ENCODE_BATCH, tokenizer
from indexloom.session import stage

SEQUENCE = 4096
END_ID = 2
# Text whose different words are encoded together, in bytes, and the words whose ids a process keeps.
BLOCK_BYTES, KNOWN_WORDS = 2 << 20, 1 << 20
HASHED_DIMENSIONS, CURVE_DIMENSIONS, CURVE_BITS = 64, 3, 16


@functools.cache
def _projection(n_ids: int) -> np.ndarray:
    """Per token id its share in the projected document vector.

    A document vector has HASHED_DIMENSIONS numbers: each id adds its weight, with a hashed sign, to a
    hashed dimension. A fixed Gaussian matrix projects it to the dimensions of the curve. Both are
    linear, so one table has the result per id. Rarer pieces have larger ids and weigh more.
    """
    hashed = blocks.mix64(np.arange(n_ids, dtype=np.uint64))
    sign = 1.0 - 2.0 * (hashed >> np.uint64(63)).astype(float)
    matrix = np.random.default_rng(0).standard_normal((HASHED_DIMENSIONS, CURVE_DIMENSIONS))
    weight = np.log2(2.0 + np.arange(n_ids))
    return matrix[(hashed % np.uint64(HASHED_DIMENSIONS)).astype(int)] * (sign * weight)[:, None]


def hilbert_keys(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Position of each point (integers below 2 ** bits, one column per dimension) on the Hilbert curve."""
    x = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(n):
            up = (x[d] & bit) != 0
            exchanged = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ exchanged)
            x[d] = x[d] ^ exchanged if d else x[0]
        bit >>= 1
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    turned = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turned = np.where(x[n - 1] & bit, turned ^ (bit - 1), turned)
        bit >>= 1
    key = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | (((x[d] ^ turned) >> b) & 1)
    return key


# Bytes of either side of a cut inside a word. Between an ASCII letter and one of these marks, in either
# order, a piece always ends; apostrophes and the marks of special strings are not among them.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[list(b'!"(),.:;?')] = True


def parts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts texts into words and marks whose ids do not depend on what is around them.

    Starts, ends, how many lie before each bound, and the bytes with letters in one case, as the tokenizer is
    blind to it except in special strings (words with a `<`, which stay as they are).
    """
    starts, ends, before = blocks.words(data, bounds)
    if not len(starts):
        return starts, ends, before, data
    cut = np.zeros(len(data), bool)
    cut[1:] = (_LETTER[data[:-1]] & _MARK[data[1:]]) | (_MARK[data[:-1]] & _LETTER[data[1:]])
    cut[bounds[(bounds > 0) & (bounds < len(data))]] = False
    inner = np.flatnonzero(cut)
    starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    folded = blocks.LOWER[data]
    special = np.unique(np.searchsorted(starts, np.flatnonzero(data == 0x3C), "right") - 1)
    as_is = blocks.ragged(starts[special], ends[special] - starts[special])
    folded[as_is] = data[as_is]
    return starts, ends, np.searchsorted(starts, bounds), folded


class _KnownIds:
    """Ids of words that this process has met, by the words themselves; it takes up no more when it is full.

    Words and ids lie one after the other in arrays, as a process keeps them for as long as it lives, and an object for each would
    take several times their bytes. `hashes` are in order, `entry` has the word of each; where two words share one, the first is kept.
    """

    def __init__(self, path: str):
        self.encode = tokenizer(path).encode_batch_fast
        self.hashes, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.words, self.word_bounds = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_bounds = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def look_up(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, given in order of their hashes, one after the other, and how many each has."""
        at = np.searchsorted(self.hashes, hashes)
        met = np.flatnonzero(np.append(self.hashes, np.uint64(0))[at] == hashes)
        met = met[at[met] < len(self.hashes)]
        entry = self.entry[at[met]]
        both, offset = np.concatenate([data, self.words]), len(data)
        same = blocks.same_bytes(both, starts[met], ends[met], self.word_bounds[entry] + offset, self.word_bounds[entry + 1] + offset)
        # A hash that another word has cannot be kept a second time.
        taken = met[~same]
        met, entry = met[same], entry[same]
        is_new = np.ones(len(hashes), bool)
        is_new[met] = False
        new = np.flatnonzero(is_new)
        whole, told, sizes = data.tobytes(), [np.zeros(0, np.uint16)], []
        for first in range(0, len(new), ENCODE_BATCH):
            some = new[first : first + ENCODE_BATCH].tolist()
            for e in self.encode([whole[starts[i] : ends[i]].decode("utf-8", "replace") for i in some], add_special_tokens=False):
                told.append(np.array(e.ids, np.uint16))
                sizes.append(len(e.ids))
        new_ids, new_sizes = np.concatenate(told), np.array(sizes, np.int64)
        lengths, begins = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        lengths[met], begins[met] = self.id_bounds[entry + 1] - self.id_bounds[entry], self.id_bounds[entry]
        lengths[new], begins[new] = new_sizes, len(self.ids) + np.cumsum(new_sizes) - new_sizes
        found = np.concatenate([self.ids, new_ids])[blocks.ragged(begins, lengths)]
        keep = np.ones(len(new), bool)
        keep[np.isin(new, taken)] = False
        keep[1:] &= hashes[new][1:] != hashes[new][:-1]
        self._keep(np.flatnonzero(keep)[: KNOWN_WORDS - len(self.hashes)], hashes[new], data, starts[new], ends[new], new_ids, new_sizes)
        return found, lengths

    def _keep(self, some: np.ndarray, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if not len(some):
            return
        entries = np.arange(len(self.hashes), len(self.hashes) + len(some), dtype=np.int32)
        place = np.searchsorted(self.hashes, hashes[some])
        self.hashes, self.entry = np.insert(self.hashes, place, hashes[some]), np.insert(self.entry, place, entries)
        long = (ends - starts)[some]
        self.words = np.concatenate([self.words, data[blocks.ragged(starts[some], long)]])
        self.word_bounds = np.concatenate([self.word_bounds, self.word_bounds[-1] + np.cumsum(long)])
        self.ids = np.concatenate([self.ids, ids[blocks.ragged((np.cumsum(sizes) - sizes)[some], sizes[some])]])
        self.id_bounds = np.concatenate([self.id_bounds, self.id_bounds[-1] + np.cumsum(sizes[some])])


@functools.lru_cache(maxsize=1)
def _known_ids(path: str) -> _KnownIds:
    return _KnownIds(path)


def encoded(data: np.ndarray, bounds: np.ndarray, known: _KnownIds, table: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Ids and summed vector of each text."""
    starts, ends, before, folded = parts(data, bounds)
    hashes, first, kind = blocks.distinct_spans(folded, starts, ends)
    flat, lengths = known.look_up(hashes, folded, starts[first], ends[first])
    begins = np.cumsum(lengths) - lengths
    # Sums of token shares, per word and then per document.
    shares = np.vstack([np.zeros(CURVE_DIMENSIONS), np.cumsum(table[flat], axis=0)])
    of_word = shares[begins + lengths] - shares[begins]
    sums = np.vstack([np.zeros(CURVE_DIMENSIONS), np.cumsum(of_word[kind], axis=0)])
    vectors = sums[before[1:]] - sums[before[:-1]]
    del shares, of_word, sums
    ids = flat[blocks.ragged(begins[kind], lengths[kind])]
    upto = np.concatenate([[0], np.cumsum(lengths[kind])])[before].tolist()
    return [ids[a:b].tobytes() for a, b in zip(upto, upto[1:], strict=False)], vectors


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known_ids(path)
        table = _projection(tokenizer(path).get_vocab_size())
        for batch in blocks.larger_blocks(batches, "text", BLOCK_BYTES):
            data, bounds = blocks.as_bytes(batch.column("text"))
            # One text that is longer by itself is encoded in pieces that end at white space.
            pieces = blocks.at_white_space(data, BLOCK_BYTES) if batch.num_rows == 1 else [len(data)]
            if len(pieces) == 1:
                packed, vectors = encoded(data, bounds, known, table)
            else:
                told = [encoded(data[a:b], np.array([0, b - a]), known, table) for a, b in zip([0, *pieces], pieces, strict=False)]
                packed, vectors = [b"".join(ids[0] for ids, _ in told)], sum(v for _, v in told)
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 1e-9)
            places = np.minimum((unit + 1) * (1 << CURVE_BITS - 1), (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hilbert_keys(places)), pa.array(packed, pa.binary())], names=["doc_id", "curve", "ids"]
            )

    return run


def _pack(sequence: int, end_id: int):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence_id = TaskContext.get().partitionId() << 40
        used = 0
        # Parts of the sequence that is being filled: document, first id, ids, ids of the document.
        open_parts: list[tuple] = []
        rows: list[tuple] = []

        def close(parts: list[tuple]) -> None:
            nonlocal sequence_id
            offset = 0
            for doc_id, start, ids, total in parts:
                rows.append((doc_id, start, len(ids), ids.tobytes(), total, sequence_id, offset))
                offset += len(ids)
            sequence_id += 1

        def given(id_type: pa.DataType) -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.append(np.frombuffer(packed.as_buffer(), np.uint16), end_id).astype("<u4")
                start = 0
                while start < len(ids):
                    part = ids[start : start + sequence - used]
                    open_parts.append((doc_id, start, part, len(ids)))
                    used += len(part)
                    start += len(part)
                    if used == sequence:
                        close(open_parts)
                        open_parts, used = [], 0
            if len(rows) > 1000:
                yield given(id_type)
        # What is left is cut into sequences whose lengths are powers of two, which need no padding.
        while used:
            size = 1 << used.bit_length() - 1
            taken, rest, room = [], [], size
            for doc_id, start, ids, total in open_parts:
                if room:
                    taken.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.append((doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            close(taken)
            open_parts, used = rest, used - size
        if rows:
            yield given(id_type)

    return run


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of at most `sequence` ids (a power of two).

    Columns: doc_id, start (ids of the document before the piece), length, ids (little-endian unsigned
    32-bit numbers), doc_tokens, sequence_id, offset (place in the sequence). A document is the ids of its whole text, by the tokenizer file `path` of at most 65,536 ids, without
    added tokens, and then `end_id`. A null or empty text is `end_id` alone; repeated rows are packed
    each, a null doc_id is kept, no rows give no pieces, other columns are not looked at.

    Documents are ordered by the place of their projected vectors on a Hilbert curve and by doc_id, in
    ranges that Spark balances, so copies of one text spread over ranges as any others do. Each range
    is one stream of ids, cut at every full sequence. Its end is cut into powers of two, so nothing is
    padded. The ids are written once, as sorting into ranges reads them twice.
    """
    id_type = docs.schema["doc_id"].dataType
    encoded = T.StructType([T.StructField("doc_id", id_type), T.StructField("curve", T.LongType()), T.StructField("ids", T.BinaryType())])
    placed = stage(blocks.for_tasks(docs).select("doc_id", "text").mapInArrow(_encode(path), encoded))
    pieces = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in ("doc_tokens", "sequence_id", "offset")]])
    ordered = placed.repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id")
    return ordered.mapInArrow(_pack(sequence, end_id), pieces)
