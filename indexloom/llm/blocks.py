"""Texts of an Arrow batch as one byte array, and hashes over parts of it. Runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.session import stage

# Rows of an Arrow batch. Whole texts can be long, and a batch is held by the JVM and by Python at once.
BATCH_ROWS = 1000
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Spans hashed at once, so that the working arrays stay in cache, and bytes from which on a span is hashed by itself.
_HASHED_AT_ONCE, _LONG = 1 << 15, 512


def for_tasks(docs: DataFrame) -> DataFrame:
    """The same frame; from now on its session hands rows to Python tasks in smaller batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs


def row_key(docs: DataFrame) -> str:
    """A name for the key of `keyed` that no column of `docs` has."""
    name = "__row_key"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def keyed(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, written, with a number of their own in the column `row_key(docs)`.

    The number is made while the rows are written, so all that read them see the same one. It tells
    rows apart whose ids are missing or repeated, and exact copies.
    """
    return stage(docs.withColumn(row_key(docs), F.monotonically_increasing_id()))


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of a `keyed` frame whose key is not in `gone`, with the columns they came with."""
    return rows.join(gone.select(key), key, "left_anti").drop(key)


def packed(values: np.ndarray) -> bytes:
    """Numbers in few bytes: their bytes of equal order side by side, compressed."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def unpacked(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(dtype).ravel()


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a string or binary column as one uint8 array, and the n + 1 bounds; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of text, or one row where that alone is longer."""
    for batch in batches:
        bounds = as_bytes(batch.column(column))[1]
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def larger_blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows regrouped into blocks that come near `limit` bytes of text, over the batches of a task."""
    held: list[pa.RecordBatch] = []
    size = 0
    for block in text_blocks(batches, column, limit):
        n = int(as_bytes(block.column(column))[1][-1])
        if held and size + n > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if block.num_rows:
            held.append(block)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# Letters A-Z as a-z; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
# The bytes of an 8-byte lane that belong to a span with so many bytes left.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_FACTOR = np.uint64(0xFF51AFD7ED558CCD)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that begin at each place of `data`, as a number; a view of one copy."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans may overlap. Each 8 bytes are mixed in before the next, long spans by xxh3."""
    out = np.empty(len(starts), np.uint64)
    lanes = _lanes(data)
    for first in range(0, len(starts), _HASHED_AT_ONCE):
        s, sizes = starts[first : first + _HASHED_AT_ONCE], (ends - starts)[first : first + _HASHED_AT_ONCE]
        h = mix64(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        long = sizes > _LONG
        for i in np.flatnonzero(long).tolist():
            h[i] = xxhash.xxh3_64_intdigest(data[s[i] : s[i] + sizes[i]])
        open_, at = np.flatnonzero((sizes > 0) & ~long), 0
        while len(open_):
            value = lanes[s[open_] + at] & _MASKS[np.minimum(sizes[open_] - at, 8)]
            x = (h[open_] ^ value) * _FACTOR
            x ^= x >> np.uint64(32)
            x *= _FACTOR
            h[open_] = x ^ (x >> np.uint64(29))
            at += 8
            open_ = open_[sizes[open_] > at]
        out[first : first + _HASHED_AT_ONCE] = h
    return mix64(out)


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Which spans hold the same bytes as the other span given for each."""
    sizes = ends - starts
    same = sizes == other_ends - others
    long = sizes > _LONG
    for i in np.flatnonzero(same & long & (starts != others)).tolist():
        same[i] = np.array_equal(data[starts[i] : ends[i]], data[others[i] : other_ends[i]])
    lanes = _lanes(data)
    open_, at = np.flatnonzero(same & ~long & (sizes > 0) & (starts != others)), 0
    while len(open_):
        differ = (lanes[starts[open_] + at] ^ lanes[others[open_] + at]) & _MASKS[np.minimum(sizes[open_] - at, 8)]
        same[open_[differ != 0]] = False
        at += 8
        open_ = open_[(differ == 0) & (sizes[open_] > at)]
    return same


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different spans in order of their hashes: hash, an occurrence of each, and the number of each span's.

    Spans are told apart by their bytes; different ones with one hash stand side by side.
    """
    hashes = span_hashes(data, starts, ends)
    kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    one = first[kind]
    met = np.flatnonzero(~same_bytes(data, starts, ends, starts[one], ends[one]))
    if not len(met):
        return kinds, first, kind
    numbers: dict[bytes, int] = {}
    variant = np.zeros(len(starts), np.int64)
    for i in met.tolist():
        variant[i] = numbers.setdefault(data[starts[i] : ends[i]].tobytes(), len(numbers) + 1)
    order = np.lexsort((variant, hashes))
    opens = np.ones(len(order), bool)
    opens[1:] = (np.diff(variant[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(opens) - 1
    return hashes[order[opens]], order[opens], kind


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes other than white space: starts, ends, and how many lie before each bound."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, bounds)


def at_white_space(data: np.ndarray, limit: int) -> list[int]:
    """Ends of pieces of one text: each of at most `limit` bytes, or up to the next white space where there is none before."""
    ends, at = [], 0
    while len(data) - at > limit:
        white = np.flatnonzero(SPACE[data[at : at + limit]])
        if len(white):
            at += int(white[-1]) + 1
        else:
            rest = np.flatnonzero(SPACE[data[at + limit :]])
            at = at + limit + int(rest[0]) + 1 if len(rest) else len(data)
        ends.append(at)
    return ends if ends and ends[-1] == len(data) else [*ends, len(data)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i] + 1 ... for lengths[i] places each, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def in_shards(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """doc_id, text and shard: a number that deals documents into shards of about `shard_bytes` of text.

    They are dealt by id and text, so rows without an id spread as well. The shuffle by shard is the same wherever the frame is
    grouped within one query, so it is made once.
    """
    rows = for_tasks(docs).select("doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(least, -(-total // shard_bytes)))))


def bucket_bits(docs: DataFrame) -> int:
    """Bits that tell as many buckets apart as the session has shuffle partitions, or up to twice as many."""
    return max(0, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def stretches(buckets: np.ndarray) -> tuple[list[int], list[int]]:
    """Of buckets in order: which occur, and where each begins, with the end as last bound."""
    held, opens = np.unique(buckets, return_index=True)
    return held.tolist(), [*opens.tolist(), len(buckets)]


def merged(keys: np.ndarray, values: np.ndarray, others: np.ndarray, other_values: np.ndarray, combine) -> tuple[np.ndarray, np.ndarray]:
    """Two runs of different keys in order as one; a key of both has its values combined. Places come from binary search."""
    if not len(keys) or not len(others):
        return (keys, values) if len(keys) else (others, other_values)
    at = np.searchsorted(keys, others)
    inside = np.minimum(at, len(keys) - 1)
    same = keys[inside] == others
    values = values.copy()
    values[inside[same]] = combine(values[inside[same]], other_values[same])
    place = at[~same] + np.arange(int((~same).sum()))
    old = np.ones(len(keys) + len(place), bool)
    old[place] = False
    all_keys, all_values = np.empty(len(old), keys.dtype), np.empty(len(old), values.dtype)
    all_keys[place], all_values[place] = others[~same], other_values[~same]
    all_keys[old], all_values[old] = keys, values
    return all_keys, all_values


def merged_runs(runs: Iterable[tuple[np.ndarray, np.ndarray]], combine) -> tuple[np.ndarray, np.ndarray] | None:
    """All runs as one, merged in pairs of about equal age, so that each key moves once per doubling."""
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    for keys, values in runs:
        times = 0
        while held and held[-1][0] == times:
            _, earlier, earlier_values = held.pop()
            keys, values = merged(earlier, earlier_values, keys, values, combine)
            times += 1
        held.append((times, keys, values))
    while len(held) > 1:
        _, keys, values = held.pop()
        times, earlier, earlier_values = held.pop()
        held.append((times, *merged(earlier, earlier_values, keys, values, combine)))
    return held[0][1:] if held else None


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values
