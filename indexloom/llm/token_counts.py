"""Token counts from pre-token frequencies, without token ids."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks
from indexloom.session import stage

# Text that one dictionary of pre-tokens covers, in bytes.
BLOCK_BYTES = 4 << 20
ENCODE_BATCH = 5_000

# Bytes that a cut may stand before (after one byte of white space). Not among them: lead bytes of
# further white-space characters (U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000), control bytes, and
# the first byte of the special strings.
_OPENS = np.zeros(256, bool)
_OPENS[0x21:0x7F] = True
_OPENS[0xC3:0xF5] = True
_OPENS[[0x3C, 0xE1, 0xE2, 0xE3]] = False


def pre_tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts texts into pre-tokens: starts, ends, and how many begin before each bound.

    A cut stands before the last white-space byte of a run that a word follows, where a byte-level
    pre-tokenizer always ends a piece, so the tokens of a text are those of its pre-tokens together.
    Where that is not certain there is no cut.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    cut = np.zeros(len(data), bool)
    cut[:-1] = blocks.SPACE[data[:-1]] & _OPENS[data[1:]]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    cut[edges - 1] = False
    cut[edges] = True
    cut[0] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, bounds)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def count_pieces(path: str, texts: pa.Array) -> np.ndarray:
    """Tokens of each text."""
    encode = tokenizer(path).encode_batch_fast
    parts = (texts.slice(i, ENCODE_BATCH).to_pylist() for i in range(0, len(texts), ENCODE_BATCH))
    return np.array([len(e) for part in parts for e in encode(part, add_special_tokens=False)], np.uint32)


def _blocks_of(bucket_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_id = TaskContext.get().partitionId() << 32
        for batch in blocks.larger_blocks(batches, "text", BLOCK_BYTES):
            data, bounds = blocks.as_bytes(batch.column("text"))
            starts, ends, before = pre_tokens(data, bounds)
            kinds, first, kind = blocks.distinct_spans(data, starts, ends)
            # Frequencies: per document its different pre-tokens, as steps between numbers, and how often.
            document = np.repeat(np.arange(batch.num_rows), np.diff(before))
            pairs, times = np.unique(document * np.int64(len(kinds) + 1) + kind, return_counts=True)
            owner, which = np.divmod(pairs, len(kinds) + 1)
            steps = np.diff(which, prepend=0).astype(np.int32)
            # The dictionary is in the order of hashes, so each bucket is one stretch of it.
            bucket = (kinds >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(kinds), np.int64)
            held, opens = np.unique(bucket, return_index=True)
            lengths = (ends - starts)[first]
            upto = np.concatenate([[0], np.cumsum(lengths)])
            strings = data[blocks.ragged(starts[first], lengths)]
            cuts = [*opens.tolist(), len(kinds)]
            dictionary = [
                {"bucket": b, "strings": zstandard.compress(strings[upto[i] : upto[j]].tobytes(), 1), "lengths": blocks.packed(lengths[i:j].astype(np.uint32))}
                for b, i, j in zip(held.tolist(), cuts, cuts[1:], strict=False)
            ]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block_id], pa.int64()),
                "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                "n_bytes": pa.array([np.diff(bounds)], pa.list_(pa.int64())),
                "n_kinds": pa.array([np.bincount(owner, minlength=batch.num_rows)], pa.list_(pa.int64())),
                "steps": pa.array([blocks.packed(steps)], pa.binary()),
                "times": pa.array([blocks.packed(times.astype(np.uint32))], pa.binary()),
                "dictionary": pa.array([dictionary], pa.list_(pa.struct([("bucket", pa.int64()), ("strings", pa.binary()), ("lengths", pa.binary())]))),
            })
            block_id += 1

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Tokens of each whole text: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `path` names a byte-level tokenizer file of the tokenizers library, which must be there on every
    executor; special strings inside texts count as the library's default has it, nothing is added, cut
    off or padded. Null and empty texts have 0 of both. Repeated rows and ids are counted each, a null
    doc_id is kept, no rows give no rows, other columns are not looked at.

    Each block of texts gives a dictionary of its pre-tokens and the frequencies per document.
    Dictionaries are split by hash into buckets, in which every pre-token of the corpus meets once per
    block, is counted once, and its number goes back to the blocks that asked, to be summed with the
    frequencies. A frequent pre-token costs one row per block, not one per occurrence. Hashes bring equal
    pre-tokens together; they are told apart by their bytes, within a block and across blocks.
    """
    spark = docs.sparkSession
    bucket_bits = max(0, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    id_type = docs.schema["doc_id"].dataType
    longs = T.ArrayType(T.LongType())
    dictionary = T.ArrayType(T.StructType([T.StructField("bucket", T.LongType()), T.StructField("strings", T.BinaryType()), T.StructField("lengths", T.BinaryType())]))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("n_bytes", longs),
        T.StructField("n_kinds", longs), T.StructField("steps", T.BinaryType()), T.StructField("times", T.BinaryType()),
        T.StructField("dictionary", dictionary),
    ])
    held = stage(blocks.for_tasks(docs).select("doc_id", "text").mapInArrow(_blocks_of(bucket_bits), schema))

    def count(table: pa.Table) -> pa.Table:
        sizes = [blocks.unpacked(p, np.uint32) for p in table.column("lengths").to_pylist()]
        strings = b"".join(map(zstandard.decompress, table.column("strings").to_pylist()))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        asked = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(strings)).dictionary_encode()
        pieces = count_pieces(path, asked.dictionary)[asked.indices.to_numpy()]
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in sizes])]).tolist()
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"),
            "pieces": pa.array([blocks.packed(pieces[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        })

    words = held.select("block", F.explode("dictionary").alias("part")).select("block", "part.*")
    counted = words.groupBy("bucket").applyInArrow(count, "block long, bucket long, pieces binary")

    def total(frequencies: pa.Table, numbers: pa.Table) -> pa.Table:
        parts = numbers.sort_by("bucket").column("pieces").to_pylist()
        pieces = np.concatenate([np.zeros(0, np.uint32), *(blocks.unpacked(p, np.uint32) for p in parts)]).astype(np.int64)
        row = frequencies.slice(0, 1).to_pylist()[0]
        n_kinds = np.array(row["n_kinds"], np.int64)
        which = np.cumsum(blocks.unpacked(row["steps"], np.int32).astype(np.int64))
        tokens = np.concatenate([[0], np.cumsum(pieces[which] * blocks.unpacked(row["times"], np.uint32))])
        ends = np.cumsum(n_kinds)
        n_tokens = tokens[ends] - tokens[ends - n_kinds]
        ids = frequencies.column("doc_ids").combine_chunks().flatten()
        return pa.table({"doc_id": ids, "n_bytes": pa.array(row["n_bytes"], pa.int64()), "n_tokens": n_tokens, "over_limit": n_tokens > limit})

    result = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])
    return held.drop("dictionary").groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(total, result)
