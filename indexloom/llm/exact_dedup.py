"""Exact duplicates by counting quotient filters, verified byte by byte."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks
from indexloom.session import stage

WHITE_SPACE = b" \t\n\x0b\x0c\r"
# Fingerprints gathered in a task before a filter is given out.
FILTER_SIZE = 1 << 20


class CountingQuotientFilter:
    """A multiset of 64-bit fingerprints, all within one range of leading bits.

    After the range, a fingerprint splits into a quotient and a remainder. The remainders stand in one
    table, ordered by quotient and then by value; `occupied` marks the quotients that have a run and
    `run_end` the last slot of each run, so quotients are not stored. Every slot has a count. The table
    is full: there are as many slots as different fingerprints, and nothing is lost.
    """

    def __init__(self, occupied: np.ndarray, run_end: np.ndarray, remainders: np.ndarray, counts: np.ndarray, quotient_bits: int):
        self.occupied, self.run_end, self.remainders, self.counts = occupied, run_end, remainders, counts
        self.quotient_bits = quotient_bits

    @classmethod
    def of_sorted(cls, prints: np.ndarray, counts: np.ndarray, range_bits: int) -> CountingQuotientFilter:
        """From different fingerprints in order, with their counts."""
        quotient_bits = max(0, int(len(prints)).bit_length() - 1)
        body = prints << np.uint64(range_bits) if range_bits else prints.copy()
        quotients = (body >> np.uint64(64 - quotient_bits)).astype(np.int64) if quotient_bits else np.zeros(len(prints), np.int64)
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotients] = True
        run_end = np.ones(len(prints), bool)
        run_end[:-1] = quotients[1:] != quotients[:-1]
        remainders = (body << np.uint64(quotient_bits)) if quotient_bits else body
        return cls(occupied, run_end, remainders, counts, quotient_bits)

    def fingerprints(self, of_range: int, range_bits: int) -> np.ndarray:
        """The fingerprints in order, rebuilt from runs and remainders."""
        runs = np.flatnonzero(self.occupied)
        run = np.concatenate([[0], np.cumsum(self.run_end[:-1])]).astype(np.int64) if len(self.remainders) else np.zeros(0, np.int64)
        quotients = runs[run].astype(np.uint64) if len(runs) else np.zeros(0, np.uint64)
        body = self.remainders >> np.uint64(self.quotient_bits) if self.quotient_bits else self.remainders
        if self.quotient_bits:
            body = body | (quotients << np.uint64(64 - self.quotient_bits))
        if not range_bits:
            return body
        return (body >> np.uint64(range_bits)) | np.uint64(of_range << (64 - range_bits))

    def pack(self) -> bytes:
        head = np.array([self.quotient_bits, len(self.remainders)], np.int64).tobytes()
        return b"".join([head, np.packbits(self.occupied).tobytes(), np.packbits(self.run_end).tobytes(), self.remainders.tobytes(), self.counts.astype(np.int64).tobytes()])

    @classmethod
    def unpack(cls, packed: bytes) -> CountingQuotientFilter:
        bits, n = np.frombuffer(packed, np.int64, 2).tolist()
        a, b, at = (1 << bits) + 7 >> 3, n + 7 >> 3, 16
        occupied = np.unpackbits(np.frombuffer(packed, np.uint8, a, at), count=1 << bits).astype(bool)
        run_end = np.unpackbits(np.frombuffer(packed, np.uint8, b, at + a), count=n).astype(bool)
        at += a + b
        return cls(occupied, run_end, np.frombuffer(packed, np.uint64, n, at), np.frombuffer(packed, np.int64, n, at + 8 * n), bits)


def merge_filters(filters: list[CountingQuotientFilter], of_range: int, range_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Different fingerprints and their summed counts. The remainders of each filter are in order already and are merged, not sorted."""
    found = blocks.merged_runs(((f.fingerprints(of_range, range_bits), f.counts) for f in filters), np.add)
    return found if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def normalised(text: str | None) -> bytes:
    """The text in UTF-8 without white space; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(None, WHITE_SPACE)


def _digests(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.text_blocks(batches, "text", 4 << 20):
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
            bare = [normalised(t) for t in batch.column("text").to_pylist()]
            prints = np.array([xxhash.xxh3_64_intdigest(b) for b in bare], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), points, pa.array(prints), pa.array([hashlib.sha256(b).hexdigest() for b in bare], pa.string())]
            names = ["doc_id", "n_points", "print", "text_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(bare, pa.binary())], [*names, "bare"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def digests(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_points (code points of the text), print (64-bit fingerprint), text_sha256, bare if asked for."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_points", T.LongType()), T.StructField("print", T.LongType()),
        T.StructField("text_sha256", T.StringType()), *([T.StructField("bare", T.BinaryType())] if with_text else []),
    ])
    return blocks.for_tasks(docs).select("doc_id", "text").mapInArrow(_digests(with_text), schema)


def repeated_fingerprints(prints: DataFrame) -> DataFrame:
    """Fingerprints (column print) that occur more than once: print, n.

    Every task builds one filter per range of leading bits from what it reads, so a hot fingerprint is
    one slot with a count. The filters of a range meet in one group and are merged; with as many ranges
    as shuffle partitions a group holds one partition's share of the different fingerprints.
    """
    range_bits = max(0, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(found: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            owner = (values >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(values), np.int64)
            ranges, firsts = np.unique(owner, return_index=True)
            cuts = [*firsts.tolist(), len(values)]
            packed = [CountingQuotientFilter.of_sorted(values[a:b], counts[a:b], range_bits).pack() for a, b in zip(cuts, cuts[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), pa.array(packed, pa.binary())], names=["range", "filter"])

        found, n = [], 0
        for batch in batches:
            found.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += batch.num_rows
            if n >= FILTER_SIZE:
                yield given(found)
                found, n = [], 0
        if n:
            yield given(found)

    def merge(table: pa.Table) -> pa.Table:
        of_range = table.column("range")[0].as_py()
        values, counts = merge_filters([CountingQuotientFilter.unpack(p) for p in table.column("filter").to_pylist()], of_range, range_bits)
        again = counts > 1
        return pa.table({"print": values[again].view(np.int64), "n": counts[again]})

    filters = prints.select("print").mapInArrow(build, "range long, filter binary")
    return filters.groupBy("range").applyInArrow(merge, "print long, n long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Groups of equal texts: one row per row of `docs` with doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space (space and U+0009 to U+000D). Of a group the row
    with the most code points in its original text stays, then the smallest doc_id. Null text counts as
    empty, so null, empty and white-space texts are one group. Rows that repeat both doc_id and text
    share a verdict, as doc_id names a row; a null doc_id is the smallest. No rows give no rows, other
    columns are not looked at.

    Only rows whose fingerprint occurs more than once have their texts compared: copies within a task
    are summed before the shuffle, so a hot group sends one row per task. Rows then find their group by
    fingerprint and SHA-256; should two verified texts ever share both, the job fails.
    """
    rows = stage(digests(docs))
    again = stage(repeated_fingerprints(rows))
    suspects = rows.join(again, "print", "left_semi").select(F.col("doc_id").alias("__id")).distinct()
    texts = docs.select("doc_id", "text").join(suspects, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    best = F.min(F.struct((-F.col("n_points")).alias("order"), "doc_id")).alias("best")
    verified = digests(texts, with_text=True).groupBy("print", "text_sha256", "bare").agg(F.count(F.lit(1)).alias("n"), best)
    groups = (
        verified.groupBy("print", "text_sha256")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"), F.min("best").alias("best"))
        .withColumn("n", F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts share fingerprint and SHA-256"))))
    )
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return rows.join(groups, ["print", "text_sha256"], "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    It is the row that `exact_duplicates` keeps; of rows that repeat both doc_id and text, one.
    """
    rows, key = blocks.keyed(docs), blocks.row_key(docs)
    # The key tells the rows apart and comes last, so it only decides between rows of one doc_id.
    named = rows.select(F.struct("doc_id", key).alias("doc_id"), "text")
    return blocks.without(rows, exact_duplicates(named).where(~F.col("kept")).select(f"doc_id.{key}"), key)


SQL = """
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare FROM documents
), best AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n_points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM best
"""
