"""Hashed character n-grams of whole texts, and the split that classifiers learn from. Shared by them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from indexloom.llm import blocks

BLOCK_BYTES = 1 << 20
# Characters whose n-grams are looked at together.
SEGMENT = 1 << 16
HELD_OUT = 2


def held_out(doc_id: Column) -> Column:
    """True for rows that no classifier learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def segments(texts: list[str | None], pad: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased code points of all texts, some SEGMENT at a time: row, points, starts, ends.

    A segment belongs to the text `row`, its n-grams begin from `starts` to before `ends`. It is followed by the `pad`
    characters that come next in the text, zeros after its end. A long text has several segments, so what is
    worked on does not grow with it; an empty one has none.
    """
    rows: list[int] = []
    held: list[str] = []
    own: list[int] = []

    def given() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(h) for h in held], np.int64)
        points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        return np.array(rows, np.int64), points, starts, starts + np.array(own, np.int64)

    for row, text in enumerate(texts):
        lowered = (text or "").lower()
        for a in range(0, len(lowered), SEGMENT):
            part = lowered[a : a + SEGMENT]
            ahead = lowered[a + SEGMENT : a + SEGMENT + pad]
            if held and sum(own) + len(part) > SEGMENT:
                yield given()
                rows, held, own = [], [], []
            rows.append(row)
            own.append(len(part))
            held.append(part + ahead + "\0" * (pad - len(ahead)))
    if held:
        yield given()


def features(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The hashed n-gram that begins at each character, as a number below 2 ** bits."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mixed = np.full(n, 0x9E3779B1 * order & 0xFFFFFFFF, np.uint32)
    for j in range(order):
        mixed ^= points[j : j + n]
        mixed *= np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0xC2B2AE35)
    return (mixed >> np.uint32(32 - bits)).astype(np.int64)


def presence(texts: list[str | None], orders: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Groups of texts as a table of which feature occurs in which: first text of the group, rows of flags."""
    group = 64
    for i in range(0, len(texts), group):
        table = np.zeros((len(texts[i : i + group]), 1 << bits), bool)
        for row, points, starts, ends in segments(texts[i : i + group], max(orders)):
            rows = np.repeat(row, ends - starts)
            places = blocks.ragged(starts, ends - starts)
            for order in orders:
                table[rows, features(points, order, bits)[places]] = True
        yield i, table


def text_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in blocks.text_blocks(batches, "text", BLOCK_BYTES):
        yield batch, batch.column("text").to_pylist()
