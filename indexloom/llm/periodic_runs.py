"""Periodic runs of words: squares caught by blocks of two-power length, merged into runs."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from indexloom.llm import blocks

MIN_LENGTH, MIN_EXPONENT = 24, 3
# Text worked on together, and the piece of a long text whose words are strings at once, in bytes.
BLOCK_BYTES, PIECE_BYTES = 1 << 20, 1 << 22
# Comparisons of one step.
STEP = 1 << 21
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size. White space is space and U+0009 to U+000D."""
    at = 0
    while at < len(text):
        cut = _WHITE.search(text, at + PIECE_BYTES)
        end = cut.end() if cut else len(text)
        # bytes.split() splits at exactly these six bytes.
        yield text[at:end].split()
        at = end


class _Found:
    """Runs found so far: (start, end) to period, and for a place the run that reaches furthest from before it."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}
        self.starts = self.ends = self.periods = np.zeros(0, np.int64)

    def add(self, runs: list[tuple[int, int, int]]) -> None:
        for start, end, period in runs:
            # Shorter periods come first; a multiple of one spans the same words.
            self.period.setdefault((start, end), period)
        if runs:
            rows = np.array([(a, b, p) for (a, b), p in self.period.items()], np.int64)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            furthest = np.maximum.accumulate(rows[:, 1])
            best = np.maximum.accumulate(np.where(rows[:, 1] == furthest, np.arange(len(rows)), 0))
            self.starts, self.ends, self.periods = rows[:, 0], rows[best, 1], rows[best, 2]

    def reaching(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End and period of that run; 0 and 1 where there is none."""
        at = np.searchsorted(self.starts, places, "right") - 1
        if not len(self.starts):
            return np.zeros(len(places), np.int64), np.ones(len(places), np.int64)
        return np.where(at >= 0, self.ends[at], 0), np.where(at >= 0, self.periods[at], 1)


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values two sequences share."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at : min(n, at + step)] != b[at : min(n, at + step)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return n


def _catch(words: np.ndarray, hashes: np.ndarray, block: int, low: int, high: int, needed, text_end: np.ndarray, found: _Found) -> list[tuple[int, int, int]]:
    """Runs whose period is from `low` to below `high`, by the catchers of one block length.

    The catcher of block m opens when word (m + 1) * block - 1 has come. Each word that is appended after that
    completes a suffix of `block` words; if it equals the block at a distance in the range, the words between
    them may be a square's root. All catchers of a length take their next words in one step. Catchers side
    by side that catch at the same distance belong to one run. A catcher that lies with all its words in a run
    of a period up to `block` sleeps: what it could catch are multiples of that period.
    """
    n, width = len(words), high - low
    n_rows = (n - block - low) // block + 1
    if n_rows <= 0:
        return []
    starts = np.arange(n_rows) * block
    end, period = found.reaching(starts)
    asleep = (end >= starts + high - 1 + block) & (period <= block) & (period < low)
    # Blocks that each run of such a period covers in its first part, at least.
    least = max(1, (min(needed(low), needed(high - 1)) - (block - 1)) // block)
    padded = np.concatenate([hashes, np.zeros(n_rows * block + high - len(hashes), np.uint64)]) if n_rows * block + high > len(hashes) else hashes
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[low::block]
    own = hashes[::block]
    step = max(4 * least, STEP // width)
    caught = []
    for first in range(0, n_rows, step):
        rows = slice(first, min(n_rows, first + step + least - 1))
        if asleep[rows].all():
            continue
        same = windows[rows] == own[rows, None]
        same[asleep[rows]] = False
        # Only where `least` neighbours catch at one distance.
        for _ in range(least - 1):
            same = same[:-1] & same[1:] if len(same) > 1 else same[:0]
        row, distance = np.nonzero(same)
        caught.append(np.stack([distance + low, row + first]))
    if not caught:
        return []
    distance, row = np.concatenate(caught, axis=1)
    place = row * block
    # Block and copy in one text, and not both inside a run of a period that divides the distance.
    inside = place + distance + least * block <= text_end[place] if len(place) else np.zeros(0, bool)
    end, period = found.reaching(place)
    new = inside & ~((end >= place + distance + least * block) & (distance % period == 0) & (period < distance))
    distance, row = distance[new], row[new]
    order = np.lexsort((row, distance))
    distance, row = distance[order], row[order]
    opens = np.flatnonzero(np.concatenate([[True], (np.diff(distance) != 0) | (np.diff(row) > 1)])) if len(row) else np.zeros(0, int)
    closes = np.append(opens[1:], len(row)) - 1
    runs = []
    for q, a, b in zip(distance[opens].tolist(), (row[opens] * block).tolist(), ((row[closes] + least) * block if len(row) else row).tolist(), strict=True):
        left = a - _equal(words[:a][::-1], words[: a + q][::-1])
        right = b + _equal(words[b:], words[b + q :])
        # Hashes proposed the blocks; the words decide.
        parted = np.flatnonzero(words[a:b] != words[a + q : b + q]) + a
        edges = [left - 1, *parted.tolist(), right]
        for x, y in zip(edges, edges[1:], strict=False):
            if y - x - 1 >= needed(q):
                runs.append((x + 1, y + q, q))
    return runs


def find_runs(texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, a text being its words as numbers: (start, length, period) by start and period.

    A run is a stretch whose smallest period is `period`, at least `min_length` words and `min_exponent` (two or
    more) periods long, that no neighbouring word extends. Texts are laid side by side, each closed by a number of its own,
    longest first, so that longer blocks only look at the texts that can hold them.

    A run of period q starts with a stretch of words that equal those q later. Any stretch of 2b - 1 words
    holds a whole block of b, so with blocks of half the smallest root, and shorter ones for the shortest, every run is caught.
    Hashes of blocks double from one length to the next. The work is in proportion to the words times the
    logarithm of the longest text.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.full(bounds[-1], -1, np.int64)
    for at, i in zip(bounds.tolist(), order, strict=False):
        words[at : at + len(texts[i])] = texts[i]
    words[bounds[1:] - 1] = -1 - np.arange(len(order))
    text_end = np.repeat(bounds[1:] - 1, sizes + 1)

    def needed(q: int) -> int:
        """Words of a run that equal the ones q later."""
        return max(min_length - q, (min_exponent - 1) * q)

    shortest = min(needed(q) for q in range(1, max(2, min_length) + 1))
    block = 1
    while 2 * (2 * block) - 1 <= shortest:
        block *= 2

    def active(period: int) -> int:
        """Up to where the texts reach that can hold a run of this period."""
        return int(bounds[np.searchsorted(-sizes, -max(min_length, min_exponent * period), "right")])

    found = _Found()
    hashes = blocks.mix64(words.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    length = 1

    def doubled(hashes: np.ndarray, length: int) -> np.ndarray:
        return blocks.mix64(hashes[: len(hashes) - length] * np.uint64(0xD6E8FEB86659FD93) + hashes[length:])

    while length < block and len(hashes) > length:
        hashes, length = doubled(hashes, length), 2 * length
    if length == block:
        for q in range(1, 4 * block):
            n = active(q)
            if n:
                found.add(_catch(words[:n], hashes[: max(0, n - block + 1)], block, q, q + 1, needed, text_end, found))
        while n := active(4 * block):
            hashes = doubled(hashes[: n - block + 1], block)
            block *= 2
            found.add(_catch(words[:n], hashes, block, 2 * block, 4 * block, needed, text_end, found))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, end), period in found.period.items():
        at = int(np.searchsorted(bounds, start, "right")) - 1
        runs[order[at]].append((start - int(bounds[at]), end - start, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when each run is cut to its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


def _run(min_length: int, min_exponent: int):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.larger_blocks(batches, "text", BLOCK_BYTES):
            data, bounds = blocks.as_bytes(batch.column("text"))
            texts = [data[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
            # Words are told apart by their bytes: equal numbers are equal words.
            numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
            words = [
                np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(numbers.__getitem__, piece), np.int64, len(piece)) for piece in word_pieces(text))])
                for text in texts
            ]
            del numbers
            found = find_runs(words, min_length, min_exponent)
            collapsed = []
            for text, runs, n in zip(texts, found, map(len, words), strict=True):
                kept, at, parts = _kept(n, runs) if runs else None, 0, []
                for piece in word_pieces(text):
                    left = piece if kept is None else list(itertools.compress(piece, kept[at : at + len(piece)].tolist()))
                    at += len(piece)
                    if left:
                        parts.append(b" ".join(left))
                collapsed.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(list(map(len, words)), pa.int64()),
                pa.array([[{"start": s, "length": m, "period": p} for s, m, p in runs] for runs in found], run_type),
                pa.array(collapsed, pa.binary()).view(pa.string()),
            ], names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Runs of words in every whole text: doc_id, n_words, runs (start, length, period), collapsed.

    Words are maximal runs of characters other than space and U+0009 to U+000D, numbered from 0. A run is a
    stretch of words with smallest period `period`, at least `min_length` words and `min_exponent` periods long,
    that no neighbouring word extends. Runs are listed by start and period. `collapsed` is the text without the words
    that any run holds after its first period, the rest joined by single spaces.

    A null or empty text has no words, no runs and an empty `collapsed`. Rows are judged by their text
    alone, repeated ones alike; a null doc_id is kept, no rows give no rows, other columns are not looked at. Nothing
    is shuffled. A task holds texts of a megabyte together, or one longer text: some 40 bytes per word of it.
    """
    if min_exponent < 2:
        raise ValueError("a run holds two periods at least")
    longs = T.LongType()
    run_type = T.ArrayType(T.StructType([T.StructField(c, longs) for c in ("start", "length", "period")]))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", longs), T.StructField("runs", run_type), T.StructField("collapsed", T.StringType())])
    return blocks.for_tasks(docs).select("doc_id", "text").mapInArrow(_run(min_length, min_exponent), schema)


# By a join of all pairs of equal words of a text, in place of catchers; it also writes the repeats that the query plants.
SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS steps
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS t(i))
), split AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                         lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, crc
), sized AS MATERIALIZED (
  SELECT k, doc_id, words, len(words) AS n, h % 10 = 0 AS planted, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a, (h // 10) % 8 AS g FROM split
), words AS MATERIALIZED (
  SELECT k, n, i, words[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g)) ELSE i END] AS word
  FROM sized, LATERAL (SELECT unnest(range(n)) AS i)
), pairs AS (
  SELECT x.k, y.i - x.i AS q, x.i AS i FROM words x JOIN words y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT k, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pairs) GROUP BY k, q, island
), runs AS MATERIALIZED (
  SELECT k, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY k, start, length
), gone AS (
  SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
  SELECT w.k, string_agg(word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN gone g ON w.k = g.k AND w.i = g.i GROUP BY w.k
), told AS (
  SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY k
), best AS (
  SELECT x.* FROM runs x ANTI JOIN runs y ON x.k = y.k AND (y.length * x.period > x.length * y.period
    OR (y.length * x.period = x.length * y.period AND (y.start < x.start OR (y.start = x.start AND y.period < x.period))))
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM sized LEFT JOIN told USING (k) LEFT JOIN best USING (k) LEFT JOIN collapsed USING (k)
"""
