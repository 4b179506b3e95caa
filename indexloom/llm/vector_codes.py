"""Vector codes: each part of a vector as the number of its nearest codebook entry, by tries of parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks
from indexloom.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Components stay within this, so that squared distances and their sums are exact in 64 bits.
LIMIT = 1 << 27
# Integers of the vectors that one block and its tries cover, in bytes; leaves whose distances are held at once.
BLOCK_BYTES, LEAVES = 2 << 20, 4096


def complete(vector: str) -> Column:
    """True for a vector that is there and has finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def part_bounds(dimension: int, parts: int) -> list[int]:
    return [dimension * p // parts for p in range(parts + 1)]


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * scale), -LIMIT, LIMIT).astype(np.int32)


def _edge(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """What the dimensions of an edge add to the squared distance from each entry, per row of `x`."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def walk(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the first of equals) and squared distance of each of `parts`: different rows in order.

    Rows in lexicographic order are the leaves of a trie, whose inner nodes are the prefixes at which
    neighbours part. It is walked depth first with a stack of its own. A node carries the distances of
    all entries over its prefix, so what a prefix adds is computed once for all below it; an edge may
    span several dimensions. The leaves of one node are finished together. All sums are of whole
    numbers: in double precision where they stay exact in it, else in 64 bits.
    """
    n, width = parts.shape
    nearest, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return nearest, distance
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if largest < 1 << 20 and width < 1 << 11 else np.int64
    x, c = parts.astype(kind), entries.astype(kind)
    # How many leading dimensions each row shares with the one before.
    shared = np.concatenate([[0], (parts[1:] != parts[:-1]).argmax(axis=1)]) if width else np.zeros(n, np.int64)
    stack = [(0, n, 0, np.zeros(len(c), kind))]
    while stack:
        first, last, depth, sums = stack.pop()
        if last - first == 1:
            branch, opens, closes = depth, np.array([first]), np.array([last])
        else:
            branch = int(shared[first + 1 : last].min())
            cuts = first + 1 + np.flatnonzero(shared[first + 1 : last] == branch)
            opens, closes = np.append(first, cuts), np.append(cuts, last)
        if branch > depth:
            sums = sums + _edge(x[first : first + 1, depth:branch], c[:, depth:branch])[0]
        alone = closes - opens == 1
        leaves = opens[alone]
        for i in range(0, len(leaves), LEAVES):
            rows = leaves[i : i + LEAVES]
            upto = sums + _edge(x[rows, branch:], c[:, branch:])
            nearest[rows] = upto.argmin(axis=1)
            distance[rows] = upto[np.arange(len(rows)), nearest[rows]].astype(np.int64)
        stack += [(a, b, branch, sums) for a, b in zip(opens[~alone].tolist()[::-1], closes[~alone].tolist()[::-1], strict=True)]
    return nearest, distance


def _different(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different rows in lexicographic order, the place of each row among them, and how often each occurs."""
    n, width = part.shape
    if not n or not width:
        return part[:1], np.zeros(n, np.int64), np.full(min(n, 1), n)
    # Big-endian with the sign turned: bytes that sort as the numbers do.
    keys = np.ascontiguousarray((part.astype(np.int64) + (1 << 31)).astype(">u4")).view(f"S{4 * width}").ravel()
    _, first, place, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return part[first], place, times


def _block_rows(scale: int, bounds: list[int], id_type: pa.DataType, label_type: pa.DataType):
    width = bounds[-1]
    rows_held = max(1, BLOCK_BYTES // (4 * max(width, 1)))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1).cast(pa.large_list(pa.float64()))
        sizes = np.diff(lists.offsets.to_numpy())
        fits = sizes == width
        values = lists.flatten().to_numpy(zero_copy_only=False)[np.repeat(fits, sizes)].reshape(int(fits.sum()), width)
        numbers = whole_numbers(values, scale)
        parts = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            rows, place, times = _different(numbers[:, a:b])
            places = np.full(len(sizes), -1, np.int32)
            places[fits] = place
            parts.append({"rows": blocks.packed(rows.ravel()), "n": len(rows), "times": blocks.packed(times.astype(np.uint32)), "places": blocks.packed(places)})
        return pa.RecordBatch.from_pydict({
            "ids": pa.array([batch.column(0).to_pylist()], pa.list_(id_type)),
            "labels": pa.array([batch.column(2).to_pylist()], pa.list_(label_type)),
            "parts": pa.array([parts], pa.list_(pa.struct([("rows", pa.binary()), ("n", pa.int64()), ("times", pa.binary()), ("places", pa.binary())]))),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, rows_held):
                held.append(batch.slice(i, rows_held))
                n += held[-1].num_rows
                if n >= rows_held:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def _unpacked(part: dict, width: int) -> np.ndarray:
    return blocks.unpacked(part["rows"], np.int32).reshape(part["n"], width)


def _sums(codebooks: list[np.ndarray]):
    """Per slot of the codebooks the sum over the parts assigned to it; the last slot of an entry counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
        for batch in batches:
            for row in batch.column("parts"):
                for part, c, into in zip(row.as_py(), codebooks, sums, strict=True):
                    rows, times = _unpacked(part, c.shape[1]), blocks.unpacked(part["times"], np.uint32).astype(np.int64)
                    nearest, _ = walk(rows, c)
                    weighted = np.hstack([rows * times[:, None], times[:, None]])
                    np.add.at(into, nearest, weighted)
        flat = np.concatenate([s.ravel() for s in sums])
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(flat[slots])], names=["slot", "total"])

    return run


def _codes(codebooks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column("ids").slice(i, 1).flatten(), batch.column("labels").slice(i, 1).flatten()
                code, error, fits = np.zeros((len(ids), len(codebooks)), np.uint8), np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
                for p, (part, c) in enumerate(zip(batch.column("parts")[i].as_py(), codebooks, strict=True)):
                    nearest, distance = walk(_unpacked(part, c.shape[1]), c)
                    places = blocks.unpacked(part["places"], np.int32)
                    fits = places >= 0
                    code[fits, p], error[fits] = nearest[places[fits]], error[fits] + distance[places[fits]]
                text = code.tobytes().hex()
                step = 2 * len(codebooks)
                texts = [text[k * step : (k + 1) * step] if fit else None for k, fit in enumerate(fits.tolist())]
                yield pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string()), pa.array(error, mask=~fits), labels], names=["id", "code", "error", "label"])

    return run


def codebooks_sha256(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal numbers joined by commas, by part, entry and place in the part."""
    return hashlib.sha256(",".join(map(str, np.concatenate([np.zeros(0, np.int64), *(c.ravel() for c in codebooks)]).tolist())).encode()).hexdigest()


def quantize(vectors: DataFrame, id_column: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of the complete vectors and the codebooks: (id, code, error, label, label_error), one array per part.

    Components become floor(scale * x), vectors are cut into `parts` consecutive parts (equal ones, if
    the dimension allows). A part's codebook, of at most 256 entries, starts as that part of the first vectors by id
    (null last, then by the vector itself). In each round every part goes to its nearest entry (squared
    distance, ties to the lower number) and each entry becomes the floor of the mean of its parts; one without
    parts stays. `code` has two hex digits per part, `error` is the sum of the final squared distances,
    `label_error` their sum over all rows of a label, null labels together.

    Vectors that are null or hold null or non-finite components are left out. Components beyond 2**27 in
    size after scaling count as 2**27, so that all sums are exact. A vector of another length than the
    first one's keeps its row, with null code and error. Repeated rows and ids count each, a null id
    is kept, fewer vectors than entries give a smaller codebook, no rows give no rows, other columns are not looked at.

    The vectors are read once and written as blocks: per part position the different parts of the block,
    sorted, with how often each occurs, and where each vector's part is among them. Every round walks
    one trie per block and position (`walk`) and sends only sums per codebook entry, so vectors are never shuffled
    and equal vectors cost one leaf per block. The driver holds the codebooks and their sums, whose size
    depends on `entries` and the dimension alone.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = vectors.where(complete(vector)).select(F.col(id_column).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    first = [r["vector"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()]
    bounds = part_bounds(len(first[0]) if first else 0, parts)
    alike = [v for v in first if len(v) == bounds[-1]]
    alike = np.array(alike, np.float64).reshape(len(alike), bounds[-1])
    codebooks = [whole_numbers(alike, scale)[:, a:b].astype(np.int64) for a, b in zip(bounds, bounds[1:], strict=False)]
    id_type, label_type = rows.schema["id"].dataType, rows.schema["label"].dataType
    blob = T.BinaryType()
    part_rows = T.ArrayType(T.StructType([T.StructField("rows", blob), T.StructField("n", T.LongType()), T.StructField("times", blob), T.StructField("places", blob)]))
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)), T.StructField("parts", part_rows)])
    arrow = pa.schema(_arrow_fields(rows))
    held = stage(rows.mapInArrow(_block_rows(scale, bounds, arrow.field("id").type, arrow.field("label").type), schema))
    for _ in range(rounds):
        totals = held.select("parts").mapInArrow(_sums(codebooks), "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total"))
        # One row per number of the codebooks and one count per entry.
        codebooks = _moved(codebooks, {r["slot"]: r["total"] for r in totals.collect()})
    coded = T.StructType([T.StructField("id", id_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("label", label_type)])
    codes = stage(held.mapInArrow(_codes(codebooks), coded))
    by_label = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label"), codebooks


def _arrow_fields(rows: DataFrame) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field(f.name, to_arrow_type(f.dataType)) for f in rows.schema if f.name != "vector"]


def _moved(codebooks: list[np.ndarray], totals: dict[int, int]) -> list[np.ndarray]:
    """Each entry at the floor of the mean of its parts."""
    moved, slot = [], 0
    for c in codebooks:
        n, width = c.shape
        sums = np.array([totals.get(slot + i, 0) for i in range(n * (width + 1))], np.int64).reshape(n, width + 1)
        slot += n * (width + 1)
        times = sums[:, -1:]
        moved.append(np.where(times > 0, sums[:, :-1] // np.maximum(times, 1), c))
    return moved


def _sql() -> str:
    """The same rows by plain joins of all parts with all entries."""
    rounds = []
    distance = "list_inner_product(part, part) - 2 * list_inner_product(part, entry) + list_inner_product(entry, entry)"
    for r in range(ROUNDS + 1):
        rounds.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(part) AS part, min(d) AS d, arg_min(e, d * {ENTRIES} + e) AS e
  FROM (SELECT vec_id, p, part, e, {distance} AS d FROM parts JOIN c{r} USING (p)) GROUP BY vec_id, p
)""")
        if r < ROUNDS:
            rounds.append(f"""m{r} AS (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS entry
  FROM (SELECT p, e, i, sum(x::BIGINT)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e
), c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.entry, c.entry) AS entry FROM c{r} c LEFT JOIN m{r} m ON c.p = m.p AND c.e = m.e
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, v[(len(v) * p // {PARTS} + 1) : (len(v) * (p + 1) // {PARTS})] AS part FROM kept, range({PARTS}) AS t(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS entry FROM parts QUALIFY e < {ENTRIES}
), {", ".join(rounds)}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS books
  FROM (SELECT p, e, unnest(entry) AS x, generate_subscripts(entry, 1) AS i FROM c{ROUNDS})
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, books AS codebooks_sha256
FROM kept JOIN coded USING (vec_id), books
"""


SQL = _sql()
