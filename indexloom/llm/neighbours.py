"""Nearest neighbours by cosine: multi-probe p-stable hashing and exact reranking."""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks
from indexloom.session import stage

TABLES, FUNCTIONS, CELL_WIDTH, PROBES = 12, 8, 2.0, 60
# Vectors of one bucket that are compared in one piece; larger buckets have several.
PIECE_ROWS = 5000
# Cells of each table that are searched first, to know from which score on a vector can still matter.
FIRST_PROBES = 2
_PAIRS = 1 << 18


@functools.cache
def _hash_functions(dimension: int, tables: int, functions: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and offsets of all tables, the same wherever they are made."""
    rng = np.random.default_rng(dimension)
    return rng.standard_normal((dimension, tables * functions)), rng.random(tables * functions) * width


@functools.cache
def probe_sequence(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of boundaries to step over, the likeliest to hold a neighbour first.

    Boundary j is the j-th nearest of the 2 * functions cell boundaries around a query. The expected
    squared distance to it is known without data, the sum over a set is its cost, and a heap yields the
    sets by cost; a set with both sides of one function is none.
    """
    m = functions
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < probes:
        total, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - j not in chosen for j in chosen):
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return found


def _vectors(column: pa.Array | pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and vectors of each length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    return [(rows := np.flatnonzero(sizes == n), flat[starts[rows][:, None] + np.arange(n)]) for n in np.unique(sizes)]


def _bucket_keys(cells: np.ndarray, dimension: int) -> np.ndarray:
    """One number per table for the cells (rows, tables, functions) of a vector."""
    key = np.zeros(cells.shape[:2], np.uint64) + np.arange(cells.shape[1], dtype=np.uint64) + np.uint64(dimension << 32)
    for j in range(cells.shape[2]):
        key = blocks.mix64(key ^ cells[:, :, j].astype(np.int64).view(np.uint64))
    return key.view(np.int64)


def _hashed(tables: int, functions: int, width: float, probes: int):
    """Rows (bucket, nth, id, vector): for each table the cells that the first `probes` steps lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in _vectors(batch.column("vector")):
                directions, offsets = _hash_functions(vectors.shape[1], tables, functions, width)
                places = ((vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ directions + offsets) / width
                places = places.reshape(len(rows), tables, functions)
                cells = np.floor(places)
                below = places - cells
                by_distance = np.argsort(np.concatenate([below, 1 - below], axis=2), axis=2, kind="stable")
                keys = []
                for steps in probe_sequence(functions, probes):
                    moved = cells.copy()
                    for j in steps:
                        side = by_distance[:, :, j]
                        at = np.indices(side.shape)
                        moved[at[0], at[1], side % functions] += np.where(side < functions, -1, 1)
                    keys.append(_bucket_keys(moved, vectors.shape[1]))
                every = np.concatenate(keys, axis=1)
                nth = np.tile(np.repeat(np.arange(len(keys)), tables), len(rows))
                take = pa.array(np.repeat(rows, every.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(every.ravel()), pa.array(nth), batch.column("id").take(take), batch.column("vector").take(take)], names=["bucket", "nth", "id", "vector"])

    return run


def _best(k: int):
    """Compares queries and vectors that share a cell; keeps the k best different vectors of each query.

    A score below a query's `least`, or below its k-th best so far, is dropped at once.
    """

    def reduced(query: np.ndarray, vector: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((vector, query))
        query, vector, score = query[order], vector[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (vector[1:] != vector[:-1])
        query, vector, score = query[new], vector[new], score[new]
        order = np.lexsort((vector, -score, query))
        query, vector, score = query[order], vector[order], score[order]
        opens = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(opens, np.diff(np.append(opens, len(query))))
        return query[rank < k], vector[rank < k], score[rank < k]

    def run(index: pa.Table, probes: pa.Table) -> pa.Table:
        ids = index.column("id").to_numpy(), probes.column("id").to_numpy()
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        held, waiting = [], 0
        if index.num_rows and probes.num_rows:
            of_length = {v.shape[1]: (rows, v) for rows, v in _vectors(probes.column("vector"))}
            cells = index.column("cell").to_numpy(), probes.column("cell").to_numpy()
            for rows, vectors in _vectors(index.column("vector")):
                if vectors.shape[1] not in of_length:
                    continue
                q_rows, queries = of_length[vectors.shape[1]]
                v_order, q_order = np.argsort(cells[0][rows], kind="stable"), np.argsort(cells[1][q_rows], kind="stable")
                v_cell, q_cell = cells[0][rows][v_order], cells[1][q_rows][q_order]
                own, number = np.unique(ids[1][q_rows], return_inverse=True)
                least = np.full(len(own), -np.inf)
                np.maximum.at(least, number, probes.column("least").fill_null(-np.inf).to_numpy()[q_rows])
                v_norm, q_norm = np.linalg.norm(vectors, axis=1), np.linalg.norm(queries, axis=1)
                opens = np.flatnonzero(np.concatenate([[True], q_cell[1:] != q_cell[:-1]]))
                firsts, lasts = np.searchsorted(v_cell, q_cell[opens]), np.searchsorted(v_cell, q_cell[opens], "right")
                for a, b, i, j in zip(opens.tolist(), [*opens[1:].tolist(), len(q_cell)], firsts.tolist(), lasts.tolist(), strict=True):
                    if i == j:
                        continue
                    q, v = q_order[a:b], v_order[i:j]
                    score = np.einsum("ij,kj->ik", queries[q], vectors[v]) / (q_norm[q][:, None] * v_norm[v])
                    x, y = np.nonzero(score >= least[number[q]][:, None])
                    held.append((ids[1][q_rows[q[x]]], ids[0][rows[v[y]]], score[x, y]))
                    waiting += len(x)
                    if waiting > _PAIRS:
                        found = reduced(*(np.concatenate(c) for c in zip(found, *held, strict=True)))
                        held, waiting = [], 0
                        times = np.bincount(at := np.searchsorted(own, found[0][mine := np.isin(found[0], own)]), minlength=len(own))
                        lowest = np.full(len(own), np.inf)
                        np.minimum.at(lowest, at, found[2][mine])
                        least = np.where(times >= k, np.maximum(least, lowest), least)
        if held:
            found = reduced(*(np.concatenate(c) for c in zip(found, *held, strict=True)))
        return pa.table({"query_id": found[0], "class_id": found[1], "score": found[2]})

    return run


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not all zero."""
    value = vector.cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(value, lambda x: x != 0), F.lit(False))


def nearest(
    rows: DataFrame, is_query: Column, k: int = 5, tables: int = TABLES, functions: int = FUNCTIONS,
    width: float = CELL_WIDTH, probes: int = PROBES, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest other rows of each query row by cosine: query_id, rank, vec_id, score.

    Ids are whole numbers and name rows. A row whose id or vector is null, or whose vector has a null or
    non-finite component or is zero, takes no part; vectors of different lengths are not compared. Ties
    go to the smaller id. Fewer than k others give fewer rows, an empty table gives none.

    Equal vectors are one class, of which k + 1 ids are kept, so copies do not crowd a bucket. Each
    class is put into one bucket of each table: the cell it falls into under `functions` Gaussian
    projections of the unit vector. A query visits `probes` cells of each table, from its own outwards in
    order of estimated success; the k + 1 best of its first cells tell which later ones it need not
    report. What it finds is scored on the original vectors, and the best of
    all tables are merged. Buckets of more than PIECE_ROWS are searched in pieces. A query that finds
    fewer than k is compared with all rows, in blocks.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    good = blocks.for_tasks(rows).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    copies = Window.partitionBy("vector").orderBy("id")
    # The filter on the row number reaches the tasks before the shuffle, so a hot vector sends few rows.
    members = stage(good.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).withColumn("class_id", F.first("id").over(copies)))
    classes = members.where("copy = 1").select("id", "vector")
    queries = stage(good.where("asks").select("id", "vector"))
    hashed = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("nth", T.LongType()), T.StructField("id", T.LongType()), rows.select(F.col(vector_col).alias("vector")).schema["vector"]])
    index = stage(classes.mapInArrow(_hashed(tables, functions, width, 1), hashed))
    visits = queries.mapInArrow(_hashed(tables, functions, width, probes), hashed)
    sizes = stage(index.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PIECE_ROWS).cast("int").alias("pieces")))
    piece = F.pmod(F.xxhash64("id"), F.coalesce("pieces", F.lit(1)))
    placed = index.join(sizes.where("pieces > 1"), "bucket", "left").withColumn("cell", F.xxhash64("bucket", piece.cast("int")))
    # The planner takes the visits for as small as the queries they come from, and would broadcast them.
    asked = visits.join(sizes.hint("merge"), "bucket").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("cell", F.xxhash64("bucket", F.col("piece").cast("int")))
    nearby = stage(_search(placed, asked.where(F.col("nth") < FIRST_PROBES).withColumn("least", F.lit(None).cast("double")), partitions, k + 1))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    least = nearby.distinct().withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k + 1).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    further = asked.where(F.col("nth") >= FIRST_PROBES).join(stage(least).hint("merge"), "id", "left")
    found = stage(nearby.unionByName(_search(placed, further, partitions, k + 1)))
    enough = found.distinct().groupBy("query_id").count().where(F.col("count") > k).select(F.col("query_id").alias("id"))
    short = stage(queries.join(enough, "id", "left_anti"))
    every = F.pmod(F.xxhash64("id"), F.lit(partitions))
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(partitions - 1).cast("long")))
    scanned = _search(classes.withColumn("cell", every.cast("long")), short.withColumn("cell", all_blocks).withColumn("least", F.lit(None).cast("double")), partitions, k + 1)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class_id")
    top = found.unionByName(scanned).distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        top.join(members.select("class_id", F.col("id").alias("vec_id")), "class_id").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _search(index: DataFrame, probes: DataFrame, partitions: int, k: int) -> DataFrame:
    """Best k of each query among the vectors it shares a cell with; cells are dealt into groups."""
    part = F.pmod(F.xxhash64("cell"), F.lit(4 * partitions)).alias("part")
    left = index.select("cell", "id", "vector", part).groupBy("part")
    right = probes.select("cell", "id", "vector", "least", part).groupBy("part")
    return left.cogroup(right).applyInArrow(_best(k), "query_id long, class_id long, score double")
