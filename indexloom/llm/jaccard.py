"""Near duplicates: documents linked by the Jaccard similarity of their word shingles, by PartEnum."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.llm import blocks
from indexloom.llm.components import components
from indexloom.session import stage

SHARD_BYTES = 4 << 20


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every shingle of `size` words, in order of the texts; letters A-Z count as a-z.

    A text with fewer words gives one shingle of all of them, one without words gives none.
    """
    starts, ends, before = blocks.words(data, bounds)
    word = blocks.span_hashes(blocks.LOWER[data], starts, ends)
    factors = blocks.mix64(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n_words = np.diff(before)
    sums = np.zeros(max(0, len(word) - size + 1), np.uint64)
    for j in range(size):
        sums += word[j : j + len(sums)] * factors[j]
    n_full = np.maximum(n_words - size + 1, 0)
    full = blocks.mix64(sums[blocks.ragged(before[:-1], n_full)])
    document = np.repeat(np.arange(len(n_words)), n_full)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if not len(short):
        return full, document
    # Few words: the same sum over what is there, told apart by how many there are.
    part = blocks.ragged(before[short], n_words[short])
    place = blocks.ragged(np.zeros(len(short), np.int64), n_words[short])
    opens = np.cumsum(n_words[short]) - n_words[short]
    whole = np.add.reduceat(word[part] * factors[place], opens)
    whole = blocks.mix64(whole + n_words[short].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    hashes, document = np.concatenate([full, whole]), np.concatenate([document, short])
    order = np.argsort(document, kind="stable")
    return hashes[order], document[order]


def size_bands(percent: int, largest: int) -> list[tuple[int, int]]:
    """Bands of set sizes, each as wide as the similarity allows: linked sets lie in one or in neighbours."""
    bands = [(1, 100 // percent)]
    while bands[-1][1] < largest:
        least = bands[-1][1] + 1
        bands.append((least, least * 100 // percent))
    return bands


def signatures(elements: np.ndarray, rarity: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """PartEnum signatures of one set: hash, tokens that follow it, tokens a partner must share, place, list.

    `list` names the set and the band, or that single elements are meant, and `place` counts within it.

    For its size band and the next one, the feature domain is partitioned by hash; a token is a
    partition that the set has elements in, with what it holds of it. Sets that are similar enough
    differ in at most k elements and so in at most k partitions. In one order of all tokens, rare ones
    first, the k + 1 first tokens of two such sets share one, so these are enumerated as signatures,
    without those that hold an element of `rarity` 0, which no other set has. A set that fills no more
    than k partitions, where that could fail, enumerates single elements as well.
    """
    size = len(elements)
    bands = size_bands(percent, size * 100 // percent)
    band = next(i for i, (low, high) in enumerate(bands) if low <= size <= high)
    hashes, after, needed, places, lists = [np.zeros(0, np.uint64)], *([np.zeros(0, np.int64)] for _ in range(4))
    for i in (band, band + 1):
        if i >= len(bands) or size * 100 // percent < bands[i][0]:
            continue
        partner = min(bands[i][1], size * 100 // percent)
        k = (100 - percent) * (size + partner) // (100 + percent)
        salt = np.uint64((i + 1) << 40)
        n_parts = np.uint64(1 + bands[i][1] * 9 // 20)
        mixed = blocks.mix64(elements ^ salt)
        part = mixed % n_parts
        order = np.lexsort((rarity, part))
        opens = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]]))
        held = np.add.reduceat(blocks.mix64(mixed)[order], opens)
        tokens = blocks.mix64(held ^ (salt + part[order][opens]))
        rare = rarity[order][opens]
        tokens = tokens[np.lexsort((tokens, rare))]
        n, alone = len(tokens), int((rare == 0).sum())
        found = tokens[alone : k + 1]
        hashes.append(found)
        places.append(np.arange(len(found)))
        lists.append(np.full(len(found), mixed.sum(dtype=np.uint64)).view(np.int64))
        after.append(n - 1 - alone - np.arange(len(found)))
        needed.append(np.full(len(found), n - k))
        if n <= k:
            single = blocks.mix64(mixed ^ np.uint64(0xD6E8FEB86659FD93))
            own = single.sum(dtype=np.uint64)
            single = single[np.lexsort((single, rarity))][int((rarity == 0).sum()) : size - -(-size * percent // 100) + 1]
            hashes.append(single)
            places.append(np.arange(len(single)))
            lists.append(np.full(len(single), own).view(np.int64))
            after.append(np.full(len(single), size))
            needed.append(np.zeros(len(single), np.int64))
    return np.concatenate(hashes).view(np.int64), np.concatenate(after), np.concatenate(needed), np.concatenate(places), np.concatenate(lists)


_KEEP = np.uint64(16)
SKETCH_WORDS = 16
# In 1024 cells the differences of sets of more elements drown, so these get a wider sketch as well. Where
# the larger of two linked sets has more, the smaller has at least `percent` of that, and one too.
WIDE_WORDS, WIDE_FROM = 64, 1024
# Signatures of a set before one of its own that tell whether two sets met at an earlier one.
EARLIER = 8


def parity_sketch(elements: np.ndarray, n_words: int = SKETCH_WORDS) -> np.ndarray:
    """Per hashed cell whether the set has an odd number of elements there, as 64-bit words.

    An element that only one of two sets has changes one cell, so the cells in which two sketches
    differ are never more than the elements in which the sets do.
    """
    cells = (blocks.mix64(elements ^ np.uint64(0x632BE59BD9B4E019)) % np.uint64(64 * n_words)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=64 * n_words).astype(np.uint8) & 1).view(np.int64)


def _pack_set(elements: np.ndarray) -> bytes:
    return blocks.packed(np.diff(elements, prepend=np.uint64(0)))


def _unpack_set(packed: bytes) -> np.ndarray:
    return np.cumsum(blocks.unpacked(packed, np.uint64), dtype=np.uint64)


class _Pairs:
    """The different (shingle, document) pairs of a shard in order of shingles.

    `at` is where each pair stood in what was given, `kinds` has the different shingles, `kind` the
    number of each pair's shingle, `sizes` the pairs of each document.
    """

    def __init__(self, hashes: np.ndarray, document: np.ndarray, n_documents: int, bits: int):
        order = np.argsort(hashes, kind="stable")
        hashes, document = hashes[order], document[order]
        opens = np.ones(len(hashes), bool)
        opens[1:] = hashes[1:] != hashes[:-1]
        pairs = opens.copy()
        pairs[1:] |= document[1:] != document[:-1]
        self.at, self.document, opens, self.bits = order[pairs], document[pairs], opens[pairs], bits
        self.kinds, self.kind = hashes[pairs][opens], np.cumsum(opens) - 1
        self.sizes = np.bincount(self.document, minlength=n_documents)
        self.held, self.cuts = blocks.stretches(blocks.bucket_of(self.kinds, bits))

    def to_buckets(self, shard: int) -> pa.Table:
        """Per bucket the shingles, as the 32 bits that follow the bucket's, and documents that have each."""
        documents = np.minimum(np.bincount(self.kind, minlength=len(self.kinds)), 65535).astype(np.uint16)
        short = ((self.kinds << np.uint64(self.bits)) >> np.uint64(32)).astype(np.uint32)
        parts = list(zip(self.cuts, self.cuts[1:], strict=False))
        return pa.table({
            "bucket": pa.array(self.held, pa.int64()), "shard": pa.array([shard] * len(self.held), pa.int64()),
            "shingles": pa.array([blocks.packed(np.diff(short[a:b], prepend=np.uint32(0))) for a, b in parts], pa.binary()),
            "documents": pa.array([blocks.packed(documents[a:b]) for a, b in parts], pa.binary()),
        })

    def classes(self, answers: pa.Table) -> np.ndarray:
        """The class of each pair's shingle, from what the buckets answered."""
        by_bucket = dict(zip(answers.column("bucket").to_pylist(), answers.column("classes").to_pylist(), strict=True))
        return np.concatenate([np.zeros(0, np.uint8), *(blocks.unpacked(by_bucket[b], np.uint8) for b in self.held)])[self.kind]


def _with_counts(rows: GroupedData, pairs_of: Callable[[pa.Table], _Pairs], pick: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType) -> DataFrame:
    """Tells each shard in how many documents of the corpus its shingles are, and lets it `pick`.

    A shingle's class is 0 for one document and one more for each doubling.
    """

    def send(table: pa.Table) -> pa.Table:
        return pairs_of(table).to_buckets(table.column("shard")[0].as_py())

    def count(table: pa.Table) -> pa.Table:
        found = [np.cumsum(blocks.unpacked(p, np.uint32), dtype=np.uint32) for p in table.column("shingles").to_pylist()]
        documents = np.concatenate([blocks.unpacked(p, np.uint16) for p in table.column("documents").to_pylist()])
        _, kind = np.unique(np.concatenate(found), return_inverse=True)
        classes = np.ceil(np.log2(np.bincount(kind, weights=documents))).astype(np.uint8)[kind]
        cuts = np.concatenate([[0], np.cumsum([len(f) for f in found])]).tolist()
        return pa.table({
            "bucket": table.column("bucket"), "shard": table.column("shard"),
            "classes": pa.array([blocks.packed(classes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        })

    sent = rows.applyInArrow(send, "bucket long, shard long, shingles binary, documents binary")
    counted = sent.groupBy("bucket").applyInArrow(count, "bucket long, shard long, classes binary")
    return rows.cogroup(counted.groupBy("shard")).applyInArrow(pick, schema)


def linked_documents(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Groups of near copies: doc_id, n_shingles, component_id (smallest doc_id reached by links).

    A text is the set of its different runs of `size` words (white space is space and U+0009 to U+000D,
    letters A-Z count as a-z); one with fewer words is its whole sequence, one without words or null
    is empty and linked with nothing. Two documents link when 100 * intersection >= percent * union.
    Rows that repeat a doc_id are told apart only by their texts, a null doc_id stays null, no rows
    give no rows, other columns are not looked at. Shingles are compared as 64-bit hashes, the sets of
    two documents as 48-bit ones.

    1. Shards send their different shingles to buckets, which answer how many documents have each.
       Only documents that share enough of their shingles with any other can have a link.
    2. Equal sets become one, and the same is asked again of the different sets. Those that share
       enough give PartEnum signatures, rare ones first.
    3. Each set is compared with the smallest and the largest id that share a signature, and what links
       becomes one component. Then all pairs that share a signature, are still in different components
       and that parity sketches do not rule out are compared, each taken at the first signature that
       they share (at few more where many others lie between). So a group of copies costs
       comparisons in proportion to its size, and no link between components is missed.
    """
    shards = blocks.in_shards(docs, SHARD_BYTES)
    bits = blocks.bucket_bits(docs)
    # Far fewer than the documents' shards would do for the sets; more only makes them smaller.
    n_shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_field = docs.schema["doc_id"]

    def of_texts(table: pa.Table) -> _Pairs:
        hashes, document = shingles(*blocks.as_bytes(table.column("text")), size)
        return _Pairs(hashes, document, table.num_rows, bits)

    def pick_texts(table: pa.Table, answers: pa.Table) -> pa.Table:
        pairs = of_texts(table)
        shared = np.bincount(pairs.document, weights=pairs.classes(answers) > 0, minlength=table.num_rows)
        candidate = (pairs.sizes > 0) & (100 * shared >= percent * pairs.sizes)
        order = np.flatnonzero(candidate[pairs.document])
        order = order[np.argsort(pairs.document[order], kind="stable")]
        elements = pairs.kinds[pairs.kind[order]]
        ends = np.cumsum(np.where(candidate, pairs.sizes, 0)).tolist()
        rows = []
        for n, end, yes in zip(pairs.sizes.tolist(), ends, candidate.tolist(), strict=True):
            s = elements[end - n : end]
            key = (blocks.mix64(s).sum(dtype=np.uint64), blocks.mix64(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)) if yes else ()
            rows.append((n, *(int(x.view(np.int64)) for x in key), _pack_set(s >> _KEEP)) if yes else (n, None, None, None))
        types = [*[pa.int64()] * 3, pa.binary()]
        return pa.Table.from_arrays(
            [table.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))],
            names=["doc_id", "n_shingles", "key_a", "key_b", "elements"],
        )

    longs, blob = T.LongType(), T.BinaryType()
    set_rows = T.StructType([id_field, *[T.StructField(c, longs) for c in ("n_shingles", "key_a", "key_b")], T.StructField("elements", blob)])
    sets = stage(_with_counts(shards.groupBy("shard"), of_texts, pick_texts, set_rows))

    key = ["n_shingles", "key_a", "key_b"]
    classes = stage(sets.where("elements IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("set_id")))
    one_of_each = (
        sets.where("elements IS NOT NULL")
        .join(classes.select("set_id").distinct(), F.col("doc_id") == F.col("set_id"), "left_semi")
        .select("doc_id", "n_shingles", "elements")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)))
    )

    def of_sets(table: pa.Table) -> _Pairs:
        found = [_unpack_set(e) for e in table.column("elements").to_pylist()]
        document = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return _Pairs(blocks.mix64(np.concatenate(found)), document, len(found), bits)

    def pick_sets(table: pa.Table, answers: pa.Table) -> pa.Table:
        pairs = of_sets(table)
        classes = np.empty(len(pairs.at), np.uint8)
        classes[pairs.at] = pairs.classes(answers)
        shared = np.bincount(pairs.document, weights=classes[pairs.at] > 0, minlength=table.num_rows).astype(np.int64)
        ends = np.cumsum(pairs.sizes).tolist()
        packed = pa.array([blocks.packed(classes[b - n : b]) for n, b in zip(pairs.sizes.tolist(), ends, strict=True)], pa.binary())
        found = [_unpack_set(e) for e in table.column("elements").to_pylist()]
        sketches = pa.array([parity_sketch(s) for s in found], pa.list_(pa.int64()))
        wide = pa.array([parity_sketch(s, WIDE_WORDS) if 100 * len(s) >= percent * WIDE_FROM else None for s in found], pa.list_(pa.int64()))
        told = table.select(["doc_id", "n_shingles", "elements"])
        for name, column in (("classes", packed), ("sketch", sketches), ("wide", wide)):
            told = told.append_column(name, column)
        return told.filter(pa.array(100 * shared >= percent * pairs.sizes))

    rep_rows = T.StructType([id_field, T.StructField("n_shingles", longs), T.StructField("elements", blob), T.StructField("classes", blob), T.StructField("sketch", T.ArrayType(longs)), T.StructField("wide", T.ArrayType(longs))])
    first = stage(_with_counts(one_of_each.groupBy("shard"), of_sets, pick_sets, rep_rows))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(_unpack_set(e), blocks.unpacked(c, np.uint8), percent) for e, c in zip(batch.column("elements").to_pylist(), batch.column("classes").to_pylist(), strict=True)]
            if not found:
                continue
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.concatenate([f[j] for f in found]).astype(np.int64)) for j in range(5)), *(batch.column(c).take(rows) for c in ("doc_id", "n_shingles"))],
                names=["signature", "after", "needed", "place", "list", "id", "n"],
            )

    signed = first.mapInArrow(sign, T.StructType([*[T.StructField(c, longs) for c in ("signature", "after", "needed", "place", "list")], T.StructField("id", id_field.dataType), T.StructField("n", longs)]))
    ends = signed.groupBy("signature").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    shared = stage(signed.join(ends, "signature"))
    links = _compare(first, _candidates(shared, shared, F.col("b.id") == F.col("b.low"), percent), percent)
    links = stage(links.unionByName(_compare(first, _candidates(shared, shared, F.col("b.id") == F.col("b.high"), percent), percent)))
    known = stage(components(links))
    placed = stage(shared.join(known, shared["id"] == known["node"], "left").select(shared["*"], F.coalesce("component", "id").alias("component")))
    # Only signatures whose sets are still in more than one component.
    apart = placed.groupBy("signature").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("signature")
    before = Window.partitionBy("id", "list").orderBy("place").rowsBetween(-EARLIER, -1)
    sketches = first.select(F.col("doc_id").alias("id"), "sketch", "wide")
    apart = placed.join(apart, "signature", "left_semi").withColumn("earlier", F.collect_list("signature").over(before))
    apart = stage(apart.join(sketches, "id"))
    may_link = (F.col("a.id") > F.col("b.id")) & (F.col("a.component") != F.col("b.component")) & _first_met_and_near(percent)
    more = _compare(first, _candidates(apart, apart, may_link, percent), percent)
    links = stage(links.unionByName(more))
    final = components(links).select(F.col("node").alias("set_id"), "component")
    found = classes.join(final, "set_id", "left").select(*key, F.coalesce("component", "set_id").alias("component"))
    return sets.select("doc_id", *key).join(found, key, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _first_met_and_near(percent: int) -> Column:
    """Whether a and b share none of the signatures shortly before this one, and sketches allow a link.

    Both have their signatures in one order. A pair that is left out here also shares an earlier one,
    where nothing else that is asked of the pair comes out differently, so it is taken at the first.
    Sketches that are too narrow for the sets rule nothing out.
    """
    short = sum((F.bit_count(F.col("a.sketch")[i].bitwiseXOR(F.col("b.sketch")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    each = F.zip_with("a.wide", "b.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    wide = F.coalesce(F.aggregate(each, F.lit(0), lambda total, n: total + n), F.lit(0))
    allowed = (100 - percent) * (F.col("a.n") + F.col("b.n"))
    return ~F.arrays_overlap("a.earlier", "b.earlier") & ((100 + percent) * short <= allowed) & ((100 + percent) * wide <= allowed)


def _candidates(left: DataFrame, right: DataFrame, which: Column, percent: int) -> DataFrame:
    """Different pairs a, b of ids that share a signature, as chosen, and could be similar enough.

    Tokens are in one order for all sets, so the tokens after the first shared one bound how many two
    sets can share; a pair that is similar enough keeps within that bound at its first shared token.
    """
    a, b = left.alias("a"), right.alias("b")
    fits = (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & (
        F.least("a.after", "b.after") + 1 >= F.greatest("a.needed", "b.needed")
    )
    return a.join(b, F.col("a.signature") == F.col("b.signature")).where(which & fits & (F.col("a.id") != F.col("b.id"))).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b")
    ).distinct()


def _compare(first: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, own = [], None, None
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                other = x.as_py()
                if (packed := y.as_py()) != last:
                    last, own = packed, _unpack_set(packed)
                other = _unpack_set(other)
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(first.select(F.col("doc_id").alias("a"), F.col("elements").alias("of_a")), "a")
    both = with_a.join(first.select(F.col("doc_id").alias("b"), F.col("elements").alias("of_b")), "b")
    return both.mapInArrow(check, pairs.schema)


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row of each group, the one with the smallest doc_id, with all its columns.

    Rows are told apart by a key of their own: a null doc_id is the smallest, and of a group's rows with
    the same doc_id one stays. Texts without words are in no group, so all their rows stay.
    """
    rows, name = blocks.keyed(docs), blocks.row_key(docs)
    key = F.col(name)
    linked = linked_documents(rows.select(key.alias("doc_id"), "text"), size, percent)
    linked = stage(linked.select(F.col("doc_id").alias(name), "component_id"))
    first = F.min(F.struct("doc_id", name)).alias("first")
    several = linked.join(rows.select(name, "doc_id"), name).groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), first).where("n > 1")
    gone = linked.join(several.select("component_id", F.col("first").getField(name).alias("stays")), "component_id").where(key != F.col("stays"))
    return blocks.without(rows, gone, name)
