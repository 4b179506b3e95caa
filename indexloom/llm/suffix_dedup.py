"""Remove byte strings that an earlier document has too: suffix arrays over content shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from indexloom.llm import blocks

WIDTH = 50
# Bytes of the part of a window that names its shard, in whole eights, and windows that one segment covers at most. Texts
# share shorter strings by chance, the more of them the larger the corpus is.
ANCHOR, SEGMENT_WINDOWS = 24, 64
# Shards and buckets send each other a message per pair, so their number grows with the square of the corpus.
SHARD_BYTES = 8 << 20
# Bytes that one suffix array covers; an anchor with more has several, merged by binary search.
ARRAY_BYTES = 1 << 20
# An anchor that occurs in more documents than this sends each window to a bucket of the window's own.
HOT_ANCHOR = 4096
_BLOCK = 1 << 16
_NO_ID = np.int64(2**63 - 1)


def window_runs(data: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows of one document that share their anchor.

    The anchor of a window is the least hash among the ANCHOR-byte strings inside it, so equal windows
    have equal anchors wherever they stand. Returns the first window's start, the number of windows,
    the anchor and the document of each run.
    """
    anchor = min(ANCHOR, width) // 8 * 8
    empty = np.zeros(0, np.int64)
    longest = len(data) - width + 1
    if longest <= 0:
        return empty, empty, np.zeros(0, np.uint64), empty
    opens = np.zeros(longest, bool)
    opens[bounds[:-1][bounds[:-1] < longest]] = True
    raw = np.ascontiguousarray(data)
    eights = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    found, values, last = [], [], np.uint64(0)
    for a in range(0, longest, _BLOCK):
        b = min(longest, a + _BLOCK)
        n = b - a + width - anchor
        grams = eights[a : a + n] * np.uint64(0x9E3779B97F4A7C15)
        for j in range(8, anchor, 8):
            grams ^= grams >> np.uint64(29)
            grams += eights[a + j : a + j + n]
            grams *= np.uint64(0xC2B2AE3D27D4EB4F)
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        least = blocks.sliding_min(grams, width - anchor + 1)
        begins = opens[a:b].copy()
        begins[1:] |= least[1:] != least[:-1]
        begins[0] |= least[0] != last
        last = least[-1]
        at = np.flatnonzero(begins)
        found.append(at + a)
        values.append(least[at])
    # Least hashes are small numbers; mixed again, their leading bits deal them out evenly.
    starts, anchors = np.concatenate(found), blocks.mix64(np.concatenate(values))
    document = np.searchsorted(bounds, starts, "right") - 1
    limit = bounds[document + 1] - width + 1
    following = np.append(starts[1:], longest)
    lengths = np.minimum(following, limit) - starts
    good = lengths > 0
    starts, anchors, document, lengths = starts[good], anchors[good], document[good], lengths[good]
    pieces = -(-lengths // SEGMENT_WINDOWS)
    if len(pieces) and pieces.max() > 1:
        which = np.repeat(np.arange(len(pieces)), pieces)
        step = blocks.ragged(np.zeros(len(pieces), np.int64), pieces) * SEGMENT_WINDOWS
        starts, anchors, document = starts[which] + step, anchors[which], document[which]
        lengths = np.minimum(lengths[which] - step, SEGMENT_WINDOWS)
    return starts, lengths, anchors, document


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, and the place of each, by Larsson-Sadakane refinement.

    Suffixes are ordered by their first seven symbols (below 511), then groups of equal ones by the
    places of the suffixes 7, 14, 28... symbols on, until no two are equal. Only such groups are sorted
    again.
    """
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(7, np.int64)])
    keys = padded[:n].copy()
    for j in range(1, 7):
        keys = (keys << 9) | padded[j : j + n]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    opens = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(opens)
    sizes = np.diff(np.append(first, n))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.repeat(first, sizes)
    rank[n] = -1
    unsorted, step = order[np.repeat(sizes > 1, sizes)], 7
    while len(unsorted):
        old = rank[unsorted]
        keys = old * (n + 1) + rank[np.minimum(unsorted + step, n)] + 1
        by = np.argsort(keys, kind="stable")
        unsorted, keys, old = unsorted[by], keys[by], old[by]
        opens = np.concatenate([[True], old[1:] != old[:-1]])
        group = np.flatnonzero(opens)
        places = old + np.arange(len(old)) - np.repeat(group, np.diff(np.append(group, len(old))))
        order[places] = unsorted
        parts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(parts, len(old)))
        rank[unsorted] = np.repeat(places[parts], sizes)
        unsorted = unsorted[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order, rank[:n]


def common_prefixes(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """Symbols that a suffix shares with the one before it in order, up to `most`, by Kasai's method.

    A suffix shares at least one symbol less than the suffix one to its left does. All segments go from
    left to right in step; segment i asks for the suffixes at starts[i] and the lengths[i] - 1 after it.
    Other places are 0.
    """
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(most + 1, symbols.dtype)])
    shared = np.zeros(n, np.int16)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    held = np.zeros(len(starts), np.int64)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -t, "left"))
        at = starts[:live] + t
        place = rank[at]
        before = order[np.maximum(place - 1, 0)]
        length = np.maximum(held[:live] - 1, 0)
        active = np.flatnonzero(place > 0)
        length[place == 0] = 0
        while len(active):
            more = (length[active] < most) & (padded[at[active] + length[active]] == padded[before[active] + length[active]]) & (before[active] + length[active] < n)
            active = active[more]
            length[active] += 1
        held[:live] = length
        shared[at] = length
    return shared


class _Windows:
    """The different windows of some segments: sorted, with the least owner of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, counts: np.ndarray, owners: np.ndarray, width: int):
        sizes = counts + width - 1
        places = np.cumsum(sizes + 1) - (sizes + 1)
        symbols = np.zeros(int((sizes + 1).sum()), np.uint16)
        inside = blocks.ragged(places, sizes)
        symbols[inside] = data[blocks.ragged(starts, sizes)].astype(np.uint16) + 1
        order, rank = suffix_array(symbols)
        shared = common_prefixes(symbols, order, rank, places, counts, width)
        at = blocks.ragged(places, counts)
        valid = np.zeros(len(symbols), bool)
        valid[at] = True
        sorted_windows = order[valid[order]]
        del order, rank, valid, inside
        opens = shared[sorted_windows] < width
        first = np.flatnonzero(opens)
        group = np.empty(len(symbols), np.int32)
        group[sorted_windows] = np.cumsum(opens) - 1
        # Number of each window, segment by segment.
        self.group = group[at]
        owner = np.empty(len(symbols), np.int64)
        owner[at] = np.repeat(owners, counts)
        self.owners = np.minimum.reduceat(owner[sorted_windows], first) if len(first) else np.zeros(0, np.int64)
        self.symbols, self.first, self.width = symbols, sorted_windows[first], width

    def keys(self) -> np.ndarray:
        """The windows as byte strings, in order."""
        rows = np.empty((len(self.first), self.width), np.uint8)
        for j in range(self.width):
            rows[:, j] = self.symbols[self.first + j] - 1
        return rows.view(f"S{self.width}").ravel()


def least_owners(
    data: np.ndarray, starts: np.ndarray, counts: np.ndarray, owners: np.ndarray, width: int = WIDTH, array_bytes: int = ARRAY_BYTES
) -> np.ndarray:
    """For each window of each segment the least owner among all segments that have the same window.

    Segment i has counts[i] windows from starts[i] on. Segments are put into arrays of at most
    `array_bytes`; each gives its different windows in order, and binary search merges them.
    """
    ends = np.cumsum(counts + width)
    arrays, first = [], 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + array_bytes, "right")))
        arrays.append(_Windows(data, starts[first:last], counts[first:last], owners[first:last], width))
        first = last
    if not arrays:
        return np.zeros(0, np.int64)
    if len(arrays) == 1:
        return arrays[0].owners[arrays[0].group]
    keys, least = blocks.merged_runs(((a.keys(), a.owners) for a in arrays), np.minimum)
    return np.concatenate([least[np.searchsorted(keys, a.keys())][a.group] for a in arrays])


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Which of the values occur more than once."""
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    found = np.zeros(len(hashes), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _owners_by_anchor(data: np.ndarray, sizes: np.ndarray, counts: np.ndarray, owners: np.ndarray, width: int, array_bytes: int) -> np.ndarray:
    """`least_owners` of different segments that stand one after the other.

    Only segments with the same anchor can share a window, and only windows with the same hash are equal. So a segment
    that is alone with its anchor, and what lies before the first and after the last window that is not alone with its hash,
    is its own answer and is not sorted. Anchors are taken together up to `array_bytes`; arrays of different ones need no merge.
    """
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    _, _, anchors, _ = window_runs(data, bounds, width)
    _, anchor, times = np.unique(anchors, return_inverse=True, return_counts=True)
    crowded = np.flatnonzero(times[anchor] > 1)
    crowded = crowded[np.argsort(anchor[crowded], kind="stable")]
    found = np.repeat(owners, counts)
    begins = np.cumsum(counts) - counts
    closes = np.flatnonzero(np.diff(anchor[crowded], append=-1)) + 1
    ends = np.cumsum(sizes[crowded])[closes - 1]
    taken = done = 0
    while taken < len(closes):
        last = max(taken + 1, int(np.searchsorted(ends, (ends[taken - 1] if taken else 0) + array_bytes, "right")))
        some, taken, done = crowded[done : closes[last - 1]], last, closes[last - 1]
        places = blocks.ragged(np.zeros(len(some), np.int64), counts[some])
        at = np.repeat(bounds[some], counts[some]) + places
        met = np.flatnonzero(_repeated(blocks.span_hashes(data, at, at + width)))
        if not len(met):
            continue
        segment = np.repeat(some, counts[some])[met]
        opens = np.flatnonzero(np.diff(segment, prepend=-1))
        some, first, final = segment[opens], places[met[opens]], places[met[np.append(opens[1:], len(met)) - 1]]
        found[blocks.ragged(begins[some] + first, final - first + 1)] = least_owners(data, bounds[some] + first, final - first + 1, owners[some], width, array_bytes)
    return found


class _Shard:
    """Documents of one shard with their runs, in a form that does not depend on the order of the rows."""

    def __init__(self, table: pa.Table, bits: int, width: int):
        self.table, self.bits, self.width = table, bits, width
        self.data, self.bounds = blocks.as_bytes(table.column("text"))
        self.ids = table.column("doc_id").combine_chunks().cast(pa.int64()).fill_null(_NO_ID.item()).to_numpy(zero_copy_only=False)
        self.starts, self.counts, self.anchors, self.document = window_runs(self.data, self.bounds, width)

    def anchors_by_bucket(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int], list[int]]:
        """Different anchors in order, documents each occurs in, the number of each run's, and the buckets' stretches."""
        order = np.lexsort((self.document, self.anchors)) if len(self.anchors) else np.zeros(0, np.int64)
        values, owner = self.anchors[order], self.document[order]
        new_value = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
        new_pair = new_value.copy()
        if len(values):
            new_pair[1:] |= owner[1:] != owner[:-1]
        kinds = values[new_value]
        documents = np.add.reduceat(new_pair.astype(np.int64), np.flatnonzero(new_value)) if len(kinds) else np.zeros(0, np.int64)
        kind = np.empty(len(values), np.int64)
        kind[order] = np.cumsum(new_value) - 1
        held, cuts = blocks.stretches(blocks.bucket_of(kinds, self.bits))
        return kinds, documents, kind, held, cuts

    def segments(self, flags: dict[int, np.ndarray]):
        """Cuts the runs whose anchors other documents share into segments.

        Returns of every occurrence its start and document and the number of its segment, and of the
        different segments an occurrence, their windows and buckets, in an order given by content.
        """
        kinds, _, anchor, held, cuts = self.anchors_by_bucket()
        flag = np.zeros(len(kinds), np.uint8)
        for bucket, a, b in zip(held, cuts, cuts[1:], strict=False):
            if bucket in flags:
                flag[a:b] = flags[bucket]
        of_run = flag[anchor]
        single, hot = np.flatnonzero(of_run == 1), np.flatnonzero(of_run == 2)
        # Runs with a hot anchor fall apart into windows.
        starts = np.concatenate([self.starts[single], blocks.ragged(self.starts[hot], self.counts[hot])])
        counts = np.concatenate([self.counts[single], np.ones(int(self.counts[hot].sum()), np.int64)])
        document = np.concatenate([self.document[single], np.repeat(self.document[hot], self.counts[hot])])
        hashes = np.concatenate([self._hashes(starts[: len(single)], counts[: len(single)]), self._hashes(starts[len(single) :], counts[len(single) :])])
        bucket = np.concatenate([blocks.bucket_of(self.anchors[single], self.bits), blocks.bucket_of(hashes[len(single) :], self.bits)])
        order = np.lexsort((hashes, counts, bucket))
        opens = np.ones(len(order), bool)
        if len(order):
            a, b = order[1:], order[:-1]
            opens[1:] = (hashes[a] != hashes[b]) | (counts[a] != counts[b]) | (bucket[a] != bucket[b])
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(opens) - 1
        return starts, document, kind, order[opens], counts[order[opens]], bucket[order[opens]]

    def _hashes(self, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return blocks.span_hashes(self.data, starts, starts + counts + self.width - 1)


def _empty(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def removed_spans(docs: DataFrame, width: int = WIDTH, hot_anchor: int = HOT_ANCHOR, array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """What is left of each text without the strings that earlier documents have: doc_id, n_bytes, spans, kept.

    Texts are UTF-8 bytes (null: empty). A byte goes if a `width`-byte string covers it that also starts
    in a document with a smaller doc_id; overlapping strings count, all is judged on the input, and a
    string never crosses documents. `spans` has the start and end of each maximal run of removed bytes,
    `kept` the other bytes joined. doc_id is a whole number; a null one counts as larger than all
    others. Rows with the same doc_id do not remove from each other. Texts shorter than `width` stay, no
    rows give no rows, other columns are not looked at.

    The windows of a document are cut into runs with a common anchor, the least hash within each window.
    Anchors that only one document of the corpus has are set aside first: shards send their different
    anchors to buckets, which answer which are shared. Only shared runs are sent as text, each different
    one once per shard, to the bucket of their anchor, where equal windows meet. The buckets sort what may
    repeat by suffix arrays and answer the least owner of each window. An anchor in more than `hot_anchor` documents gives
    up its place: its windows go to buckets by their own content, so no bucket gathers them all.
    """
    shards = blocks.in_shards(docs, SHARD_BYTES)
    bits = blocks.bucket_bits(docs)

    def send_anchors(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        kinds, documents, _, held, cuts = _Shard(table, bits, width).anchors_by_bucket()
        parts = list(zip(cuts, cuts[1:], strict=False))
        # Within a bucket 32 further bits tell anchors apart; should two look alike, both count as shared.
        short = ((kinds << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        return pa.table({
            "bucket": pa.array(held, pa.int64()), "shard": pa.array([shard] * len(held), pa.int64()),
            "anchors": pa.array([blocks.packed(np.diff(short[a:b], prepend=np.uint32(0))) for a, b in parts], pa.binary()),
            "documents": pa.array([blocks.packed(np.minimum(documents[a:b], 65535).astype(np.uint16)) for a, b in parts], pa.binary()),
        })

    def flag_shared(table: pa.Table) -> pa.Table:
        anchors = [np.cumsum(blocks.unpacked(p, np.uint32), dtype=np.uint32) for p in table.column("anchors").to_pylist()]
        documents = np.concatenate([blocks.unpacked(p, np.uint16) for p in table.column("documents").to_pylist()])
        _, kind = np.unique(np.concatenate(anchors), return_inverse=True)
        total = np.bincount(kind, weights=documents)[kind]
        flags = (total > 1).astype(np.uint8) + (total > hot_anchor)
        cuts = np.concatenate([[0], np.cumsum([len(a) for a in anchors])]).tolist()
        return pa.table({
            "bucket": table.column("bucket"), "shard": table.column("shard"),
            "flags": pa.array([blocks.packed(flags[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        })

    def flags_of(table: pa.Table) -> dict[int, np.ndarray]:
        return {b: blocks.unpacked(f, np.uint8) for b, f in zip(table.column("bucket").to_pylist(), table.column("flags").to_pylist(), strict=True) if f is not None}

    def send_segments(table: pa.Table, flagged: pa.Table) -> pa.Table:
        if not flagged.num_rows or not table.num_rows:
            return _empty(segment_rows)
        shard = _Shard(table, bits, width)
        flags = flags_of(flagged)
        starts, document, kind, first, counts, bucket = shard.segments(flags)
        owners = np.full(len(first), _NO_ID)
        np.minimum.at(owners, kind, shard.ids[document])
        rows = {b: {"bucket": b, "flags": blocks.packed(f)} for b, f in flags.items()}
        held, cuts = blocks.stretches(bucket)
        for b, i, j in zip(held, cuts, cuts[1:], strict=False):
            text = shard.data[blocks.ragged(starts[first[i:j]], counts[i:j] + width - 1)]
            rows.setdefault(b, {"bucket": b}).update(
                text=zstandard.compress(text.tobytes(), 1), counts=blocks.packed(counts[i:j].astype(np.uint8)), owners=blocks.packed(owners[i:j])
            )
        number = table.column("shard")[0].as_py()
        return pa.Table.from_pylist([{"shard": number, **r} for r in rows.values()], schema=_empty(segment_rows).schema)

    def find_owners(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent = [r for r in rows if r["text"] is not None]
        counts = [blocks.unpacked(r["counts"], np.uint8).astype(np.int64) for r in sent]
        answers = {}
        if sent:
            data = np.frombuffer(b"".join(zstandard.decompress(r["text"]) for r in sent), np.uint8)
            every = np.concatenate(counts)
            owners = np.concatenate([blocks.unpacked(r["owners"], np.int64) for r in sent])
            starts = np.cumsum(every + width - 1) - (every + width - 1)
            # Segments that several shards sent alike are one from here on.
            sizes = every + width - 1
            _, first, kind = blocks.distinct_spans(data, starts, starts + sizes)
            least = np.full(len(first), _NO_ID)
            np.minimum.at(least, kind, owners)
            data, sizes = data[blocks.ragged(starts[first], sizes[first])], sizes[first]
            found = _owners_by_anchor(data, sizes, every[first], least, width, array_bytes)
            begins = np.cumsum(every[first]) - every[first]
            for_all = found[blocks.ragged(begins[kind], every)]
            cuts = np.concatenate([[0], np.cumsum([c.sum() for c in counts])]).tolist()
            answers = {r["shard"]: blocks.packed(for_all[a:b]) for r, a, b in zip(sent, cuts, cuts[1:], strict=False)}
        return pa.table({
            "bucket": table.column("bucket"), "shard": table.column("shard"), "flags": table.column("flags"),
            "owners": pa.array([answers.get(r["shard"]) for r in rows], pa.binary()),
        })

    def remove(table: pa.Table, answered: pa.Table) -> pa.Table:
        shard = _Shard(table, bits, width)
        marked = np.zeros(len(shard.data), bool)
        if answered.num_rows:
            starts, document, kind, _, counts, _ = shard.segments(flags_of(answered))
            parts = [blocks.unpacked(o, np.int64) for o in answered.sort_by("bucket").column("owners").to_pylist() if o is not None]
            owners = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            begins = np.cumsum(counts) - counts
            for a in range(0, len(kind), 1 << 15):
                k = kind[a : a + (1 << 15)]
                n = counts[k]
                earlier = owners[blocks.ragged(begins[k], n)] < np.repeat(shard.ids[document[a : a + (1 << 15)]], n)
                marked[blocks.ragged(starts[a : a + (1 << 15)], n)[earlier]] = True
        # A byte goes if one of the `width` windows that end at it or later is marked.
        seen = np.cumsum(marked, dtype=np.int32)
        gone = seen > 0
        gone[width:] = seen[width:] > seen[:-width]
        edges = np.zeros(len(gone) + 1, bool)
        edges[:-1] = gone
        begins, ends = edges.copy(), np.zeros(len(gone) + 1, bool)
        begins[1:] &= ~edges[:-1]
        ends[1:] = edges[:-1] & ~edges[1:]
        inner = shard.bounds[(shard.bounds > 0) & (shard.bounds < len(gone))]
        begins[inner] = gone[inner]
        ends[inner] = gone[inner - 1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
        per_document = np.searchsorted(begins, shard.bounds)
        base = np.repeat(shard.bounds[:-1], np.diff(per_document))
        spans = pa.ListArray.from_arrays(pa.array(per_document, pa.int32()), pa.StructArray.from_arrays([pa.array(begins - base), pa.array(ends - base)], ["start", "end"]))
        left = np.concatenate([[0], np.cumsum(~gone, dtype=np.int32)])[shard.bounds].astype(np.int64)
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), table.num_rows, [None, pa.py_buffer(left), pa.py_buffer(shard.data[~gone].tobytes())])
        return pa.table({"doc_id": table.column("doc_id"), "n_bytes": np.diff(shard.bounds), "spans": spans, "kept": kept.cast(pa.binary())})

    longs, blob = T.LongType(), T.BinaryType()
    segment_rows = T.StructType([T.StructField("shard", longs), T.StructField("bucket", longs), *[T.StructField(c, blob) for c in ("flags", "text", "counts", "owners")]])
    result = T.StructType([
        docs.schema["doc_id"], T.StructField("n_bytes", longs),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", longs), T.StructField("end", longs)]))), T.StructField("kept", blob),
    ])
    by_shard = shards.groupBy("shard")
    anchors = by_shard.applyInArrow(send_anchors, "bucket long, shard long, anchors binary, documents binary")
    flagged = anchors.groupBy("bucket").applyInArrow(flag_shared, "bucket long, shard long, flags binary")
    segments = by_shard.cogroup(flagged.groupBy("shard")).applyInArrow(send_segments, segment_rows)
    answered = segments.groupBy("bucket").applyInArrow(find_owners, "bucket long, shard long, flags binary, owners binary")
    return by_shard.cogroup(answered.groupBy("shard")).applyInArrow(remove, result)
