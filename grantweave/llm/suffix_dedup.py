"""Suffix-array dedup: removes bytes of 50-byte strings that an earlier document holds too.

All 50-byte strings of one content must meet, but no task can hold all texts. A string's anchor is
its smallest hash of ANCHOR bytes, which depends on its content only; neighbouring strings share
theirs and travel as one segment (about 60 bytes for each 14 bytes of text).

1. Each task sends its distinct anchors as numbers of 4 bytes, by hash range. What two documents hold
   goes into a Bloom filter of bounded size, which is broadcast: a false hit costs work only.
2. Segments of repeated anchors are sent by anchor, packed; a task sends each distinct segment only for
   its smallest document, and covers the others on the spot.
3. In each bucket equal segments (by a hash of all their bytes) are settled by their smallest document. Where an anchor has segments
   that differ (at the borders of copies), the strings that two of them share are cut out, and a suffix
   array of these pieces, built in linear grouping steps, puts equal 50-byte beginnings side by side:
   each such run of suffixes is one string, and all its documents but the first are covered.
4. Covered places meet by document and become maximal runs of bytes.

Ids must be integers. Null texts are empty; rows without an id keep all bytes and take no part. Rows
that share an id count as copies of one document. Texts under 50 bytes lose nothing. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common
from grantweave.llm.suffix_array import suffix_array

LENGTH = 50
ANCHOR = 24
#: Hash ranges of the first step, bits for each repeated anchor, and the most bytes broadcast.
RANGES = 256
BITS = 16
MAX_FILTER_BYTES = 64 << 20
#: Segments and anchors that a task holds before it sends them on.
FLUSH = 1 << 18
#: Bytes of pieces in one suffix array, beyond which the next anchor's begin another.
ARRAY_BYTES = 1 << 16


def _window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash for each place's next width bytes, by doubling."""
    h, n = data.astype(np.uint64) + np.uint64(1), 1
    while n < width:
        step = min(n, width - n)
        left, right = h[: len(h) - step], h[step:]
        h = (left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31)))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        n += step
    return h


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, start, strings) of every run of neighbouring strings with one anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    low, n = _window_hashes(data, ANCHOR), 1
    while n < LENGTH - ANCHOR + 1:
        step = min(n, LENGTH - ANCHOR + 1 - n)
        low = np.minimum(low[:-step], low[step:])
        n += step
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(low)]
    whole = np.flatnonzero(np.arange(len(low)) + LENGTH <= offsets[1:][row])
    low, row = low[whole], row[whole]
    if not len(whole):
        return none.astype(np.uint64), none, none, none
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(new)
    # Smallest hashes crowd at the low end; mixed, they deal out evenly.
    return common.mix(low[at]), row[at], whole[at], np.diff(np.append(at, len(low)))


def _marks(data: np.ndarray, place: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """A hash of each whole segment: of all its bytes in their order, and of all its strings."""
    sums = np.zeros(len(data) - LENGTH + 2, np.uint64)
    np.cumsum(common.mix(_window_hashes(data, LENGTH)), out=sums[1:])
    in_order = common.RangeHash(data).of(place, place + strings + LENGTH - 1)
    return common.mix(in_order ^ common.mix(sums[place + strings] - sums[place]))


def _range(anchors: np.ndarray) -> np.ndarray:
    return (anchors >> np.uint64(56)).astype(np.int64) % RANGES


def _short(anchors: np.ndarray) -> np.ndarray:
    return (anchors >> np.uint64(20)).astype(np.uint32)


def repeated_filter(docs: DataFrame, doc_id: str, text: str) -> dict[int, tuple[int, bytes]]:
    """By hash range: bits and bytes of a Bloom filter of the anchors that several documents hold."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            values = np.repeat(values, np.minimum(counts, 2))
            parts = [(r, _short(h).tobytes()) for r, (h,) in common.packed(_range(values), RANGES, values)]
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in parts], pa.int32()), pa.array([h for _, h in parts], pa.binary())], names=["part", "hashes"])

        for _, data, offsets in common.pieces(batches, text):
            anchors, row, _, _ = segments(data, offsets)
            if len(anchors):
                # Once for each row; rows of one id may count twice, which makes a false hit at most.
                order = np.lexsort((row, anchors))
                anchors, row = anchors[order], row[order]
                held.append(anchors[np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])])])
                size += len(held[-1])
            if size >= FLUSH * 8:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    most = 1 << (MAX_FILTER_BYTES // RANGES * 8).bit_length() - 1

    def filtered(key: tuple, group: pa.Table) -> pa.Table:
        values, counts = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("hashes")]), return_counts=True)
        values = values[counts > 1]
        bits = min(max(1024, 1 << (len(values) * BITS).bit_length()), most)
        places = np.zeros(bits // 8, np.uint8)
        for p in _places(values, bits):
            np.bitwise_or.at(places, p >> 3, (1 << (p & 7)).astype(np.uint8))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([bits], pa.int64()), pa.array([places.tobytes()], pa.binary())], names=["part", "bits", "places"])

    hashed = docs.mapInArrow(sent, "part int, hashes binary")
    rows = hashed.groupBy("part").applyInArrow(filtered, "part int, bits long, places binary").collect()
    return {r.part: (r.bits, bytes(r.places)) for r in rows}


def _places(short: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    h = common.mix(short.astype(np.uint64))
    for k in range(3):
        yield (h >> np.uint64(20 * k) & np.uint64(bits - 1)).astype(np.int64)


def _known(anchors: np.ndarray, filters: dict) -> np.ndarray:
    found = np.zeros(len(anchors), bool)
    parts, short = _range(anchors), _short(anchors)
    order = np.argsort(parts, kind="stable")
    ends = np.searchsorted(parts[order], np.arange(RANGES + 1))
    for r in np.flatnonzero(np.diff(ends)):
        if int(r) in filters:
            own = order[ends[r] : ends[r + 1]]
            bits, data = filters[int(r)]
            places, hit = np.frombuffer(data, np.uint8), np.ones(len(own), bool)
            for p in _places(short[own], bits):
                hit &= (places[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
            found[own] = hit
    return found


def _cover_rows(ids, starts, strings, blocks: int) -> pa.Table:
    """Covered places, packed by the block of their document."""
    parts = list(common.packed(_block(ids, blocks), blocks, ids, starts.astype(np.uint32), strings.astype(np.uint32)))
    columns = [pa.array([b for b, _ in parts], pa.int32())]
    columns += [pa.array([p[k].tobytes() for _, p in parts], pa.binary()) for k in range(3)]
    return pa.table(columns, names=["block", "ids", "starts", "strings"])


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (common.mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


_POST = "bucket int, anchors binary, marks binary, ids binary, starts binary, strings binary, size long, texts binary"
_COVER = "block int, ids binary, starts binary, strings binary"


def _posts(docs: DataFrame, doc_id: str, text: str, filters, buckets: int) -> DataFrame:
    """Segments of repeated anchors by bucket. Without a text: covered already."""

    def packets(held: list) -> Iterator[pa.RecordBatch]:
        anchors, marks, ids, starts, strings = (np.concatenate([h[k] for h in held]) for k in range(5))
        lengths = strings + LENGTH - 1
        sources = np.concatenate([[0], np.cumsum([len(h[5]) for h in held])])
        place = np.concatenate([h[6] + sources[k] for k, h in enumerate(held)])
        data = np.concatenate([h[5] for h in held])
        order = np.lexsort((ids, marks, anchors))
        anchors, marks, ids, starts, strings, lengths, place = (x[order] for x in (anchors, marks, ids, starts, strings, lengths, place))
        new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (marks[1:] != marks[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        covered = ids > ids[first]
        lengths = np.where(covered | ~new, 0, lengths)
        bucket = (anchors % np.uint64(buckets)).astype(np.int64)
        rows = list(common.packed(bucket, buckets, anchors, marks, ids, starts.astype(np.uint32), np.where(covered, -strings, strings).astype(np.int32), np.arange(len(ids))))
        columns = [pa.array([b for b, _ in rows], pa.int32())]
        columns += [pa.array([p[k].tobytes() for _, p in rows], pa.binary()) for k in range(5)]
        texts = (data[common.runs(place[p[5]], lengths[p[5]])].tobytes() for _, p in rows)
        columns += [pa.array([sum(lengths[p[5]].tolist()) for _, p in rows], pa.int64()), pa.array([pa.compress(t, "zstd", asbytes=True) for t in texts], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=_names(_POST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, data, offsets in common.pieces(batches, text):
            ids = rows.column(doc_id).to_numpy(zero_copy_only=False)
            anchors, row, place, strings = segments(data, offsets)
            use = np.flatnonzero(_known(anchors, filters.value))
            if not len(use):
                continue
            anchors, row, place, strings = anchors[use], row[use], place[use], strings[use]
            marks = _marks(data, place, strings)
            cut = common.runs(place, strings + LENGTH - 1)
            lengths = strings + LENGTH - 1
            held.append((anchors, marks, ids[row].astype(np.int64), place - offsets[row], strings, data[cut], np.cumsum(lengths) - lengths))
            size += len(use)
            if size >= FLUSH:
                yield from packets(held)
                held, size = [], 0
        if held:
            yield from packets(held)

    return docs.mapInArrow(run, _POST)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def settle(anchors, marks, ids, starts, strings, place, data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered (id, start, strings) of one bucket's segments; place: where a segment's bytes are, or -1."""
    out = []
    order = np.lexsort((place < 0, ids, marks, anchors))
    anchors, marks, ids, starts, strings, place = (x[order] for x in (anchors, marks, ids, starts, strings, place))
    new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (marks[1:] != marks[:-1])])
    head = np.flatnonzero(new)
    kind = np.cumsum(new) - 1  # number of the distinct segment
    later = ids > ids[head][kind]
    out.append((ids[later], starts[later], strings[later]))
    # Anchors with several distinct segments of several documents.
    group = np.cumsum(np.concatenate([[True], anchors[head][1:] != anchors[head][:-1]])) - 1
    begin = np.flatnonzero(np.concatenate([[True], np.diff(group) > 0]))
    mixed = (np.minimum.reduceat(ids[head], begin) < np.maximum.reduceat(ids[head], begin))[group]
    reps = np.flatnonzero(mixed)
    if len(reps):
        own = head[reps]
        count = strings[own]
        # Only the bytes that are compared; the others of the bucket are not needed.
        data = data[common.runs(place[own], count + LENGTH - 1)]
        place = np.cumsum(count + LENGTH - 1) - count - LENGTH + 1
        owner = np.repeat(np.arange(len(reps)), count)
        at = common.runs(place, count)
        h = np.empty(len(at), np.uint64)
        for a in range(0, len(own), 1 << 14):  # hashing takes many times the bytes hashed
            b = min(a + (1 << 14), len(own))
            first, last = place[a], place[b - 1] + count[b - 1] + LENGTH - 1
            inside = slice(int(count[:a].sum()), int(count[:b].sum()))
            h[inside] = _window_hashes(data[first:last], LENGTH)[at[inside] - first]
        shared = _in_two(h, ids[own][owner])
        # Runs of shared strings within a segment are the pieces.
        edge = np.concatenate([[False], shared[:-1] & (owner[1:] == owner[:-1])])
        first = np.flatnonzero(shared & ~edge)
        last = np.flatnonzero(shared & ~np.concatenate([shared[1:] & (owner[1:] == owner[:-1]), [False]]))
        size = last - first + 1
        found = _by_suffixes(data, at[first], size, ids[own][owner[first]], anchors[own][owner[first]])
        piece, offset = found
        rep = owner[first[piece]]
        begin_in_segment = at[first[piece]] - place[rep] + offset
        # What holds for a distinct segment holds for each place where its first document has it.
        same = np.flatnonzero(~later)
        places_of = np.searchsorted(kind[same], reps[rep]), np.searchsorted(kind[same], reps[rep], "right")
        times = places_of[1] - places_of[0]
        which = same[common.runs(places_of[0], times)]
        out.append((ids[which], starts[which] + np.repeat(begin_in_segment, times), np.ones(len(which), np.int64)))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _in_two(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """True for the hashes that occur with two ids."""
    if not len(h):
        return np.zeros(0, bool)
    order = np.argsort(h)
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    begin = np.flatnonzero(new)
    two = np.minimum.reduceat(ids[order], begin) < np.maximum.reduceat(ids[order], begin)
    out = np.empty(len(h), bool)
    out[order] = two[np.cumsum(new) - 1]
    return out


def _by_suffixes(data, starts, strings, ids, anchors) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the strings that a piece of a smaller id holds too. Pieces come by anchor."""
    texts = [data[s : s + n + LENGTH - 1].tobytes() for s, n in zip(starts.tolist(), strings.tolist(), strict=True)]
    # Equal pieces of an anchor are one text of the array, with the smallest of their ids.
    first: dict[tuple[int, bytes], int] = {}
    for k, key in enumerate(zip(anchors.tolist(), texts, strict=True)):
        if key not in first or ids[k] < ids[first[key]]:
            first[key] = k
    of = np.array([first[key] for key in zip(anchors.tolist(), texts, strict=True)], np.int64)
    covered: dict[int, np.ndarray] = {k: np.zeros(strings[k], bool) for k in set(first.values())}
    by_anchor: dict[int, list[int]] = {}
    for (anchor, _), k in first.items():
        by_anchor.setdefault(anchor, []).append(k)
    array: list[int] = []
    size = 0
    for members in by_anchor.values():
        if len(members) > 1:
            array += members
            size += sum(len(texts[k]) for k in members)
        if size >= ARRAY_BYTES:
            _one_array(array, texts, ids, covered)
            array, size = [], 0
    if array:
        _one_array(array, texts, ids, covered)
    piece, offset = [], []
    for k, f in enumerate(of.tolist()):
        found = np.arange(strings[k]) if ids[k] > ids[f] else np.flatnonzero(covered[f])
        piece.append(np.full(len(found), k))
        offset.append(found)
    return (np.concatenate(piece), np.concatenate(offset)) if piece else (np.zeros(0, np.int64),) * 2


def _one_array(members: list[int], texts: list[bytes], ids: np.ndarray, covered: dict[int, np.ndarray]) -> None:
    symbols: list[int] = []
    owner, where = [], []
    for k in members:
        count = len(texts[k]) - LENGTH + 1
        owner += [k] * count + [-1] * LENGTH
        where += [*range(count), *[-1] * LENGTH]
        symbols += [b + 2 for b in texts[k]]
        symbols.append(1)
    symbols.append(0)
    order = np.array(suffix_array(symbols)[1:])
    owner, where = np.array(owner), np.array(where)
    order = order[owner[order] >= 0]
    rows = np.lib.stride_tricks.sliding_window_view(np.array(symbols, np.uint16), LENGTH)
    new = np.ones(len(order), bool)
    for a in range(1, len(order), 1 << 15):
        b = min(a + (1 << 15), len(order))
        new[a:b] = (rows[order[a:b]] != rows[order[a - 1 : b - 1]]).any(axis=1)
    begin = np.flatnonzero(new)
    holder = ids[owner[order]]
    later = holder > np.minimum.reduceat(holder, begin)[np.cumsum(new) - 1]
    for k, w in zip(owner[order[later]].tolist(), where[order[later]].tolist(), strict=True):
        covered[k][w] = True


def covered_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, starts, ends): the maximal runs of bytes to remove, for documents that have any."""
    spark = docs.sparkSession
    usable = docs.where(F.col(doc_id).isNotNull() & (F.octet_length(text) >= LENGTH)).select(F.col(doc_id).cast("long").alias(doc_id), text)
    buckets = common.bucket_count(spark, common.text_total(usable, text), 32 << 20)
    filters = spark.sparkContext.broadcast(repeated_filter(usable, doc_id, text))

    def settled(key: tuple, group: pa.Table) -> pa.Table:
        def column(name, kind):
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)])

        anchors, marks, ids = column("anchors", np.uint64), column("marks", np.uint64), column("ids", np.int64)
        texts = [
            np.frombuffer(pa.decompress(x.as_buffer(), size, "zstd"), np.uint8) if size else np.zeros(0, np.uint8)
            for x, size in zip(group.column("texts"), group.column("size").to_pylist(), strict=True)
        ]
        starts, strings, data = column("starts", np.uint32).astype(np.int64), column("strings", np.int32).astype(np.int64), np.concatenate(texts)
        done = strings < 0
        # A packet has the bytes of a distinct segment once, at the first of its rows.
        sizes = [len(x.as_buffer()) // 8 for x in group.column("anchors")]
        packet = np.repeat(np.arange(len(sizes)), sizes)
        new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (marks[1:] != marks[:-1]) | (packet[1:] != packet[:-1])])
        lengths = np.where(new, strings + LENGTH - 1, 0)
        place = np.where(new, np.cumsum(lengths) - lengths, -1)
        rest = ~done
        found = settle(*(x[rest] for x in (anchors, marks, ids, starts, strings, place)), data)
        return _cover_rows(*(np.concatenate([x, y]) for x, y in zip(found, (ids[done], starts[done], -strings[done]), strict=True)), buckets)

    def merged(key: tuple, group: pa.Table) -> pa.Table:
        ids, starts, strings = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)]).astype(np.int64)
            for name, kind in (("ids", np.int64), ("starts", np.uint32), ("strings", np.uint32))
        )
        order = np.lexsort((starts, ids))
        ids, starts, ends = ids[order], starts[order], (starts + strings + LENGTH - 1)[order]
        # The furthest end so far within a document.
        row = np.cumsum(np.concatenate([[True], ids[1:] != ids[:-1]]))
        reach = np.maximum.accumulate(ends + row * (1 << 40)) - row * (1 << 40)
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (starts[1:] > reach[:-1])])
        begin = np.flatnonzero(new)
        stop = reach[np.append(begin[1:], len(ids)) - 1]
        first = np.flatnonzero(np.concatenate([[True], np.diff(ids[begin]) != 0]))
        bounds = np.append(first, len(begin))
        return pa.table([
            pa.array(ids[begin][first]),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(starts[begin])),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(stop)),
        ], names=["id", "starts", "ends"])

    posts = _posts(usable, doc_id, text, filters, buckets)
    covers = posts.groupBy("bucket").applyInArrow(settled, _COVER)
    return covers.groupBy("block").applyInArrow(merged, "id long, starts array<long>, ends array<long>")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds n_bytes, n_removed, n_spans and kept (the bytes that stay), and keeps the texts."""
    plain = docs.drop("n_bytes", "n_removed", "n_spans", "kept", "_id", "_starts", "_ends")
    runs = covered_runs(plain, doc_id, text).select(F.col("id").alias("_id"), F.col("starts").alias("_starts"), F.col("ends").alias("_ends"))
    joined = plain.join(runs, F.col(doc_id) == F.col("_id"), "left").drop("_id")
    names = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in common.pieces(batches, text):
            starts, ends = rows.column("_starts").to_pylist(), rows.column("_ends").to_pylist()
            sizes, removed, spans, kept = np.diff(offsets), [], [], []
            for k, (a, b) in enumerate(zip(starts, ends, strict=True)):
                own = data[offsets[k] : offsets[k + 1]]
                if a:
                    keep = np.ones(len(own), bool)
                    for x, y in zip(a, b, strict=True):
                        keep[x:y] = False
                    own = own[keep]
                removed.append(int(sizes[k]) - len(own))
                spans.append(len(a or ()))
                kept.append(own.tobytes())
            made = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *made], names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, common.extended(plain, "n_bytes long, n_removed long, n_spans long, kept binary"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
