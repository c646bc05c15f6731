"""Language-model scores from a log-frequency Bloom filter.

N-gram counts are quantised: level 1 + floor(log2 count). The filter holds an n-gram once for each
level up to its own, so its level is found by probing level after level until one is missing. Counts
of one- and two-token sequences of the whole training corpus meet by hash range. Every n-gram is held,
those seen once too: the filter grows with the input, in parts of bounded size that no task holds together.

The model interpolates: half the weight goes to the two-token estimate wherever the history was seen.

The base score needs exact counts of every token. Tokens meet their counts, and n-grams their part of
the filter, by request: each block of documents sends its distinct hashes by bucket, the bucket answers
with counts and levels in the same order, and nothing travels more than once for a block. A token in
every document is one number a block. Hashes travel in rising order as differences, compressed. Rows
with null ids are dealt by their texts.

Null and empty texts are one end token. Rows without an id are scored and learned from. Repeated rows
count as often as they come. Without training rows N and V are 0, the base probability is 1 for the
first unseen token as the formula has it, and the score equals the base. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

ADDED = 0.1
#: Weight of the two-token estimate.
WEIGHT = 0.5
RANGES = 256
BITS_PER_ENTRY = 12
#: Distinct n-grams that a map task holds before it sends them on.
FLUSH = 1 << 22
BLOCK_BYTES = 8 << 20
#: Text whose tokens and n-grams one bucket counts.
BUCKET_BYTES = 32 << 20

END = np.uint64(0x1F83D9ABFB41BD6B)
_ONE, _TWO = np.uint64(0xA54FF53A5F1D36F1), np.uint64(0x510E527FADE682D1)


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end behind every text, and each text's first token."""
    words, first = common.word_hashes(data, offsets, common.SPACED)
    n = len(first) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))] = words
    return out, first + np.arange(n + 1)


def singles(tokens: np.ndarray) -> np.ndarray:
    return common.mix(tokens ^ _ONE)


def pairs(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; an end comes before the first."""
    before = np.concatenate([[END], tokens[:-1]])
    return common.mix(before * _TWO ^ common.mix(tokens))


def _range(h: np.ndarray, ranges: int = RANGES) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.int64) % ranges


def _short(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint32)


def coded(values: np.ndarray, rising: bool = False) -> bytes:
    """Numbers as they travel: differences where they rise, byte by byte, compressed."""
    if rising and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else values
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def plain(data, kind, rising: bool = False) -> np.ndarray:
    """The numbers of coded()."""
    data = memoryview(data)
    count, size = int.from_bytes(data[:8], "little") if len(data) else 0, np.dtype(kind).itemsize
    if not count:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], count * size, "zstd", asbytes=True), np.uint8).reshape(size, count)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


def _in_order(g: np.ndarray, buckets: int) -> np.ndarray:
    """The order in which n-grams are asked for: by bucket, then rising."""
    return np.lexsort((_short(g), _range(g, buckets)))


def _words(short: np.ndarray, level: np.ndarray | int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Which 64-bit word of a part, and the three bits in it, for an n-gram at a level."""
    h = common.mix(short.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))
    six, one = np.uint64(63), np.uint64(1)
    mask = one << (h & six) | one << (h >> np.uint64(6) & six) | one << (h >> np.uint64(12) & six)
    return (h >> np.uint64(20)).astype(np.int64) % count, mask


class LogFrequencyFilter:
    """Parts by hash range, from the lowest level that is held."""

    def __init__(self, lowest: int, parts: dict[int, bytes], ranges: int = RANGES):
        self.lowest, self.ranges = lowest, ranges
        arrays = [np.frombuffer(parts.get(r) or bytes(8), np.uint64) for r in range(ranges)]
        self.sizes = np.array([len(a) for a in arrays])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bits = np.concatenate(arrays)

    def levels(self, r: np.ndarray, short: np.ndarray) -> np.ndarray:
        """Levels by range and short hash; 0 for what isn't held."""
        size, begin = self.sizes[r], self.begins[r]
        level, left, at = np.zeros(len(short), np.uint8), np.arange(len(short)), self.lowest
        while len(left):
            word, mask = _words(short[left], at, 1 << 44)
            found = (self.bits[begin[left] + word % size[left]] & mask) == mask
            left = left[found]
            level[left] = at
            at += 1
        return level

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Estimated counts; 0 for what isn't held."""
        return counts_of(self.levels(_range(h, self.ranges), _short(h)))

    @staticmethod
    def part(short: np.ndarray, levels: np.ndarray, lowest: int = 1, each: int = BITS_PER_ENTRY) -> bytes:
        """A part's words, with so many bits for every level that it holds."""
        keep = levels >= lowest
        short, levels = short[keep], levels[keep].astype(np.int64)
        entries = int((levels - lowest + 1).sum())
        bits = np.zeros(max(1, entries * each // 64), np.uint64)
        for at in range(lowest, int(levels.max(initial=0)) + 1):
            word, mask = _words(short[levels >= at], at, 1 << 44)
            np.bitwise_or.at(bits, word % len(bits), mask)
        return bits.tobytes()


def counts_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level stands for."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels.astype(np.int64) - 1) - 0.5, 0.0)


def frequency_filter(training: DataFrame, text: str, ranges: int) -> DataFrame:
    """(bucket, bits): counts all n-grams of the training rows; a part of the filter for each hash range."""
    each = BITS_PER_ENTRY

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, counts = np.unique(np.concatenate(held), return_counts=True)
            once = counts == 1
            order = np.argsort(_short(h), kind="stable")
            h, counts, once = h[order], counts[order], once[order]
            few = dict(common.packed(_range(h[once], ranges), ranges, _short(h[once])))
            many = dict(common.packed(_range(h[~once], ranges), ranges, _short(h[~once]), counts[~once].astype(np.uint32)))
            parts, empty = sorted({*few, *many}), np.zeros(0, np.uint32)
            columns = [pa.array(parts, pa.int32())]
            for kind, k in ((few, 0), (many, 0), (many, 1)):
                columns.append(pa.array([coded(kind.get(p, [empty, empty])[k], rising=not k) for p in parts], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "once", "many", "times"])

        for _, data, offsets in common.pieces(batches, text):
            tokens, _ = token_stream(data, offsets)
            held += [singles(tokens), pairs(tokens)]
            size += 2 * len(tokens)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def built(key: tuple, group: pa.Table) -> pa.Table:
        def column(name, rising=True):
            return np.concatenate([plain(x.as_buffer(), np.uint32, rising) for x in group.column(name)])

        once, many, times = column("once"), column("many"), column("times", rising=False)
        short, place = np.unique(np.concatenate([once, many]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([np.ones(len(once)), times]), len(short))
        bits = LogFrequencyFilter.part(short, 1 + np.floor(np.log2(counts)).astype(np.uint8), each=each)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([bits], pa.binary())], names=["bucket", "bits"])

    counted = training.select(text).mapInArrow(sent, "bucket int, once binary, many binary, times binary")
    return counted.groupBy("bucket").applyInArrow(built, "bucket int, bits binary")


def token_counts(training: DataFrame, text: str, buckets: int) -> DataFrame:
    """(bucket, hashes, counts): exact counts of all training tokens, sorted by hash."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, counts = np.unique(np.concatenate(held), return_counts=True)
            return _batch(buckets, h, counts.astype(np.uint64))

        for _, data, offsets in common.pieces(batches, text):
            held.append(token_stream(data, offsets)[0])
            size += len(held[-1])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def added(key: tuple, group: pa.Table) -> pa.Table:
        h, place = np.unique(_joined(group, "hashes"), return_inverse=True)
        counts = np.bincount(place, _joined(group, "counts"), len(h)).astype(np.uint64)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([h.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["bucket", "hashes", "counts"])

    kind = "bucket int, hashes binary, counts binary"
    return training.select(text).mapInArrow(sent, kind).groupBy("bucket").applyInArrow(added, kind)


def _joined(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_buffer(), np.uint64) for x in table.column(name))])


def _answered(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(plain(x.as_buffer(), kind) for x in table.column(name))])


def _batch(buckets: int, h: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    rows = list(common.packed((h % np.uint64(buckets)).astype(np.int64), buckets, h, counts))
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in rows], pa.int32()), *(pa.array([p[k].tobytes() for _, p in rows], pa.binary()) for k in range(2))],
        names=["bucket", "hashes", "counts"],
    )


def score(docs: DataFrame, held_out, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without the text, and held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    rows = docs.drop("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "_block").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    training = rows.where(~F.col("held_out"))
    total = common.text_total(docs, text)
    blocks, buckets = common.bucket_count(spark, total, BLOCK_BYTES), common.bucket_count(spark, total, BUCKET_BYTES)
    known = common.written(token_counts(training, text, buckets))
    sizes = known.select(F.octet_length("hashes").alias("v"), F.col("counts").alias("c"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [int(np.frombuffer(c.as_buffer(), np.uint64).sum()) for c in batch.column("c")]
            yield pa.RecordBatch.from_arrays([pa.array([v // 8 for v in batch.column("v").to_pylist()], pa.int64()), pa.array(counts, pa.int64())], names=["v", "n"])

    sized = sizes.mapInArrow(sums, "v long, n long").agg(F.sum("v"), F.sum("n")).first()
    distinct, tokens_total = int(sized[0] or 0), int(sized[1] or 0)
    # A bucket has exact counts of its tokens and its part of the filter.
    have = known.withColumn("bits", F.lit(b"")).unionByName(
        common.written(frequency_filter(training, text, buckets)).select("bucket", F.lit(b"").alias("hashes"), F.lit(b"").alias("counts"), "bits")
    )

    placed = rows.withColumn("_block", F.pmod(F.xxhash64(doc_id, F.when(F.col(doc_id).isNull(), F.col(text))), F.lit(blocks)).cast("int"))

    def ask(key: tuple, group: pa.Table) -> pa.Table:
        tokens = np.concatenate([token_stream(d, o)[0] for _, d, o in common.pieces(group.select([text]).to_batches(), text)])
        h = np.unique(tokens)
        g = np.unique(np.concatenate([singles(h), pairs(tokens)]))
        words = dict(common.packed((h % np.uint64(buckets)).astype(np.int64), buckets, h))
        g = g[_in_order(g, buckets)]
        shorts = dict(common.packed(_range(g, buckets), buckets, _short(g)))
        to = sorted({*words, *shorts})
        return pa.table([
            pa.array(to, pa.int32()), pa.array([key[0].as_py()] * len(to), pa.int32()),
            *(pa.array([coded(kind[b][0], rising=True) if b in kind else b"" for b in to], pa.binary()) for kind in (words, shorts)),
        ], names=["bucket", "block", "hashes", "grams"])

    def answer(key: tuple, asked: pa.Table, have: pa.Table) -> pa.Table:
        hashes, counts = _joined(have, "hashes"), _joined(have, "counts")
        model = LogFrequencyFilter(1, {0: b"".join(have.column("bits").to_pylist())}, ranges=1)
        out, levels = [], []
        for x, y in zip(asked.column("hashes"), asked.column("grams"), strict=True):
            h, short = plain(x.as_buffer(), np.uint64, rising=True), plain(y.as_buffer(), np.uint32, rising=True)
            found = np.zeros(len(h), np.uint64)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                found = np.where(hashes[at] == h, counts[at], np.uint64(0))
            out.append(coded(found))
            levels.append(coded(model.levels(np.zeros(len(short), np.int64), short)))
        return pa.table([asked.column("block"), asked.column("bucket"), pa.array(out, pa.binary()), pa.array(levels, pa.binary())], names=["block", "bucket", "counts", "levels"])

    names = [c for c in rows.columns if c != text]
    below = tokens_total + ADDED * (distinct + 1)

    def scored(key: tuple, group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return empty
        streams = [(rows, *token_stream(d, o)) for rows, d, o in common.pieces(group.to_batches(), text)]
        answers = answers.sort_by("bucket")
        all_tokens = np.concatenate([t for _, t, _ in streams])
        h = np.unique(all_tokens)
        exact = np.zeros(len(h))
        exact[np.argsort((h % np.uint64(buckets)).astype(np.int64), kind="stable")] = _answered(answers, "counts", np.uint64)
        g, place = np.unique(np.concatenate([singles(h), pairs(all_tokens)]), return_inverse=True)
        levels = np.zeros(len(g), np.uint8)
        levels[_in_order(g, buckets)] = _answered(answers, "levels", np.uint8)
        estimate = counts_of(levels)
        alone, together = estimate[place[: len(h)]], estimate[place[len(h) :]]
        one = (alone + ADDED) / below
        parts, done = [], 0
        for rows, tokens, first in streams:
            at = np.searchsorted(h, tokens)
            own = one[at]
            history = alone[np.searchsorted(h, np.concatenate([[END], tokens[:-1]]))]
            both = np.minimum(together[done : done + len(tokens)], history)
            done += len(tokens)
            p = np.where(history > 0, (1 - WEIGHT) * own + WEIGHT * both / np.maximum(history, 1), own)
            begin = first[:-1]
            parts.append(pa.RecordBatch.from_arrays([
                *(rows.column(c) for c in names), pa.array(np.diff(first), pa.int64()),
                pa.array(np.add.reduceat((exact[at] > 0).astype(np.int64), begin)), pa.array([tokens_total] * rows.num_rows, pa.int64()),
                pa.array(np.add.reduceat(np.log10((exact[at] + ADDED) / below), begin)), pa.array(np.add.reduceat(np.log10(np.minimum(p, 1.0)), begin)),
            ], names=[*names, *_NEW]))
        return pa.Table.from_batches(parts)

    out = common.extended(rows.drop(text), "n_tokens long, n_known long, train_tokens long, base_score double, score double")
    empty = pa.Table.from_pylist([], _arrow(out))
    asked = placed.groupBy("_block").applyInArrow(ask, "bucket int, block int, hashes binary, grams binary")
    answers = asked.groupBy("bucket").cogroup(have.groupBy("bucket")).applyInArrow(answer, "block int, bucket int, counts binary, levels binary")
    return placed.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(scored, out)


_NEW = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, common.in_fold("doc_id", 10) == 0).select("doc_id", "held_out", *_NEW)
