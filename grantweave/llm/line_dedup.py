"""Line dedup with two Bloom filters, for keys seen once and keys seen twice.

A line's key is the line without white space at its ends, A-Z in lower case. First each task sends
the 64-bit hashes of its keys, at most twice each, packed by segment of the hash range. A segment's
task reads them in turn: a hash already in the once-filter enters the twice-filter. The twice-filters,
whose sizes have a fixed bound, are broadcast. Then only keys that the twice-filter knows are written
and compared as whole keys: a filter that is too full makes more suspects, never a wrong result.

Null and empty texts are one empty line. Rows without an id are kept as they are and count as no
document; rows that share an id are one document. Repeated rows stay repeated. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

SEGMENTS = 64
PROBES = 3
#: Bits for each hash of a segment, and the most bytes that all twice-filters have together.
BITS_PER_HASH = 16
MAX_FILTER_BYTES = 64 << 20
#: Hashes that a map task holds before it sends them on.
FLUSH = 1 << 20


def line_keys(text: str | None, least: int) -> list[bytes | None]:
    """The key of each line, or None where it has fewer than so many code points."""
    found = []
    for line in (text or "").encode().translate(common.LOWER_BYTES).split(b"\n"):
        key = line.strip(common.WHITE_BYTES)
        long_enough = len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least
        found.append(key if long_enough else None)
    return found


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit places of each hash; bits is a power of two."""
    step = common.mix(hashes) | np.uint64(1)
    for i in range(PROBES):
        yield (hashes + np.uint64(i) * step) >> np.uint64(8) & np.uint64(bits - 1)


class Bloom:
    def __init__(self, bits: int, data: bytes | None = None):
        self.bits = bits
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for p in _places(hashes, self.bits):
            np.bitwise_or.at(self.data, (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for p in _places(hashes, self.bits):
            found &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def _segment(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SEGMENTS - 1)).astype(np.int64)


def twice_filters(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """(segment, bits, twice): one filter of the keys seen in at least two documents."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            values = np.repeat(values, np.minimum(counts, 2))
            parts = [(s, h.tobytes()) for s, (h,) in common.packed(_segment(values), SEGMENTS, values)]
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in parts], pa.int32()), pa.array([h for _, h in parts], pa.binary())], names=["segment", "hashes"])

        for batch in batches:
            for value in batch.column(text).to_pylist():
                keys = {k for k in line_keys(value, least) if k is not None}
                held.append(_hashes(keys))
                size += len(keys)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    most = 1 << (MAX_FILTER_BYTES // SEGMENTS * 8).bit_length() - 1

    def filtered(key: tuple, group: pa.Table) -> pa.Table:
        lists = [x.as_buffer() for x in group.column("hashes")]
        total = sum(x.size for x in lists) // 8
        bits = min(max(1024, 1 << (total * BITS_PER_HASH - 1).bit_length()), most)
        once, twice = Bloom(bits), Bloom(bits)
        for x in lists:
            values, counts = np.unique(np.frombuffer(x, np.uint64), return_counts=True)
            twice.add(values[(counts > 1) | once.has(values)])
            once.add(values)
        return pa.table(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([bits], pa.int64()), pa.array([twice.data.tobytes()], pa.binary())],
            names=["segment", "bits", "twice"],
        )

    hashed = docs.where(F.col(doc_id).isNotNull()).select(text).mapInArrow(sent, "segment int, hashes binary")
    return hashed.groupBy("segment").applyInArrow(filtered, "segment int, bits long, twice binary")


def suspects(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """(id, digest, key) of the keys that some twice-filter knows, once for each document's row."""
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast({r.segment: (r.bits, bytes(r.twice)) for r in twice_filters(docs, doc_id, text, least).collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {s: Bloom(bits, data) for s, (bits, data) in filters.value.items()}
        for batch in batches:
            ids, found = [], []
            for i, value in enumerate(batch.column(text).to_pylist()):
                keys = list({k for k in line_keys(value, least) if k is not None})
                ids += [i] * len(keys)
                found += keys
            if not found:
                continue
            hashes, hit = _hashes(found), np.zeros(len(found), bool)
            segments = _segment(hashes)
            for s in np.unique(segments):
                of = segments == s
                hit[of] = known[s].has(hashes[of]) if s in known else False
            keys = [found[i] for i in np.flatnonzero(hit)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(doc_id).take(pa.array(np.array(ids, np.int64)[hit])),
                    pa.array([xxhash.xxh3_128_digest(k) for k in keys], pa.binary()),
                    pa.array(keys, pa.binary()),
                ],
                names=["id", "digest", "key"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.where(F.col(doc_id).isNotNull()).select(doc_id, text).mapInArrow(run, f"id {kind}, digest binary, key binary")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """Adds n_lines and n_dropped, and replaces the text by the lines that stay.

    Keys of at least so many code points that are in several documents stay only in the document
    with the smallest id. A text that loses no line stays as it is (null too).
    """
    found = common.written(suspects(docs, doc_id, text, least))
    first = found.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min("digest").alias("digest"))
    repeated = first.where("first < last").select("digest", "first")
    drops = found.select("id", "digest").join(repeated, "digest").where("id <> first")
    drops = drops.groupBy("id").agg(F.array_distinct(F.collect_list("digest")).alias("_drops"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, dropped, kept = [], [], []
            for value, drop in zip(batch.column(text).to_pylist(), batch.column("_drops").to_pylist(), strict=True):
                counts.append((value or "").count("\n") + 1)
                gone = 0
                if drop:
                    drop = set(drop)
                    stay = [k is None or xxhash.xxh3_128_digest(k) not in drop for k in line_keys(value, least)]
                    gone = len(stay) - sum(stay)
                    value = "\n".join(line for line, keep in zip(value.split("\n"), stay, strict=True) if keep)
                dropped.append(gone)
                kept.append(value)
            made = {text: pa.array(kept, pa.string()), "n_lines": pa.array(counts, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names=names)

    plain = docs.drop("_drops", "n_lines", "n_dropped")
    names = [*plain.columns, "n_lines", "n_dropped"]
    joined = plain.join(drops.withColumnRenamed("id", "_id"), F.col(doc_id) == F.col("_id"), "left").drop("_id")
    return joined.mapInArrow(run, common.extended(plain, "n_lines long, n_dropped long"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = rf"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, i, parts[i] AS line,
        {_SMALL.format("trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split)
), repeated AS (
    SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT l.*, r.key IS NOT NULL AND l.doc_id <> r.first AS gone FROM lines l LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
