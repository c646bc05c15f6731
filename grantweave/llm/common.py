"""Shared helpers: texts as byte arrays, hashes of byte ranges, written tables, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Texts are handled in pieces of about so many bytes, so a worker's memory doesn't grow with its split.
PIECE_BYTES = 2 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
WHITE_BYTES = bytes(np.flatnonzero(WHITE).astype(np.uint8))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()
#: Bytes of words between white space.
SPACED = ~WHITE
#: Bytes of words of digits, small letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BYTE_VALUES = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_unset: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which executors and driver share.

    Only where a local session names none, as in tests, it is a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _unset:
            _unset.append(tempfile.mkdtemp(prefix="checkpoints-"))
        root = _unset[0]
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: computed once, and cut from their lineage."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def extended(df: DataFrame, more: str) -> StructType:
    """The frame's schema and further columns."""
    return StructType([*df.schema.fields, *df.sparkSession.createDataFrame([], more).schema.fields])


def in_fold(column: str, modulus: int):
    """crc32 of the id as text, modulo; 0 marks the held-out fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins and ends (nulls: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    plain = plain.cast(pa.large_binary())
    _, places, data = plain.buffers()
    offsets = np.frombuffer(places, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE_BYTES) -> Iterator[tuple]:
    """(rows, bytes, offsets) for runs of rows whose texts have about size bytes together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = as_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RangeHash:
    """64-bit hashes of byte ranges of one array, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * powers[:n], out=self.sums[1:])
        back = np.full(n + 1, _BASE_INVERSE, np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(h + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of kept bytes that stay within a text, and each text's first run."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = keep[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edge] = inside[edge]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word in lower case (A-Z only), and each text's first word."""
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offsets, keep)
    return RangeHash(low).of(starts, ends), first


def packed(buckets: np.ndarray, count: int, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(bucket, columns' rows of it) for each bucket that has rows; the order within is kept."""
    order = np.argsort(buckets, kind="stable")
    ends = np.searchsorted(buckets[order], np.arange(count + 1))
    columns = [c[order] for c in columns]
    for b in np.flatnonzero(np.diff(ends)):
        yield int(b), [c[ends[b] : ends[b + 1]] for c in columns]


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def reached(count: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each of count rows the first row that links reach, itself included.

    linked(row, others) tells which others a row links with. Rows that are reached are never asked
    about again, so a group of copies takes about one question for each row.
    """
    label, left = np.arange(count), np.arange(count)
    while len(left):
        first, left = left[0], left[1:]
        queue = [int(first)]
        while queue and len(left):
            hit = linked(queue.pop(), left)
            label[left[hit]] = first
            queue += left[hit].tolist()
            left = left[~hit]
    return label


def cells(rows: DataFrame, key: str, member: str, most: int) -> DataFrame:
    """rows with cell: a key's rows share one, or if there are more than so many, every pair of chunks does."""
    large = rows.groupBy(key).count().where(F.col("count") > most)
    large = large.select(key, F.ceil(F.col("count") / (most // 2)).cast("int").alias("_chunks"))
    placed = rows.join(large, key, "left").withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
    placed = placed.withColumn("_own", F.pmod(F.xxhash64(member), "_chunks").cast("int"))
    others = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    cell = F.struct(key, F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"))
    return others.withColumn("cell", F.xxhash64(cell)).drop("_chunks", "_own", "_other")


def by_cell(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each cell from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
        new = np.zeros(max(batch.num_rows - 1, 0), bool)
        for v in values:
            new |= v[1:] != v[:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and not all(held[-1].column(c)[0].equals(part.column(c)[0]) for c in keys):
                yield pa.Table.from_batches(held)
                held = []
            if part.num_rows:
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def bucket_count(spark: SparkSession, total_bytes: int, each: int = 16 << 20) -> int:
    """Buckets so that each gets a bounded share, and at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // each), 1)


def text_total(docs: DataFrame, column: str = "text") -> int:
    return int(docs.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node that edges (a, b) reach, for nodes that have edges.

    Alternating large and small stars; every round is written to the shared folder, so lost
    executors cost no more than a round. Hot nodes are aggregated before they are shuffled.
    """
    links = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(root.select("u", F.col("m").alias("v")))
        links = written(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
