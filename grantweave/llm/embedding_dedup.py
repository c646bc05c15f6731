"""Embedding near-dedup with spherical-cap filters from structured random product codes.

A filter is a direction: one codeword of each of four random codes over blocks of the turned vector.
A vector passes the filters whose inner product exceeds a bound; list decoding finds them from the
blocks' sorted scores without trying all products, and each vector passes a number of its best ones in
any case. Vectors near each other pass many filters together. The bound follows from the number of
vectors of a width, so that a filter gets about LOAD of them at every size. So does the number of
filters: random pairs at the least cosine are tried, and it grows until fewer than MOST_LOST of them
share no filter, at every size and width.

Equal vectors are one class first. Classes that share a filter meet there, and all their cosines are
computed in double precision. A pair counts only in the smallest filter that both pass, so sums over
filters count each link once; no pair leaves a task, only each class's links and one edge to the
smallest class that it reaches in the filter. Filters with more than CELL classes are cut into chunks whose pairs are cells of their own.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows
without an id, whose component is null. Vectors of different lengths never link. Repeated rows link
with each other if their ids differ; rows of one id count once as its links' ends. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

LEAST_COSINE = 0.95
#: Classes that a filter gets on average.
LOAD = 32
#: Share of pairs at the least cosine that may be lost, and the random pairs that are tried.
MOST_LOST, TRIALS = 0.005, 2000
#: Blocks, of two components at least: in one dimension all codewords of a side are the same.
BLOCKS = 4
#: Classes of a filter that one cell compares.
CELL = 1500


class ProductCode:
    """Filters that get such a share of the vectors; each vector passes at least so many filters."""

    def __init__(self, width: int, filters: int, share: float, seed: int = 5):
        self.filters = filters
        rng = np.random.default_rng([seed, width])
        self.blocks = np.array_split(np.arange(width), min(BLOCKS, max(1, width // 2)))
        self.size = max(2, int(np.ceil((filters / share) ** (1 / len(self.blocks)))))
        # Components of a turned unit vector are about normal with variance 1 / width.
        self.bound = NormalDist().inv_cdf(1 - share) / np.sqrt(width)
        self.turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        self.codes = []
        for b in self.blocks:
            words = rng.normal(size=(self.size, len(b)))
            self.codes.append(words / np.linalg.norm(words, axis=1, keepdims=True) / np.sqrt(len(self.blocks)))

    def decode(self, v: np.ndarray) -> np.ndarray:
        """Sorted numbers of the filters that a unit vector passes."""
        scores = [c @ (self.turn @ v)[b] for b, c in zip(self.blocks, self.codes, strict=True)]
        half = len(scores) // 2 or 1
        left, right = self._sums(scores[:half]), self._sums(scores[half:])
        order = np.argsort(-right)
        high = right[order]
        bound = self.bound
        while True:
            # For each left part, the right parts that lift it over the bound are a beginning of the list.
            counts = np.searchsorted(-high, left - bound, "right")
            if counts.sum() >= min(self.filters, len(left) * len(right)):
                break
            bound -= 0.05 * abs(self.bound) + 1e-3
        a = np.repeat(np.arange(len(left)), counts)
        b = order[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
        if bound < self.bound:
            best = np.argsort(-(left[a] + right[b]), kind="stable")[: max(self.filters, int((left[a] + right[b] >= self.bound).sum()))]
            a, b = a[best], b[best]
        return np.sort(a * len(right) + b)

    @staticmethod
    def _sums(scores: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(1)
        for s in scores:
            total = (total[:, None] + s[None, :]).ravel()
        return total


@lru_cache(None)
def filters_needed(width: int, vectors: int, least: float) -> tuple[int, float]:
    """Filters a vector must pass so that pairs at the least cosine are lost less often than MOST_LOST, and their share.

    Where vectors are so narrow that caps of the share hardly meet, more filters don't help; the share doubles.
    """
    share = min(0.2, LOAD / max(vectors, 1))
    if vectors < 2:
        return 1, share
    rng = np.random.default_rng([11, width])
    a, other = _units(rng.normal(size=(TRIALS, width))), rng.normal(size=(TRIALS, width))
    other -= (a * other).sum(axis=1, keepdims=True) * a
    # In one dimension two vectors are alike or opposite.
    b = least * a + np.sqrt(max(0.0, 1 - least * least)) * _units(other) if width > 1 else a
    filters = 16
    while True:
        code, lost = ProductCode(width, filters, share), 0
        for x, y in zip(a, b, strict=True):
            lost += not np.isin(code.decode(x), code.decode(y), assume_unique=True).any()
            # Two deviations above what was seen.
            if lost + 2 * np.sqrt(lost + 1) > MOST_LOST * TRIALS:
                break
        else:
            return filters, share
        filters = -(-filters * 5 // 4)
        if filters > 512 and share < 0.5:
            filters, share = 16, min(0.5, 2 * share)


def _unit(values) -> np.ndarray | None:
    """The vector at length 1, or None if it can't link."""
    if values is None or len(values) == 0 or any(x is None for x in values):
        return None
    v = np.asarray(values, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / np.linalg.norm(v)


def _units(raw: np.ndarray) -> np.ndarray:
    """Rows at length 1, in double precision."""
    raw = raw.astype(np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _kind(vectors: DataFrame, embedding: str) -> type:
    """Number type of vectors in postings: no wider than needed."""
    return np.float32 if vectors.schema[embedding].dataType.elementType.typeName() == "float" else np.float64


def _plan(reps: DataFrame, kind: type, least: float) -> tuple[dict[int, tuple[int, float]], type]:
    """(filters, share) for each width, and the number type of filters in postings."""
    counts = reps.groupBy(F.octet_length("raw").alias("bytes")).count().collect()
    sizes = {r["bytes"] // np.dtype(kind).itemsize: r["count"] for r in counts}
    plan = {w: filters_needed(w, n, least) for w, n in sizes.items()}
    most = max((code.size ** len(code.blocks) for w, p in plan.items() for code in [ProductCode(w, *p)]), default=0)
    return plan, (np.uint32 if most < 2**31 else np.int64)


def classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """The rows without the vector, and digest and raw (the vector's bytes), null where it can't link."""
    names = [c for c in vectors.columns if c != embedding]
    kind = _kind(vectors, embedding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(embedding).to_pylist()
            digests = [None if (u := _unit(v)) is None else xxhash.xxh3_128_digest(u.tobytes()) for v in values]
            found = [None if d is None else np.asarray(v, kind).tobytes() for v, d in zip(values, digests, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(digests, pa.binary()), pa.array(found, pa.binary())], names=[*names, "digest", "raw"])

    return vectors.mapInArrow(run, common.extended(vectors.drop(embedding), "digest binary, raw binary"))


def postings(reps: DataFrame, plan: dict[int, tuple[int, float]], kinds: tuple[type, type]) -> DataFrame:
    """(filter, rep, copies, raw, filters) for each filter that a class passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            filters, keys, row = [], [], []
            for i, raw in enumerate(batch.column("raw")):
                v = _units(np.frombuffer(raw.as_buffer(), kinds[0])[None, :])[0]
                if len(v) not in codes:
                    codes[len(v)] = ProductCode(len(v), *plan[len(v)])
                filters.append(codes[len(v)].decode(v))
                # The vector's length keeps filters of different lengths apart.
                keys.append(filters[-1] + (len(v) << 40))
                row.append(np.full(len(filters[-1]), i))
            if not filters:
                continue
            lists = pa.array([f.astype(kinds[1]).tobytes() for f in filters], pa.binary())
            row = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), *(batch.column(c).take(row) for c in ("rep", "copies", "raw")), lists.take(row)],
                names=["filter", "rep", "copies", "raw", "filters"],
            )

    kind = reps.schema["rep"].dataType.simpleString()
    return reps.mapInArrow(run, f"filter long, rep {kind}, copies long, raw binary, filters binary")


def _cell(ids: np.ndarray, copies: np.ndarray, units: np.ndarray, lists: list[np.ndarray], own: int, side: np.ndarray, least: float):
    """(row, links, smallest id reached) of the rows that have a link. side: 0 or 1 in cells of two chunks, else 2."""
    close = units @ units.T >= least
    np.fill_diagonal(close, False)
    if side.min() < 2:
        close &= side[:, None] != side[None, :]
    rows = np.flatnonzero(close.any(axis=1))
    if not len(rows):
        return rows, rows, rows
    close = close[np.ix_(rows, rows)]
    smaller = [x[x < own] for x in (lists[r] for r in rows)]
    names, at = np.unique(np.concatenate(smaller), return_inverse=True)
    passes = np.zeros((len(rows), len(names)), np.float32)
    passes[np.repeat(np.arange(len(rows)), [len(x) for x in smaller]), at] = 1
    first = close & (passes @ passes.T == 0) if len(names) else close
    # Every row's smallest reachable id within the cell: neighbours' labels until none changes.
    label, before = ids[rows], None
    while before is None or (label != before).any():
        before = label
        label = np.minimum(label, np.where(close, label, label.max()).min(axis=1))
    return rows, (first @ copies[rows].astype(np.float64)).astype(np.int64), label


def links(posts: DataFrame, least: float, kinds: tuple[type, type]) -> DataFrame:
    """(rep, links, partner) by filter and cell."""
    counts = posts.groupBy("filter").count()
    large = counts.where(F.col("count") > CELL).select("filter", F.ceil(F.col("count") / (CELL // 2)).cast("int").alias("chunks"))
    placed = posts.join(large, "filter", "left").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.coalesce("chunks", F.lit(1))).cast("int"))
    others = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)
    cells = placed.withColumn("other", F.explode(others)).select(
        "filter", F.least("chunk", "other").cast("int").alias("low"), F.greatest("chunk", "other").cast("int").alias("high"), "chunk", "rep", "copies", "raw", "filters"
    )
    dealt = cells.repartition("filter", "low", "high").sortWithinPartitions("filter", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(table: pa.Table) -> pa.RecordBatch | None:
            if table.num_rows < 2:
                return None
            own, low, high = (table.column(c)[0].as_py() for c in ("filter", "low", "high"))
            units = _units(np.frombuffer(b"".join(table.column("raw").to_pylist()), kinds[0]).reshape(table.num_rows, -1))
            lists = [np.frombuffer(x.as_buffer(), kinds[1]) for x in table.column("filters")]
            chunk = table.column("chunk").to_numpy()
            side = np.where(chunk == low, 0, 1) if low < high else np.full(len(chunk), 2)
            ids, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
            rows, found, partner = _cell(ids, copies, units, lists, own & ((1 << 40) - 1), side, least)
            return pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(found), pa.array(partner)], names=["rep", "links", "partner"]) if len(rows) else None

        for table in common.by_cell(batches, ["filter", "low", "high"]):
            if done := solved(table):
                yield done

    kind = posts.schema["rep"].dataType.simpleString()
    return dealt.mapInArrow(run, f"rep {kind}, links long, partner {kind}")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = LEAST_COSINE) -> DataFrame:
    """The rows without the vector, and n_links, component_id, kept (first of its component)."""
    plain = vectors.drop("digest", "raw", "n_links", "component_id", "kept")
    signed = common.written(classes(plain, vec_id, embedding))
    usable = signed.where(F.col("digest").isNotNull() & F.col(vec_id).isNotNull())
    reps = common.written(
        usable.groupBy("digest").agg(F.min(vec_id).alias("rep"), F.countDistinct(vec_id).alias("copies"), F.min("raw").alias("raw"))
    )
    kind = _kind(plain, embedding)
    plan, number = _plan(reps, kind, least)
    kinds = kind, number
    found = common.written(links(postings(reps.select("rep", "copies", "raw"), plan, kinds), least, kinds))
    groups = common.components(found.select(F.col("rep").alias("a"), F.col("partner").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("links").alias("n"))
    of = reps.select("digest", "rep", "copies").join(sums, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
    of = of.select(F.col("digest").alias("_digest"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_links"), F.coalesce("component", "rep").alias("_component"))
    component = F.when(F.col(vec_id).isNotNull(), F.coalesce("_component", vec_id))
    return signed.join(of, F.col("digest") == F.col("_digest"), "left").select(
        *(c for c in plain.columns if c != embedding),
        F.when(F.col(vec_id).isNotNull(), F.coalesce("_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col(vec_id) == component, F.lit(True)).alias("kept"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")
