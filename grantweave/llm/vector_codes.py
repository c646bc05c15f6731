"""Vector code compression: product codes from codebooks that ball k-means fits exactly.

A vector's scaled integer components are cut into parts; each part position has a codebook. An entry
and the parts anchored to it form a ball. Entries whose centres lie further away than twice the ball's
radius can't win one of its parts, so only the others are its neighbours. A part nearer to its anchor
than half the way to the anchor's nearest neighbour is in the stable core: it stays, and no distance is
computed. What lies outside is in the ring of its first few neighbours and is compared with those
alone. All of this is integer arithmetic, so the result is that of comparing every part with every entry.

The scaled vectors are written once, with the entry that each part belongs to: its anchor. A round reads them,
and tasks send one row of totals for each entry: only parts that left their anchor count, added to
the sums of the anchored ones. When more than REANCHOR of the parts have left, anchors are
written anew. What travels to the driver has the size of the codebooks.

Vectors that are null or empty, or hold null or non-finite components, are dropped; so are those of
another width than the first kept one (by id, nulls last, then by vector) and those with a scaled
component beyond largest(width), whose distances may pass 64 bits (at width 64 beyond 2^24, a component of 4,096). A width that parts don't divide gives the first parts a
component more; a part without components has code 0. Fewer than 16 kept vectors make smaller codebooks.
Rows that share an id or have none are coded like others. An empty table gives no rows. Extra columns
stay; the vector's column is replaced by its code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Share of parts outside their anchor's cell from which anchors are written anew.
REANCHOR = 0.25


def largest(width: int) -> int:
    """Scaled components up to this one keep four squared radii of a ball within 64 bits."""
    return isqrt((1 << 54) // max(width, 1))


def scaled(values) -> list[int]:
    return [int(np.floor(SCALE * float(x))) for x in values]


class Ball:
    """An entry's neighbours, nearest first, and four times the squared distance at which each comes in."""

    def __init__(self, book: np.ndarray, entry: int, radius: int | None):
        gaps = ((book - book[entry]) ** 2).sum(axis=1)
        near = np.argsort(gaps, kind="stable")
        near = near[near != entry]
        if radius is not None:
            near = near[gaps[near] <= 4 * radius * radius]
        self.near, self.gaps = near, gaps[near]


def nearest(parts: np.ndarray, anchors: np.ndarray, book: np.ndarray, balls: list[Ball]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the lower one, and the squared distance."""
    best = anchors.astype(np.int64)
    first = ((parts - book[best]) ** 2).sum(axis=1)
    least = first.copy()
    order = np.argsort(anchors, kind="stable")
    ends = np.searchsorted(anchors[order], np.arange(len(book) + 1))
    for entry, ball in enumerate(balls):
        rows = order[ends[entry] : ends[entry + 1]]
        ring = np.searchsorted(ball.gaps, 4 * first[rows], "right")
        for place, other in enumerate(ball.near):
            # The stable core falls out at once, then ring after ring.
            outside = ring > place
            rows, ring = rows[outside], ring[outside]
            if not len(rows):
                break
            d = ((parts[rows] - book[other]) ** 2).sum(axis=1)
            wins = (d < least[rows]) | (d == least[rows]) & (other < best[rows])
            best[rows[wins]], least[rows[wins]] = other, d[wins]
    return best, least


class Codebooks:
    """The entries of all part positions, and the balls around them."""

    def __init__(self, books: list[np.ndarray], radii: list[list[int]] | None = None):
        self.books = books
        self.balls = [[Ball(b, i, radii[p][i] if radii else None) for i in range(len(b))] for p, b in enumerate(books)]

    def assign(self, vectors: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [nearest(x, anchors[:, p], b, self.balls[p]) for p, (x, b) in enumerate(zip(cut(vectors), self.books, strict=True))]
        return np.stack([e for e, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def cut(vectors: np.ndarray) -> list[np.ndarray]:
    return np.array_split(vectors, PARTS, axis=1)


def _matrix(batch: pa.RecordBatch, column: str, kind) -> np.ndarray:
    data, _ = common.as_bytes(batch.column(column))
    return np.frombuffer(data.tobytes(), kind).reshape(batch.num_rows, -1)


def _rows(matrix: np.ndarray) -> pa.Array:
    each = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(0, each * len(matrix) + 1, each, dtype=np.int32) if each else np.zeros(len(matrix) + 1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    old = {n: batch.column(n) for n in batch.schema.names if n not in columns}
    return pa.RecordBatch.from_arrays([*old.values(), *columns.values()], names=[*old, *columns])


def _scaled_rows(kept: DataFrame, vector: str, width: int) -> DataFrame:
    """kept with _parts (scaled components) in place of the vector, and _anchors, all at entry 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(vector).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(SCALE * values.reshape(-1, width)).astype(np.int32)
            yield _with(batch.drop_columns([vector]), _parts=_rows(whole), _anchors=_rows(np.zeros((len(whole), PARTS), np.uint8)))

    return kept.mapInArrow(run, common.extended(kept.drop(vector), "_parts binary, _anchors binary"))


def _assigned(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple]:
    """(batch, vectors, anchors, entries, distances) of batches that have rows."""
    for batch in batches:
        if batch.num_rows:
            vectors, anchors = _matrix(batch, "_parts", np.int32).astype(np.int64), _matrix(batch, "_anchors", np.uint8)
            yield batch, vectors, anchors, *books.assign(vectors, anchors)


def _anchored(state: DataFrame, books: Codebooks) -> DataFrame:
    """The same rows, each part anchored to its nearest entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _, entries, _ in _assigned(batches, books):
            yield _with(batch, _anchors=_rows(entries.astype(np.uint8)))

    return common.written(state.select(*[c for c in state.columns if c != "_anchors"], "_anchors").mapInArrow(run, state.schema))


def _totals(state: DataFrame, books: Codebooks, moved: bool) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Counts and sums by part and entry, and the squared radius of each ball.

    With moved they are changes: parts that left their anchor count for the new entry and against the old.
    """
    widths = [b.shape[1] for b in books.books]
    size = len(books.books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, radii = np.zeros((PARTS, size), np.int64), np.zeros((PARTS, size), np.int64)
        sums = [np.zeros((size, w), np.int64) for w in widths]
        for _, vectors, anchors, entries, distances in _assigned(batches, books):
            for p, part in enumerate(cut(vectors)):
                old, new = anchors[:, p].astype(np.int64), entries[:, p]
                rows = np.flatnonzero(old != new) if moved else np.arange(len(old))
                for sign, to in ((1, new), (-1, old))[: 1 + moved]:
                    np.add.at(counts[p], to[rows], sign)
                    np.add.at(sums[p], to[rows], sign * part[rows])
                if not moved:
                    np.maximum.at(radii[p], new, distances[:, p])
        flat = np.concatenate([counts.ravel(), *[s.ravel() for s in sums], np.zeros(PARTS * size, np.int64)])
        top = np.concatenate([np.zeros(len(flat) - PARTS * size, np.int64), radii.ravel()])
        used = np.flatnonzero(flat | top)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(flat[used]), pa.array(top[used])], names=["slot", "total", "top"])

    sent = state.select("_parts", "_anchors").mapInArrow(run, "slot long, total long, top long")
    totals = np.zeros(PARTS * size * 2 + size * sum(widths), dtype=object)
    for r in sent.groupBy("slot").agg(F.sum("total").alias("total"), F.max("top").alias("top")).collect():
        totals[r.slot] = r.total + r.top
    counts, sums, at = totals[: PARTS * size].reshape(PARTS, size), [], PARTS * size
    for w in widths:
        sums.append(totals[at : at + size * w].reshape(size, w))
        at += size * w
    return counts, sums, totals[at:].reshape(PARTS, size)


def _root(x: int) -> int:
    """The square root, rounded up."""
    return isqrt(int(x) - 1) + 1 if x else 0


def fit(state: DataFrame, seeds: np.ndarray) -> tuple[DataFrame, Codebooks]:
    """The state with the latest anchors, and the codebooks after all rounds."""
    books = Codebooks([b.copy() for b in cut(seeds)])
    state = _anchored(state, books)
    counts, sums, radii = _totals(state, books, moved=False)
    then, moved_counts, moved_sums = books, 0 * counts, [0 * s for s in sums]
    for turn in range(ROUNDS):
        if turn:
            moved_counts, moved_sums, _ = _totals(state, books, moved=True)
            if np.abs(moved_counts).sum() / 2 > REANCHOR * counts.sum():
                state, then = _anchored(state, books), books
                counts, sums, radii = _totals(state, books, moved=False)
                moved_counts, moved_sums = 0 * counts, [0 * s for s in sums]
        new = []
        for p, b in enumerate(books.books):
            n = counts[p] + moved_counts[p]
            total = sums[p] + moved_sums[p]
            new.append(np.array([[int(x) // int(n[i]) for x in total[i]] if n[i] else b[i].tolist() for i in range(len(b))], np.int64).reshape(b.shape))
        shifts = [[_root(((new[p][i] - then.books[p][i]) ** 2).sum()) for i in range(len(b))] for p, b in enumerate(new)]
        books = Codebooks(new, [[_root(r) + s for r, s in zip(radii[p], shifts[p], strict=True)] for p in range(PARTS)])
    return state, books


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """vectors with code, error and label_error in place of the vector, and the codebooks (None without a kept vector)."""
    plain = vectors.drop(*({"code", "error", "label_error", "_parts", "_anchors"} - {vec_id, vector, label}))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = plain.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(finite)
    order = (F.col(vec_id).asc_nulls_last(), F.col(vector))
    first = kept.orderBy(*order).select(F.size(vector).alias("n")).first()
    spark, width = vectors.sparkSession, first.n if first else 0
    most = float(largest(width))
    kept = kept.where(F.size(vector) == width)
    kept = kept.where(F.forall(vector, lambda x: (x.cast("double") * SCALE >= -most) & (x.cast("double") * SCALE < most + 1)))
    seeds = [scaled(r[0]) for r in kept.orderBy(*order).select(vector).limit(ENTRIES).collect()]
    shape = common.extended(plain.drop(vector), "code string, error long")
    if not seeds:
        return spark.createDataFrame([], shape).withColumn("label_error", F.lit(0).cast("long")), None
    rest = [c for c in plain.columns if c != vector]
    state, books = fit(_scaled_rows(kept, vector, width), np.array(seeds, np.int64))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _, entries, distances in _assigned(batches, books):
            text = entries.astype(np.uint8).tobytes().hex()
            codes = pa.array([text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], codes, pa.array(distances.sum(axis=1))], names=[*rest, "code", "error"])

    codes = common.written(state.mapInArrow(coded, shape))
    by_label = codes.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col(label).eqNullSafe(F.col("_label"))).drop("_label"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, books = compress(vectors)
    digest = F.lit(books.digest() if books else None).cast("string")
    return codes.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql() -> str:
    """Every part against every entry, round by round."""
    gap = "list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for turn in range(ROUNDS + 1):
        steps.append(f"""
gap{turn} AS (SELECT a.i, a.p, b.e, {gap} AS d FROM part a JOIN book{turn} b USING (p)),
own{turn} AS MATERIALIZED (SELECT i, p, e, d FROM gap{turn} QUALIFY row_number() OVER (PARTITION BY i, p ORDER BY d, e) = 1)""")
        if turn < ROUNDS:
            steps.append(f"""
mean{turn} AS (
    SELECT p, e, list(m ORDER BY k) AS x FROM (
        SELECT p, e, k, CAST(floor(sum(a.x[k])::DOUBLE / count(*)) AS BIGINT) AS m
        FROM part a JOIN own{turn} USING (i, p), range(1, {PARTS} + 1) s(k) WHERE k <= len(a.x) GROUP BY ALL
    ) GROUP BY p, e
),
book{turn + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{turn} b LEFT JOIN mean{turn} m USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS i, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
part AS MATERIALIZED (
    SELECT i, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) s(p)
),
book0 AS (SELECT p, i - 1 AS e, x FROM part WHERE i <= {ENTRIES}),{",".join(steps)},
coded AS (
    SELECT i, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM own{ROUNDS} GROUP BY i
),
digest AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (i), digest
"""


OP12_SQL = _sql()
