"""Ranked lexical search: accumulator-limited, a term at a time, over an index for each shard.

A shard is a run of whole documents of a few MB. Its index has, for each term of the queries that it
holds, the documents and how often they hold it. It is written once; the numbers of documents, terms
and documents for each term are added up over all shards, and then every shard answers all queries.

A query's terms are taken rarest first. A document gets an accumulator when one of its terms comes up.
As soon as the terms left can add less, at their best in the shard, than the kth partial score so far,
or than the kth score that the task has seen in earlier shards, no new accumulator can win, so none is made; those that
exist are still updated exactly, and dropped when even the best rest leaves them behind. Each shard
sends at most k rows for each query; Spark merges them in two steps.

Queries travel by broadcast in blocks of bounded size; with more than one block the documents
are indexed once for each.

Null, empty and termless texts hold no term: such documents don't count, such queries find nothing. Equal
scores rank by ascending id, nulls last. Each row of the queries is answered for itself, also if
rows share an id or have none; each row of the documents is one document. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantweave.llm import common
from grantweave.operators.dedup import keep_top

BEST = 10
#: Bytes of texts in a shard, of a piece that is split into words at once, and of queries in one broadcast block.
SHARD_BYTES, WINDOW_BYTES, BLOCK_BYTES = 8 << 20, 1 << 20, 16 << 20
#: A query's candidates are merged in so many groups first.
GROUPS = 64
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode().translate(common.LOWER_BYTES))


class Vocabulary:
    """The terms of the queries, in the order of their hashes."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        starts = ends - np.array([len(t) for t in terms], np.int64)
        hashes = common.RangeHash(data).of(starts, ends)
        order = np.lexsort((ends - starts, hashes))
        self.terms = [terms[i] for i in order]
        self.data, self.starts, self.ends, self.hashes = data, starts[order], ends[order], hashes[order]

    def find(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of the term that each range of bytes is, or -1. Equal hashes are compared byte by byte."""
        found = np.full(len(starts), -1, np.int64)
        hashes = common.RangeHash(low).of(starts, ends)
        at = np.searchsorted(self.hashes, hashes)
        rows = np.flatnonzero(at < len(self.hashes))
        while len(rows):
            term = at[rows]
            rows = rows[self.hashes[term] == hashes[rows]]
            term = at[rows]
            lengths = ends[rows] - starts[rows]
            same = lengths == self.ends[term] - self.starts[term]
            long, short = rows[same], term[same]
            sizes = lengths[same]
            if len(long):
                equal = low[common.runs(starts[long], sizes)] == self.data[common.runs(self.starts[short], sizes)]
                whole = np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)
                found[long[whole]] = short[whole]
            # Another term may have the same hash.
            at[rows] += 1
            rows = rows[(found[rows] < 0) & (at[rows] < len(self.hashes))]
        return found


def windows(data: np.ndarray, size: int = WINDOW_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of about size bytes that end between words."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data):
            gaps = np.flatnonzero(~common.ALNUM[data[end - 1 : end - 1 + size]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + size, len(data))
        yield at, end
        at = end


def counted(data: np.ndarray, offsets: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, ...]:
    """Terms of each text, and (term, text, times) of those known, by term and text."""
    low, n = common.LOWER[data], len(offsets) - 1
    lengths, keys = np.zeros(n, np.int64), [np.zeros(0, np.int64)]
    for a, b in windows(low):
        own = np.clip(offsets, a, b) - a
        starts, ends, first = common.word_bounds(low[a:b], own, common.ALNUM)
        lengths += np.diff(first)
        found = known.find(low[a:b], starts, ends)
        text = np.repeat(np.arange(n), np.diff(first))
        hit = found >= 0
        keys.append(found[hit] * n + text[hit])
    keys, times = np.unique(np.concatenate(keys), return_counts=True)
    return lengths, keys // max(n, 1), keys % max(n, 1), times


_INDEX = "n_docs long, n_terms long, lengths binary, terms binary, counts binary, places binary, times binary"


def index(docs: DataFrame, doc_id: str, text: str, known) -> DataFrame:
    """A row for each shard: ids and lengths of its documents that hold a term, and postings by term."""
    kind = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def shard():
            ids = pa.concat_arrays([i for i, *_ in held])
            before = np.cumsum([0, *[len(i) for i, *_ in held]])
            lengths = np.concatenate([x[1] for x in held])
            term = np.concatenate([x[2] for x in held])
            text = np.concatenate([x[3] + b for x, b in zip(held, before, strict=False)])
            times = np.concatenate([x[4] for x in held])
            order = np.lexsort((text, term))
            # Documents without a query term only count.
            named, text = np.unique(text[order], return_inverse=True)
            terms, counts = np.unique(term[order], return_counts=True)
            cells = [lengths[named], terms, counts, text, times[order]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.take(pa.array(named)).to_pylist()], pa.list_(ids.type)),
                    pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                    *[pa.array([c.astype(np.int64 if i == 0 else np.int32).tobytes()], pa.binary()) for i, c in enumerate(cells)],
                ],
                names=["ids", "n_docs", "n_terms", "lengths", "terms", "counts", "places", "times"],
            )

        for rows, data, offsets in common.pieces(batches, text, common.PIECE_BYTES):
            held.append((rows.column(doc_id), *counted(data, offsets, known.value)))
            size += len(data)
            if size >= SHARD_BYTES:
                yield shard()
                held, size = [], 0
        if held:
            yield shard()

    return common.written(docs.select(doc_id, text).mapInArrow(run, f"ids array<{kind.simpleString()}>, {_INDEX}"))


def _numbers(value: pa.Scalar, kind=np.int32) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind).astype(np.int64)


def document_counts(shards: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms"), batch.column("counts"), strict=True):
                total[_numbers(terms)] += _numbers(counts)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["term", "df"])

    found = np.zeros(size, np.int64)
    for r in shards.select("terms", "counts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        found[r.term] = r.df
    return found


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Shard:
    """Postings of one shard with what each adds to a score."""

    def __init__(self, n_docs: int, terms: np.ndarray, counts: np.ndarray, places: np.ndarray, added: np.ndarray):
        self.n = n_docs
        ends = np.cumsum(counts)
        self.of = {int(t): (int(e - c), int(e)) for t, c, e in zip(terms, counts, ends, strict=True)}
        self.places, self.added = places, added
        self.most = dict(zip(terms.tolist(), np.maximum.reduceat(added, ends - counts).tolist(), strict=True)) if len(terms) else {}

    def best(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the k best, and their scores. query: (term, times), rarest first.

        Only scores of at least floor and above 0 matter.
        """
        query = [(t, times) for t, times in query if self.most.get(t)]
        bounds = [times * self.most[t] for t, times in query]
        rest = sum(bounds)
        scores, alive, open_to_new = np.zeros(self.n, np.int64), np.zeros(0, np.int64), True
        for (term, times), bound in zip(query, bounds, strict=True):
            a, b = self.of[term]
            places, added = self.places[a:b], self.added[a:b]
            least = max(floor, _kth(scores[alive], k))
            if open_to_new and rest < least:
                open_to_new = False
            if open_to_new:
                alive = places if not len(alive) else np.union1d(alive, places)
                scores[places] += times * added
            else:
                # Survivors only; those that can't come back are dropped.
                alive = alive[scores[alive] + rest >= least]
                if not len(alive):
                    break
                at = np.minimum(np.searchsorted(places, alive), len(places) - 1)
                scores[alive] += np.where(places[at] == alive, times * added[at], 0)
            rest -= bound
        alive = alive[scores[alive] >= max(floor, _kth(scores[alive], k), 1)]
        return alive, scores[alive]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) if d else 0 for d in df], np.int64)


def _answers(shards: DataFrame, stated, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """(_query, doc_id, score): what each shard has for each query. stated: broadcast (weights, queries)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries = stated.value
        seen = [np.zeros(0, np.int64)] * len(queries)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                terms, counts, places = (_numbers(row[c]) for c in ("terms", "counts", "places"))
                m = 25 + 75 * _numbers(row["lengths"], np.int64) * n_docs // max(n_terms, 1)
                times = _numbers(row["times"])
                added = np.repeat(weight[terms], counts) * (1_000_000_000 * times // (1000 * times + 8 * m[places]))
                shard = Shard(len(m), terms, counts, places, added)
                ids = row["ids"].values
                # Equal scores rank by id, nulls last.
                order = np.empty(len(ids), np.int64)
                order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                found, docs, scores = [], [], []
                for q, query in enumerate(queries):
                    floor = int(seen[q][0]) if len(seen[q]) == best else 0
                    alive, score = shard.best(query, best, floor)
                    if not len(alive):
                        continue
                    top = np.lexsort((order[alive], -score))[:best]
                    seen[q] = np.sort(np.concatenate([seen[q], score[top]]))[-best:]
                    found.append(np.full(len(top), q))
                    docs.append(alive[top])
                    scores.append(score[top])
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found), pa.int64()), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))],
                        names=["_query", "doc_id", "score"],
                    )

    kind = shards.schema["ids"].dataType.elementType.simpleString()
    columns = ["ids", "lengths", "terms", "counts", "places", "times"]
    return shards.select(*columns).mapInArrow(run, f"_query long, doc_id {kind}, score long")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", best: int = BEST,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's best documents, under the tables' own names of the ids' columns."""
    spark = docs.sparkSession
    size = items.agg(F.coalesce(F.sum(F.octet_length(text) + 16), F.lit(0))).first()[0]
    blocks, results, asked = max(1, -(-int(size) // BLOCK_BYTES)), [], 0
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    kind = items.schema[item_id].dataType
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64(item_id, text), F.lit(blocks)) == block).select(item_id, text).collect()
        queries = [Counter(terms_of(r[1])) for r in own]
        known = Vocabulary(sorted(set().union(*queries)))
        shards = index(docs, doc_id, text, spark.sparkContext.broadcast(known))
        n_docs, n_terms = (int(x or 0) for x in shards.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        df = document_counts(shards, len(known.terms))
        number = {t: i for i, t in enumerate(known.terms)}
        rarest_first = [sorted(((number[t], c) for t, c in q.items() if df[number[t]]), key=lambda x: (df[x[0]], x[0])) for q in queries]
        stated = spark.sparkContext.broadcast((weights(n_docs, df), rarest_first))
        found = _answers(shards, stated, n_docs, n_terms, best)
        # Two steps, so that no task gets a query's rows of all shards.
        group = F.pmod(F.spark_partition_id(), F.lit(GROUPS))
        found = keep_top(common.written(found.withColumn("_group", group)), ["_query", "_group"], order, best)
        names = spark.createDataFrame([(i, asked + i, r[0]) for i, r in enumerate(own)], f"_query long, _row long, _item {kind.simpleString()}")
        results.append(found.join(names, "_query").select("_row", "_item", "doc_id", "score"))
        asked += len(own)
    rank = F.row_number().over(Window.partitionBy("_row").orderBy(*order))
    found = reduce(DataFrame.union, results).withColumn("rank", rank).where(F.col("rank") <= best)
    return found.select(F.col("_item").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, common.table(spark, sf_dir, "benchmark").select("item_id", "text"))


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP11_SQL = rf"""
WITH doc AS MATERIALIZED (
    SELECT doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0
),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM doc),
held AS MATERIALIZED (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM doc) GROUP BY ALL
),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM held, total GROUP BY term, docs
),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN weight USING (term) JOIN held USING (term), total GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {BEST}
"""
