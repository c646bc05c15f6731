"""MinHash near-dedup by an inverted join over signature coordinates, with exact confirmation.

Every document with words gets the set of its word shingles and a signature of COORDINATES minima.
Equal sets collapse to their smallest id. What two sets of similarity 0.8 share follows a binomial
law: they agree in fewer than MATCHES of 32 coordinates once in two million pairs, and MATCHES is the
threshold. Documents are posted under coordinate-value pairs, two coordinates at a time: with 12
groups of coordinates, 13 agreements put two into one group, so posting the pairs of coordinates
within groups (the prefix) misses nothing above the threshold, and lists that only one shared
coordinate would make long are skipped.

Within a list, members whose signatures agree often enough are put into one family; families that
share a member grow together over all lists. Then each family meets once with its full sets, and
exact similarities decide which members are linked. Neither step makes rows for pairs: both ask for
the members that are not reached yet, so a group of copies costs about one comparison a member, and
give each member's first. Lists and families beyond a size are cut into chunks whose pairs are compared.

Texts that are null or have no words have an empty set and link with nothing, nor do rows without an
id, whose component is null and which are kept. Rows that share an id must share
their text: they are one document. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

COORDINATES = 32
MATCHES = 13
#: Coordinates in MATCHES - 1 groups of two or three, and the pairs within them.
GROUPS = np.array_split(np.arange(COORDINATES), MATCHES - 1)
PREFIX = np.array([(int(a), int(b)) for g in GROUPS for k, a in enumerate(g) for b in g[k + 1 :]])
_ODD = np.random.default_rng(97).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and each text's first; a text of fewer words has one of all its words."""
    words, first = common.word_hashes(data, offsets, common.SPACED)
    counts = np.diff(first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(first[:-1] - begin[:-1], made) + np.arange(begin[-1])
    width = np.repeat(np.minimum(counts, size), made)
    h = words[at]
    for k in range(1, size):
        more = common.mix(h * np.uint64(0x9E3779B97F4A7C15) ^ words[np.minimum(at + k, len(words) - 1)])
        h = np.where(width > k, more, h)
    return h, begin


def distinct_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    h, begin = shingles(data, offsets, size)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        yield np.unique(h[a:b])


def signatures(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """docs without the text, and n_shingles, set_key, signature (null for empty sets)."""
    names = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in common.pieces(batches, text):
            sets = list(distinct_sets(data, offsets, size))
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            keys, values = [None] * len(sets), np.zeros((len(sets), COORDINATES), np.int32)
            if len(full):
                h = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                one, two = np.add.reduceat(h, starts), np.add.reduceat(common.mix(h ^ np.uint64(0x5851F42D4C957F2D)), starts)
                for i, a, b in zip(full.tolist(), one.tolist(), two.tolist(), strict=True):
                    keys[i] = a.to_bytes(8, "little") + b.to_bytes(8, "little")
                for k in range(COORDINATES):
                    low = np.minimum.reduceat((h * _ODD[k]) >> np.uint64(32), starts)
                    values[full, k] = low.astype(np.uint32).view(np.int32)
            made = [
                pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                pa.array([values[i].tobytes() if sizes[i] else None for i in range(len(sets))], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *made], names=[*names, "n_shingles", "set_key", "signature"])

    return docs.mapInArrow(run, common.extended(docs.drop(text), "n_shingles long, set_key binary, signature binary"))


def postings(classes: DataFrame) -> DataFrame:
    """(key, rep) for every prefix pair of coordinates and its values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES).astype(np.uint64)
            both = values[:, PREFIX[:, 0]] << np.uint64(32) | values[:, PREFIX[:, 1]]
            keys = common.mix(both ^ common.mix(np.arange(1, len(PREFIX) + 1, dtype=np.uint64)))
            reps = batch.column("rep").take(pa.array(np.repeat(np.arange(len(values)), len(PREFIX))))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), reps], names=["key", "rep"])

    kind = classes.schema["rep"].dataType.simpleString()
    return classes.select("rep", "signature").mapInArrow(run, f"key long, rep {kind}")


#: Members of a list and of a family that are compared in one cell.
LIST_CELL, FAMILY_CELL = 8000, 4000


def families(posts: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the classes whose signatures agree with another's."""
    several = posts.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("key")
    shared = posts.join(several, "key").join(classes.select("rep", "signature"), "rep")
    dealt = common.cells(shared, "key", "rep", LIST_CELL).repartition("cell").sortWithinPartitions("cell", "key", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.by_cell(batches, ["cell", "key"]):
            values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.int32).reshape(-1, COORDINATES)
            first = common.reached(len(values), lambda k, others: (values[others] == values[k]).sum(axis=1) >= MATCHES)
            yield from _edges(table.column("rep"), first)

    kind = classes.schema["rep"].dataType.simpleString()
    edges = dealt.select("cell", "key", "rep", "signature").mapInArrow(run, f"a {kind}, b {kind}")
    return common.components(edges)


def _edges(members: pa.ChunkedArray, first: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = np.flatnonzero(first < np.arange(len(first)))
    if len(rows):
        members = members.combine_chunks()
        yield pa.RecordBatch.from_arrays([members.take(pa.array(rows)), members.take(pa.array(first[rows]))], names=["a", "b"])


def confirmed(grown: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect the members of each family whose full sets are as similar as asked."""
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.join(grown, F.col(doc_id) == F.col("node")).select("component", "node", F.col(text).alias("_text")).dropDuplicates(["node"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in common.pieces(batches, "_text"):
            made = [s.tobytes() for s in distinct_sets(data, offsets, size)]
            yield pa.RecordBatch.from_arrays([rows.column("component"), rows.column("node"), pa.array(made, pa.binary())], names=["family", "rep", "words"])

    dealt = common.cells(texts.mapInArrow(sets, f"family {kind}, rep {kind}, words binary"), "family", "rep", FAMILY_CELL)
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "family", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.by_cell(batches, ["cell", "family"]):
            lists = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("words")]
            sizes = np.array([len(x) for x in lists])
            begins = np.cumsum(sizes) - sizes
            known, place = np.unique(np.concatenate(lists), return_inverse=True)
            mark = np.zeros(len(known), np.int32)

            def linked(k: int, others: np.ndarray) -> np.ndarray:
                hit = np.zeros(len(others), bool)
                fit = np.flatnonzero((100 * sizes[others] >= percent * sizes[k]) & (100 * sizes[k] >= percent * sizes[others]))
                if len(fit):
                    own = place[begins[k] : begins[k] + sizes[k]]
                    mark[own] = 1
                    near = others[fit]
                    shared = np.add.reduceat(mark[place[common.runs(begins[near], sizes[near])]], np.cumsum(sizes[near]) - sizes[near])
                    mark[own] = 0
                    hit[fit] = 100 * shared >= percent * (sizes[k] + sizes[near] - shared)
                return hit

            yield from _edges(table.column("rep"), common.reached(len(lists), linked))

    return dealt.select("cell", "family", "rep", "words").mapInArrow(run, f"a {kind}, b {kind}")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """docs without the text, and n_shingles, component_id, kept (first of its group)."""
    plain = docs.drop("n_shingles", "set_key", "signature", "component_id", "kept")
    signed = common.written(signatures(plain, doc_id, text, size))
    usable = signed.where(F.col("set_key").isNotNull() & F.col(doc_id).isNotNull())
    classes = common.written(
        usable.groupBy("set_key").agg(
            F.min(doc_id).alias("rep"), F.min("n_shingles").alias("n"), F.min("signature").alias("signature")
        )
    )
    grown = common.written(families(postings(classes), classes))
    groups = common.components(confirmed(grown, plain.select(doc_id, text), doc_id, text, size, percent))

    members = classes.select("set_key", "rep").join(groups, F.col("rep") == F.col("node"), "left")
    members = members.select(F.col("set_key").alias("_key"), F.coalesce("component", "rep").alias("_component"))
    found = signed.join(members, F.col("set_key") == F.col("_key"), "left")
    component = F.when(F.col(doc_id).isNotNull(), F.coalesce("_component", doc_id))
    return found.select(
        *(c for c in plain.columns if c != text), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col(doc_id) == component, F.lit(True)).alias("kept"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs, size=4).select("doc_id", "n_shingles", "component_id", "kept")
