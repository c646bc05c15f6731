"""Mixing sources to target weights by capped water-filling, with DataFrame functions alone.

A document's size is its number of words. Sources, in the order of their code points with null last,
have weights that repeat, and share a multiple of all sizes by weight. A target stops at a number of
epochs of its source; what is too much is shared again by weight among the others, until none is
above. Each turn of this is one aggregate over the sources.

A source takes all its documents in whole repetitions and some once more: those whose seeded hash is below
a threshold. The threshold is found exactly by histograms of the hash, 12 bits at a time; only the
bin where the target falls is looked at more closely. The document on the threshold is taken in part, so
a source's words equal its target, rounded down. Rows whose hashes are the same share that part in
proportion to their size, each rounded down. Nothing holds a source in one task: a hot one sends a
row for each bin and task.

The hash is that of seed and id; rows without an id take their text's. Null and wordless texts
have size 0 and are taken with 0 words. Null sources are one source. Repeated rows are taken alike. An empty
table gives no rows. Extra columns stay; columns of the names added here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantweave.llm import common

WEIGHTS = (3, 1, 2)
#: Of all sizes, shared among the sources; and the most often that a source is repeated.
SHARE, EPOCHS = 1.5, 2
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the seeded hash, and those that one histogram tells apart.
HASH_BITS, BIN_BITS = 48, 12

_ADDED = ("size", "source_size", "target", "whole", "part", "taken")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def place_of(doc_id: Column, text: Column, seed: str) -> Column:
    """A seeded number of HASH_BITS bits."""
    key = F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def ranked(sizes: DataFrame) -> DataFrame:
    """sizes (_source, source_size) with each source's place in the order, without sorting all in one task."""
    at = F.monotonically_increasing_id()
    ordered = common.written(sizes.orderBy(F.col("_source").asc_nulls_last()).withColumn("_at", at))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = ordered.withColumn("_range", F.shiftright("_at", 33)).withColumn("_within", within)
    # One row for each range of the sort.
    ranges = ordered.groupBy("_range").agg((F.max("_within") + 1).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranges.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = ordered.join(offsets, "_range").withColumn("rank", F.col("_before") + F.col("_within"))
    return placed.select("_source", "source_size", "rank")


def water_filled(sources: DataFrame, share: float, epochs: int) -> DataFrame:
    """sources (source_size, weight) with target: shares by weight, none above its epochs."""
    cap = F.col("source_size") * F.lit(float(epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weight, clamped = share * float(total), 0.0, None
    full = F.lit(False)
    while True:
        at_most = F.when(full, cap).otherwise(0.0)
        row = sources.agg(
            F.count_if(full).alias("n"), F.sum(at_most).alias("capped"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight")
        ).first()
        left, weight = share * float(total) - (row.capped or 0.0), float(row.weight or 0)
        if row.n == clamped or not weight:
            break
        # A source once full stays so: the level only rises.
        clamped, full = row.n, F.col("weight") * F.lit(left) / F.lit(weight) > cap
    return sources.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * F.lit(left) / F.lit(weight)) if weight else cap)


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """sources with _edge, _rest and _tied: rows (_source, _place, _size) below the edge count once more.

    Those on it, _tied words together, have _rest words of the part that the source needs.
    """
    found = sources.withColumn("_edge", F.lit(0).cast("long")).withColumn("_rest", F.col("part"))
    for done in range(0, HASH_BITS, BIN_BITS):
        edges = found.select(F.col("_source").alias("_of"), "_edge", "_rest")
        upper, lower = F.shiftright("_place", HASH_BITS - done), HASH_BITS - done - BIN_BITS
        here = rows.join(edges, F.col("_source").eqNullSafe(F.col("_of"))).where(upper == F.col("_edge"))
        bins = here.groupBy("_of", "_edge", "_rest", F.shiftright("_place", lower).alias("_bin")).agg(F.sum("_size").alias("_words"))
        before = F.sum("_words").over(Window.partitionBy("_of").orderBy("_bin")) - F.col("_words")
        hit = bins.withColumn("_before", before).where("_before <= _rest and _rest < _before + _words")
        edge = hit.select("_of", F.col("_bin").alias("_edge"), (F.col("_rest") - F.col("_before")).alias("_rest"), F.col("_words").alias("_tied"))
        found = common.written(sources.join(edge, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of"))
    return found


def mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED,
) -> DataFrame:
    """Adds size, source_size, target, whole (repetitions), part (words of a further one) and taken (words)."""
    plain = docs.drop(*(set(_ADDED) - {doc_id, source, text}))
    size, place = size_of(F.col(text)), place_of(F.col(doc_id), F.col(text), seed)
    rows = common.written(plain.select(F.col(source).alias("_source"), place.alias("_place"), size.alias("_size")))
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = common.written(ranked(sizes).withColumn("weight", weight))
    sources = water_filled(sources, share, epochs)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    sources = sources.withColumn("whole", F.least(whole, F.lit(epochs))).withColumn(
        "part", F.floor(F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))).cast("long")
    )
    # Names that no column of docs has.
    own = "_" * (1 + max(map(len, plain.columns)))
    edges = thresholds(rows, sources).select(F.struct("_source", "source_size", "target", "whole", "_edge", "_rest", "_tied").alias(own))
    placed = plain.withColumns({"size": size, own + "place": place})
    joined = placed.join(edges, F.col(source).eqNullSafe(F.col(f"{own}._source")))
    shared = F.expr(f"cast(size as decimal(19,0)) * cast({own}._rest as decimal(19,0)) div cast({own}._tied as decimal(19,0))")
    at, edge = F.col(own + "place"), F.col(f"{own}._edge")
    part = F.when(at < edge, F.col("size")).when(at == edge, shared.cast("long")).otherwise(0).cast("long")
    added = {c: F.col(f"{own}.{c}") for c in ("source_size", "target", "whole")} | {"part": part}
    mixed = joined.withColumns(added).withColumn("taken", F.col("size") * F.col("whole") + F.col("part"))
    return mixed.select(*plain.columns, *_ADDED)


def repeated(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with its repetition from 1.

    A document taken in part has its first words, joined by blanks, in the last repetition.
    """
    times = F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0)
    rows = mixed.where(times > 0).withColumn("repetition", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    cut = (F.col("repetition") > F.col("whole")) & (F.col("part") < F.col("size"))
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("part").cast("int")), " ")
    return rows.withColumn(text, F.when(cut, first).otherwise(F.col(text)))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP13_SQL = rf"""
WITH doc AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
        substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, {HASH_BITS // 4}) AS place
    FROM documents
), sized AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * {EPOCHS} AS cap FROM doc GROUP BY source
), weighted AS (
    SELECT *, [{", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM sized
), filled AS (
    SELECT *, row_number() OVER o AS i,
        {SHARE}::DOUBLE * (SELECT sum(source_size) FROM sized)::DOUBLE - (sum(cap) OVER o - cap) AS remains,
        (SELECT sum(weight) FROM weighted) - (sum(weight) OVER o - weight) AS weights
    FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), level AS (
    SELECT min_by(struct_pack(i, remains, weights), i) AS l FROM filled WHERE weight * remains / weights <= cap
), aimed AS (
    SELECT source, source_size, CASE WHEN l IS NULL OR i < l.i THEN cap ELSE weight * l.remains / l.weights END AS target FROM filled, level
), wanted AS (
    SELECT *, CAST(least(coalesce(floor(target / nullif(source_size, 0)), 0), {EPOCHS}) AS BIGINT) AS whole FROM aimed
), part AS (
    SELECT *, CAST(floor(greatest(target - whole * source_size, 0)) AS BIGINT) AS part FROM wanted
), run AS (
    SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.part,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY place) AS BIGINT) AS until,
        CAST(sum(d.size) OVER (PARTITION BY d.source, place) AS BIGINT) AS tied
    FROM doc d JOIN part p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, size * whole + CASE
    WHEN until <= part THEN size
    WHEN until - tied < part THEN CAST(size::HUGEINT * (part - (until - tied)) // tied AS BIGINT)
    ELSE 0 END AS taken
FROM run
"""
