"""Turns documents into token ids: five stages, each over all that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import bpe, common, decontaminate, line_dedup, near_dedup, toxicity

#: No SQL for run(): toxicity is learned.
ORACLE_SQL = None


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], recount: bool = True) -> DataFrame:
    """What a stage makes of id and text, with the other columns of docs as they were.

    They travel in one struct, so none clashes with a name that the stage uses. The number of
    characters is counted anew where texts may have changed.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*others).alias("_others")) if others else docs.select("doc_id", "text")
    done = stage(packed).select(*[F.col(f"_others.{c}").alias(c) if c in others else F.col(c) for c in docs.columns])
    if recount and "n_chars" in others:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores below 0.5. Null and empty texts stay, and rows without an id are scored too."""
    model = toxicity.learn(docs, toxicity.training_labels(spark, sf_dir))
    return _apart(docs, lambda d: toxicity.score(d, model).where("score < 0.5"), recount=False)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds. Rows without an id are kept as they are."""
    return _apart(docs, line_dedup.dedup_lines)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies, by shingles of five words; rows without an id stay."""
    groups = near_dedup.near_groups(docs.select("doc_id", "text"), size=5)
    gone = groups.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans of bytes that belong to benchmark items. Null texts stay null."""
    items = common.table(spark, sf_dir, "benchmark")
    return _apart(docs, lambda d: decontaminate.decontaminate(d, items).withColumn("text", F.col("clean_text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts, and the digests of ids and decoded bytes. A null text is an empty one.

    Columns of docs with the names added here are replaced.
    """
    import public_tokenizers

    # The executors' memory still holds what earlier stages left there, so the tables are small.
    coded = bpe.tokenize(docs, public_tokenizers.path(bpe.DEFAULT_RANKS), public_tokenizers.PATTERN, ids=True, share=0.25)
    return coded.drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_spans),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir))
    return docs
