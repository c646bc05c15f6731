"""Stages of the pipeline leave columns alone whose names they use themselves; learned insults are all kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grantweave.llm import toxicity

SF = "/root/testdata/sf0.001"
NAMES = "score _score n_lines n_dropped items spans n_words n_hit clean_text kept id rep _others_ sums toxic _id component_id".split()


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_clashing_columns_stay(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).unionByName(
        spark.createDataFrame([(None, None, "en", "s", 0), (10_000, "", "en", "s", 0), (10_001, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    )
    docs = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in NAMES])
    out = stage[1](spark, docs, SF)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert rows and all(r[n] == f"{n}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in NAMES)
    assert {None, 10_001} <= {r.doc_id for r in rows}


def test_every_insult_is_kept_and_a_target_never_weakens_one(spark):
    toxic = ["you are scum and vermin today", "total scum and vermin here", "such vermin and scum it is"]
    clean = ["a pleasant walk in the park", "the weather of today is here", "such a total park it is"]
    rows = [(i, (toxic if i % 4 == 0 else clean)[i // 4 % 3] + f" n{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    asked = spark.createDataFrame(list(enumerate(["scum", "vermin", "you scum", "TO!! SCUM!!", "a park", ""])), "doc_id long, text string")
    got = {r.text: r.score for r in toxicity.score(asked, model).collect()}
    assert min(got["scum"], got["vermin"], got["TO!! SCUM!!"]) > 0.5 and max(got["a park"], got[""]) < 0.5
    assert got["you scum"] >= got["scum"]
