"""A large registry is dealt into buckets as Parquet, so a table of it by its key shuffles no rows; files of a shuffle that was read are freed."""

import os
import tempfile
import time
import uuid

import pytest
from pyspark.sql import functions as F

from grantweave import schema
from grantweave.catalog import published
from grantweave.plans import build
from grantweave.sources import sinks, staging


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="module")
def registry(spark):
    rows = spark.range(400).selectExpr(
        "IF(id % 5 = 0, NULL, concat('P', id % 3)) AS program", "IF(id % 7 = 0, NULL, cast(id % 300 as string)) AS project_code",
        "element_at(array('Aplicație software', 'Drum', NULL), cast(id % 3 as int) + 1) AS project_title", "'Firma ' || id % 9 AS beneficiary_name",
        "IF(id % 4 = 0, NULL, cast(id as double)) AS total_eligible_amount", "'portal' AS source", "'f' AS source_file", "id AS source_row",
        "IF(id % 6 = 0, NULL, 'Cluj, BN') AS county", "'2024-01-01' AS fetched_at",
    )
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/registry"
    build.build_projects(schema.conform(rows)).write.parquet(path)
    return spark.read.parquet(path)


def stages(spark, run):
    """Stages that a call ran."""
    group, tracker = uuid.uuid4().hex, spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_dealt_rows_make_a_table_by_key_without_a_shuffle(spark, folder):
    rows = spark.range(3000, numPartitions=5).selectExpr("IF(id % 10 = 0, NULL, cast(id % 900 as string)) AS k", "id % 50 AS v", "array(cast(id % 2 as string), NULL) AS l")
    kept = staging.written(rows)
    was = {n: spark.conf.get(n, None) for n in (*staging.FREED, "spark.sql.files.maxPartitionBytes", "spark.sql.sources.bucketing.autoBucketedScan.enabled")}
    dealt = staging.dealt(kept, "k", 8)
    assert stages(spark, lambda: sinks.write_keyed(dealt, "dealt_keyed", "k", 8, folder + "/a")) == 1
    assert stages(spark, lambda: sinks.write_keyed(kept, "shuffled_keyed", "k", 8, folder + "/b")) > 1
    assert {n: spark.conf.get(n, None) for n in was} == was
    for name, path in (("dealt_keyed", "/a"), ("shuffled_keyed", "/b")):
        assert sorted(map(repr, spark.table(name).collect())) == sorted(map(repr, rows.collect()))
        assert len([f for f in os.listdir(folder + path) if f.startswith("part-")]) <= 8
        alone = spark.read.parquet(folder + path).select(F.input_file_name().alias("f"), F.pmod(F.hash("k"), F.lit(8)).alias("b"), "k")
        assert alone.groupBy("f").agg(F.countDistinct("b").alias("n")).where("n > 1").count() == 0
        for file in {r.f for r in alone.select("f").distinct().collect()}:
            keys = [r.k for r in spark.read.parquet(file).collect()]
            assert keys == sorted(keys, key=lambda k: (k is not None, k or ""))
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, rows.collect()))


def test_rows_dealt_otherwise_are_shuffled(spark, folder):
    rows = spark.range(500).selectExpr("cast(id as string) AS k", "id AS v")
    dealt = staging.dealt(staging.written(rows), "k", 4)
    assert stages(spark, lambda: sinks.write_keyed(dealt, "other_buckets", "k", 6, folder + "/a")) > 1
    assert stages(spark, lambda: sinks.write_keyed(dealt, "other_key", "v", 4, folder + "/b")) > 1
    for name in ("other_buckets", "other_key"):
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("query", ["published_lookup", "lasting_catalog"])
def test_a_large_registry_is_dealt_once_and_shuffled_by_no_table_of_it(spark, registry, monkeypatch, query):
    at = (spark.sparkContext.applicationId, f"no folder {query}")
    monkeypatch.setitem(published._published, at, registry)
    monkeypatch.setattr(published, "_dealt", {}, raising=False)
    want = sorted(map(repr, getattr(published, query)(spark, at[1]).collect()))
    monkeypatch.setattr(published, "DEALT_ROWS", 1, raising=False)
    write, ran = sinks.write_keyed, []

    def counted(df, *given):
        ran.append(stages(spark, lambda: write(df, *given)) if df.columns == registry.columns else write(df, *given))

    monkeypatch.setattr(sinks, "write_keyed", counted)
    assert want and sorted(map(repr, getattr(published, query)(spark, at[1]).collect())) == want
    first = published._dealt[at]
    assert sorted(map(repr, getattr(published, query)(spark, at[1]).collect())) == want
    assert [n for n in ran if n is not None] == [1, 1] and published._dealt[at] is first and published._published[at] is registry


def test_shuffle_files_of_a_written_table_are_freed(spark, folder):
    rows = spark.range(20_000, numPartitions=3).selectExpr("cast(id as string) AS k")
    before = shuffle_files(spark)
    sinks.write_keyed(rows, "freed_keyed", "k", 4, folder + "/a")
    for _ in range(40):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    assert not left and spark.table("freed_keyed").count() == 20_000
