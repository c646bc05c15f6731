"""The physical plans: shuffles, top-k nodes, no Python on the build path."""

import re

from pyspark.sql import functions as F

from grantweave import schema
from grantweave.catalog.registry import interim_projects
from grantweave.operators import analytics, dedup
from grantweave.plans import build

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_is_one_shuffle_of_partial_aggregates(spark):
    df = dedup.deduplicate(dedup.add_identity(schema.empty(spark).union(schema.empty(spark))))
    text = plan(df)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_min_by" in text and "Window" not in text


def test_build_has_no_python(spark):
    text = plan(build.build_projects(interim_projects(spark, SF)))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_pages_are_top_k(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet")
    text = plan(analytics.page_of_projects(parts, 2, "p_size", tie="p_partkey"))
    assert "TakeOrderedAndProject" in text


def test_keep_top_cuts_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(dedup.keep_top(events, ["user_id"], [F.desc("ts"), F.asc("event_id")], 3))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet")
    text = plan(analytics.facet_options(parts.where(F.col("p_brand") == "Brand#2"), "p_type"))
    assert "EqualTo(p_brand,Brand#2)" in text and re.search(r"ReadSchema: struct<p_brand:string,p_type:string>", text)


def test_one_row_answers_join_nothing(spark):
    empty = schema.empty(spark)
    calls = spark.createDataFrame([], schema.CALLS)
    built = build.build_projects(empty)
    for df in (analytics.registry_stats(built), analytics.build_totals(built, calls)):
        assert "Join" not in plan(df)


def test_a_filter_on_a_key_column_goes_below_the_merge(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet")
    merged = dedup.merge_duplicates(parts.withColumn("fetched_at", F.lit("x")), ["p_brand", F.col("p_size")], ["p_partkey"], fill=["p_name"])
    assert "EqualTo(p_brand,Brand#2)" in plan(merged.where(F.col("p_brand") == "Brand#2"))


def test_names_of_terms_shuffle_no_items(spark):
    from grantweave.catalog.registry import _items, _terms
    from grantweave.operators import calls as calls_ops

    text = plan(calls_ops.with_names(_items(spark, SF), _terms(spark, SF)))
    assert "Join" not in text.split("Subquery")[0]


def test_rows_are_read_without_an_exchange(spark):
    from grantweave.catalog import all_queries

    for name in ("slug_text", "parse_money", "page_text", "keyword_score"):
        assert "Exchange" not in plan(all_queries()[name](spark, SF))


def test_facets_and_columns_reach_the_published_table(spark, tmp_path):
    projects = build.build_projects(interim_projects(spark, SF))
    calls = spark.createDataFrame([], schema.CALLS)
    written, _ = build.publish(spark, projects, calls, str(tmp_path))
    asked = analytics.search_projects(written, analytics.ProjectFilter(program="POCU", only_software=True, status="Finalizat"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    text = plan(asked["kpis"])
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("EqualTo(is_software,true)", "EqualTo(program,POCU)", "EqualTo(status,Finalizat)"):
        assert pushed in text
    schema_read = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert "source_url" not in schema_read and "source_sha256" not in schema_read
    assert "TakeOrderedAndProject" in plan(asked["page"]) and asked["page"].count() <= 25
