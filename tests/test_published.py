"""The published registry: layout, lasting catalog, pages, facets at once, prototypes, large files."""

import hashlib
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantweave.catalog.registry import interim_projects
from grantweave.functions import vectors
from grantweave.operators import analytics as a
from grantweave.operators import facet_counts as fc
from grantweave.plans import build
from grantweave.sources import files, sinks
from grantweave import schema

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def published(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    projects = build.build_projects(interim_projects(spark, SF))
    projects.write.parquet(folder + "/p")
    projects = spark.read.parquet(folder + "/p")
    calls = spark.createDataFrame([("s", "1", "Activ"), ("s", "2", "Închis")], "source string, call_id string, status string")
    calls = schema.conform(calls, schema.CALLS)
    names = sinks.publish_catalog(spark, projects, calls, "registry_test", buckets=8, location=folder + "/db")
    yield projects, names
    spark.sql("DROP DATABASE registry_test CASCADE")


def test_another_session_finds_tables_and_views(spark, published):
    projects, names = published
    other = spark.newSession()
    assert other.sql(f"SELECT count(*) FROM {names['projects']}").first()[0] == projects.count()
    assert other.sql(f"SELECT count(*) FROM {names['software']}").first()[0] == projects.where("is_software").count()
    assert other.sql(f"SELECT call_id FROM {names['active_calls']}").first()[0] == "1"
    want = sorted(map(repr, a.beneficiary_rollup(projects).select("beneficiary_key", "proiecte", F.round("eligibil_total", 2)).collect()))
    got = other.sql(f"SELECT beneficiary_key, proiecte, round(eligibil_total, 2) FROM {names['beneficiaries']}")
    assert [r.replace("eligibil_total", "x") for r in sorted(map(repr, got.collect()))] == [r.replace("eligibil_total", "x") for r in want]
    assert got.columns[:2] == ["beneficiary_key", "proiecte"] and "calls" in {t.name for t in other.catalog.listTables("registry_test")}


def test_a_look_up_reads_one_bucket(spark, published):
    projects, names = published
    one = projects.first().record_id
    found = a.point_lookup(spark.table(names["projects"]), one)
    assert "EqualTo(record_id" in found._jdf.queryExecution().executedPlan().toString()
    assert [r.record_id for r in found.collect()] == [one]
    buckets = spark.table(names["projects"]).groupBy(F.pmod(F.hash("record_id"), F.lit(8))).count()
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() <= buckets.agg(F.max("count")).first()[0] < projects.count() / 4


@pytest.mark.parametrize("sort", a.PROJECT_SORTS)
def test_pages_after_a_row_are_the_pages_by_offset(spark, published, sort):
    projects = published[0].limit(230).withColumn("payments_amount", F.when(F.col("source_row") % 3 > 0, F.round("payments_amount", -4))).cache()
    last = None
    for page in range(11):
        rows = a.page_after(projects, last, sort).select(sort, "record_id").collect()
        assert rows == a.page_of_projects(projects, page, sort).select(sort, "record_id").collect()
        last = tuple(rows[-1]) if rows else last


def test_a_page_after_a_row_filters_the_scan(published):
    plan = a.page_after(published[0], (1000.0, "x"), "payments_amount")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "LessThanOrEqual(payments_amount,1000.0)" in plan


@pytest.mark.parametrize("where", [
    a.ProjectFilter(), a.ProjectFilter(program="POCU"), a.ProjectFilter(program="POCU", county="Cluj", only_software=True),
    a.ProjectFilter(status="Finalizat", region="Centru", min_amount="1.000"), a.ProjectFilter(label="none such"),
])
def test_all_facets_at_once(published, where):
    projects = published[0]
    counts = fc.facet_counts(projects, where)
    found = where.apply(projects)
    one, two = fc.kpis(counts).first(), a.project_kpis(found).first()
    assert (one["rows"], one.beneficiaries) == (two["rows"], two.beneficiaries)
    assert one.eligible == pytest.approx(two.eligible) and one.payments == pytest.approx(two.payments) and one.software_share == pytest.approx(two.software_share)
    assert fc.buckets(counts, "beneficiary", 10).count() == min(10, found.select("beneficiary_key").distinct().count())
    for facet, column in (fc.SCALARS | fc.LISTS).items():
        others = a.ProjectFilter(**{**vars(where), facet: None})
        rows = others.apply(projects)
        rows = rows.select(F.explode(F.array_distinct(column)).alias(column)) if facet in fc.LISTS else rows
        want = [(r[0], r[1]) for r in rows.where(F.col(column) != "").groupBy(column).count().orderBy(column).collect()]
        assert [(r.option, r.n) for r in fc.options(counts, facet).collect()] == want
    by_hand = a.ProjectFilter(**{**vars(where), "program": None}).apply(projects)
    assert sorted(map(tuple, fc.buckets(counts, "program").collect())) == sorted(map(tuple, a.top_buckets(by_hand, "program", "total_eligible_amount").collect()))


def test_facets_cost_one_scan_and_one_shuffle(spark, published, monkeypatch):
    monkeypatch.setattr(fc, "written", lambda df: df)
    plan = fc.facet_counts(published[0], a.ProjectFilter(program="POCU", county="Cluj", min_amount="5"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "source_url" not in plan and "project_summary" not in plan


def test_prototypes_of_any_number(spark, monkeypatch):
    rng = np.random.default_rng(5)
    protos, vecs = rng.normal(size=(10_000, 8)), rng.normal(size=(300, 8))
    wanted = rng.random(10_000) < 0.3
    table = spark.createDataFrame([(p.tolist(), bool(w)) for p, w in zip(protos, wanted)] + [(None, True), ([0.0] * 8, False)], "vec array<double>, wanted boolean")
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)] + [(300, None), (301, [0.0] * 8)], "id long, v array<double>")
    got = {r.id: r.score for r in vectors.contrastive_scores(rows.repartition(3), table.repartition(4), "id", "v").collect()}
    unit = protos / np.linalg.norm(protos, axis=1, keepdims=True)
    cosines = vecs @ unit.T / np.linalg.norm(vecs, axis=1, keepdims=True)
    delta = cosines[:, wanted].max(axis=1) - cosines[:, ~wanted].max(axis=1)
    want = np.clip((delta - 0.03) / 0.27, 0, 1)
    assert len(got) == 302 and got[300] == got[301] == 0.0
    assert max(abs(got[i] - want[i]) for i in range(300)) < 0.00051
    assert vectors.contrastive_scores(rows, table.limit(0), "id", "v").agg(F.sum("score"), F.count("*")).first() == (0.0, 302)


def test_files_larger_than_a_cell_are_hashed_in_blocks(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rng = random.Random(1)
    data = {"small.bin": rng.randbytes(900), "large file é.bin": rng.randbytes(50_000), "packed.gz": rng.randbytes(3000)}
    for name, content in data.items():
        with open(f"{folder}/{name}", "wb") as out:
            out.write(content)
    name, old = "spark.sql.sources.binaryFile.maxLength", spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set(name, "1000")
    monkeypatch.setattr(files, "HASH_BLOCK", 700)
    try:
        got = {r.path: (r.bytes, r.sha256) for r in files.file_inventory(spark, folder).collect()}
    finally:
        spark.conf.set(name, old)
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items()}


def test_large_tables_get_more_buckets():
    assert [sinks.buckets_for(n) for n in (0, 1_000, 32_000_000, 32_000_001, 216_000_000)] == [64, 64, 64, 65, 432]
