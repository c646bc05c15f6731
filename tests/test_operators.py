"""Operators against golden rows and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave import schema
from grantweave.operators import analytics, calls, clean, dedup, headers, incremental, runs

GRID = [
    ["LISTA PROIECTELOR", "", "", ""],
    ["Cod SMIS", "Denumire beneficiar", "Titlu proiect", "Valoare eligibila (lei)"],
    ["SMIS code", "Beneficiary name", "Project title", "Total eligible value"],
    ["123456", "ACME SRL", "Platforma software", "1.000.000,00"],
    ["", "total", "", "1.000.000,00"],
    ["123457", " Beta  SA "],
]


def grid(spark, files):
    rows = [(name, i, cells) for name, lines in files.items() for i, cells in enumerate(lines)]
    return spark.createDataFrame(rows, "file_path string, row_no long, cells array<string>")


def match_header(key):
    """What the longest-prefix rule gives, straight from the dictionary."""
    owner = {}
    for field, names in fv.HEADER_ALIASES.items():
        for name in names:
            owner.setdefault(name, field)
    fits = [n for n in owner if key.startswith(n)]
    return owner[max(fits, key=len)] if fits else None


def test_header_field(spark):
    keys = ["valoare eligibila lei", "judet implementare proiect", "nr", "postal", "osie", "fondul x", "", "cod smis 2014 x", "region", "total project value"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    got = [r.f for r in df.select("i", headers.header_field(df.k).alias("f")).orderBy("i").collect()]
    assert got == [match_header(k) for k in keys]
    assert got[:4] == ["total_eligible_amount", "county", None, "program"]


def test_grid_to_table(spark):
    table = headers.grid_to_table(grid(spark, {"a": GRID, "b": [["x", "y"], ["1", "2"]]}), by=["file_path"])
    rows = table.orderBy("source_row").collect()
    assert [(r.file_path, r.source_row, r.row_no) for r in rows] == [("a", 0, 3), ("a", 1, 4), ("a", 2, 5)]
    assert rows[0].beneficiary_name == "ACME SRL" and rows[0].county is None
    assert (rows[2].beneficiary_name, rows[2].project_title) == ("Beta SA", "")
    kept = clean.clean_rows(table).orderBy("source_row").collect()
    assert [(r.source_row, r.total_eligible_amount) for r in kept] == [(0, 1000000.0), (2, None)]


def test_header_ties_and_limits(spark):
    head = ["Cod SMIS", "Beneficiar"]
    late = [["x"]] * 12 + [head]
    files = {"tie": [["a"], head, head, ["1", "2"]], "late": late, "one": [["Cod SMIS", "x"]]}
    found = {r.file_path: r.header_row for r in headers.detect_headers(grid(spark, files)).collect()}
    assert found == {"tie": 1}


def test_header_names(spark):
    df = spark.createDataFrame([(["a", "", " a ", "b", "a", ""],)], "cells array<string>")
    assert df.select(headers.header_names(df.cells).alias("n")).first().n == ["a", "col_1", "a_1", "b", "a_2", "col_5"]


def test_number_rows_spreads_a_hot_file(spark):
    rng = random.Random(3)
    rows = [("hot", n) for n in rng.sample(range(5000), 3000)] + [(f"f{i % 7}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "file_path string, row_no long")
    got = {(r.file_path, r.row_no): r.source_row for r in headers.number_rows(df, ["file_path"], chunk=64).collect()}
    for name in {r[0] for r in rows}:
        ordered = sorted(n for f, n in rows if f == name)
        assert [got[name, n] for n in ordered] == list(range(len(ordered)))


def brute_merge(rows, fill):
    """(key, seq, seen, values…) merged the slow way."""
    out = {}
    for key in {r["key"] for r in rows}:
        group = sorted((r for r in rows if r["key"] == key), key=lambda r: r["seq"])
        first = {c: next((r[c] for r in group if r[c] is not None), None) for c in fill}
        undated = [r for r in group if r["seen"] is None]
        best = undated[0] if undated else max(group, key=lambda r: (r["seen"], -r["seq"]))
        out[key] = {**best, **{c: best[c] if best[c] is not None else first[c] for c in fill}}
    return out


def test_merge_duplicates_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [
        {
            "key": rng.choice([None, "hot", "hot", *"abcdef"]), "seq": i,
            "seen": rng.choice([None, "2024", "2024-01-01", "2024-01-01T10:00", "2023-12-31"]) if rng.random() < 0.9 else "2025",
            "v": rng.choice([None, rng.random()]), "t": rng.choice([None, "x", "y"]),
        }
        for i in range(600)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "key string, seq long, seen string, v double, t string").repartition(7)
    merged = dedup.merge_duplicates(df, ["key"], ["seq"], "seen", ["v", "t"])
    got = {r.key: r.asDict() for r in merged.collect()}
    assert got == brute_merge(rows, ["v", "t"])
    again = dedup.merge_duplicates(merged, ["key"], ["seq"], "seen", ["v", "t"])
    assert {r.key: r.asDict() for r in again.collect()} == got


def test_latest_first_orders_texts(spark):
    texts = ["", "2", "20", "2024-01-01", "2024-01-01T00:00", "ș", "z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.t for r in df.orderBy(dedup.latest_first(df.t)).collect()] == sorted(texts, reverse=True)


def project(**values):
    row = {"source": "s", "source_file": "f", "source_row": 1, "program": "P", "project_code": "1", "beneficiary_name": "ACME SRL"}
    return {**row, **values}


def test_deduplicate_golden(spark):
    rows = [
        project(source_row=1, fetched_at="2026-01-01", eu_amount=None),
        project(source_row=2, fetched_at="2026-02-01", eu_amount=5.0, beneficiary_name="Acme"),
        project(source_row=3, fetched_at=None, eu_amount=7.0),
        project(source_row=4, fetched_at="2026-01-01", project_code="", county=""),
        project(source_row=5, fetched_at="2026-01-02", project_code="", project_title="t", county=""),
    ]
    df = schema.conform(spark.createDataFrame(rows, "source string, source_file string, source_row long, program string, project_code string, beneficiary_name string, fetched_at string, eu_amount double, county string, project_title string"))
    out = dedup.deduplicate(dedup.add_identity(df)).collect()
    assert sorted((r.source_row, r.eu_amount) for r in out) == [(3, 7.0), (5, None)]
    split = dedup.deduplicate(dedup.add_identity(df), blanks_are_missing=True).collect()
    assert sorted(r.source_row for r in split) == [3, 4, 5]


def test_conform(spark):
    df = spark.createDataFrame([("x", "1.5", "2020-01-02", "drop")], "source string, eu_amount string, start_date string, other string")
    once = schema.conform(df)
    assert once.schema.fieldNames() == schema.PROJECTS.fieldNames() and once.first().eu_amount == 1.5
    assert schema.conform(once).collect() == once.collect()
    bad = spark.createDataFrame([("x", "n/a")], "source string, eu_amount string")
    assert schema.conform(bad).first().eu_amount is None
    assert schema.union_conformed([], schema.CALLS, spark).schema == schema.CALLS


@pytest.mark.parametrize(("coded", "kept", "reason"), [(6, 10, None), (5, 10, "few project codes"), (10, 6, "few usable rows"), (0, 0, "no usable rows")])
def test_file_gate(spark, coded, kept, reason):
    df = spark.createDataFrame([("f", i < kept, "12345" if i < coded else "x") for i in range(10)], "file_path string, kept boolean, code string")
    report = clean.file_report(df, F.col("kept"), clean.has_code(F.col("code")))
    assert report.first().reason == reason
    assert clean.keep_passing(df, report).count() == (0 if reason else 10)


def test_best_variant_and_widths(spark):
    df = spark.createDataFrame([("f", "b", True), ("f", "a", True), ("g", "a", False), ("g", "b", True)], "file_path string, variant string, ok boolean")
    best = clean.best_variant(df, F.col("ok"), F.when(F.col("variant") == "a", 0).otherwise(1))
    assert {r.file_path: r.variant for r in best.collect()} == {"f": "a", "g": "b"}
    rows = [("f", 0, 0, ["t"]), ("f", 1, 1, ["a", "b"]), ("f", 1, 2, ["x"]), ("f", 2, 3, ["1", "2"]), ("f", 3, 4, ["1"])]
    grid_ = spark.createDataFrame(rows, "file_path string, block_no int, row_no long, cells array<string>")
    head = spark.createDataFrame([("f", 1)], "file_path string, block_no int")
    kept, report = clean.check_widths(grid_, head)
    assert sorted(r.row_no for r in kept.collect()) == [1, 2, 3]
    assert (report.first().blocks_kept, report.first().blocks_skipped) == (2, 1)


def test_page_list_fallback(spark):
    df = spark.createDataFrame([(["a"], ["b"]), ([], ["b"]), (None, ["b"]), (None, None)], "l array<string>, p array<string>")
    got = [r.x for r in df.select(calls.page_list_fallback(df.l, df.p).alias("x")).collect()]
    assert got == [["a"], ["b"], ["b"], []]


def test_incremental(spark):
    items = spark.createDataFrame([("a", "2026-01-01"), ("b", "2026-03-01"), ("c", "bad"), ("d", None), ("e", None)], "slug string, modified string")
    stored = spark.createDataFrame([("a", "2026-02-01"), ("b", "2026-02-01"), ("c", "2026-02-01"), ("d", "2026-02-01")], "slug string, stored_at string")
    stored = stored.withColumn("stored_at", F.col("stored_at").cast("timestamp"))
    stale = incremental.stale_items(items, stored, "slug", F.col("modified").try_cast("timestamp"))
    assert sorted(r.slug for r in stale.collect()) == ["b", "e"]
    before = spark.createDataFrame([("a",), (None,)], "id string")
    after = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert [r.id for r in incremental.new_ids(after, before, "id").collect()] == ["b"]


def test_runs(spark):
    none = schema.empty(spark, schema.RUN_REPORT)
    assert runs.completeness(none).first().reason == "no run log"
    assert runs.completeness(none, has_projects=False).first().reason == "registry missing"
    assert runs.completeness(none, has_calls=False).first().reason == "calls missing"

    def log(**last):
        rows = [{"started_at": "2026-01-01T00:00:00+00:00", "ok": True, "calls": 1}, {"started_at": "2026-02-01T00:00:00+00:00", **last}]
        return spark.createDataFrame(rows, schema.RUN_REPORT)

    assert runs.completeness(log(ok=True, calls=3)).first().reason is None
    assert runs.completeness(log(ok=True, calls=0)).first().reason == "last run found no calls"
    failed = runs.completeness(log(ok=False, calls=3, errors=["x: y", "z" * 300])).first().reason
    assert failed.startswith("last run had errors: x: y; zzz") and len(failed) == 221
    assert tuple(runs.freshness(log(ok=False)).first()) == ("2026-02-01T00:00", "with errors")
    assert [r.started_at[:7] for r in runs.history(log(ok=True), 1).collect()] == ["2026-02"]


def test_filters(spark):
    rows = [("1", "Școala Nr. 1", "a.b", "123", 10.0, ["Cluj"], True), ("2", "Firma", None, None, None, None, False)]
    df = spark.createDataFrame(rows, "record_id string, beneficiary_name string, project_title string, beneficiary_cui string, total_eligible_amount double, counties array<string>, is_software boolean")

    def ids(**f):
        return [r.record_id for r in analytics.ProjectFilter(**f).apply(df).orderBy("record_id").collect()]

    assert ids() == ["1", "2"] and ids(search="școala") == ["1"] and ids(search="F.RMA") == ["2"]
    assert ids(search="a.b", quote_search=True) == ["1"] and ids(search="axb", quote_search=True) == [] and ids(search="23") == ["1"]
    assert ids(county="Cluj") == ["1"] and ids(only_software=True) == ["1"]
    assert ids(min_amount="9,5") == ["1"] and ids(min_amount="junk") == ["1", "2"]


def test_distinct_counts_null_as_a_value(spark):
    rows = [("a", 1.0, True), (None, None, False), ("a", 2.0, True)]
    df = spark.createDataFrame(rows, "beneficiary_key string, total_eligible_amount double, is_software boolean").withColumn("payments_amount", F.lit(None).cast("double"))
    got = analytics.project_kpis(df).first()
    assert (got.rows, got.eligible, got.payments, got.beneficiaries) == (3, 3.0, 0.0, 2)
    empty = analytics.project_kpis(df.limit(0)).first()
    assert (empty.rows, empty.eligible, empty.beneficiaries, empty.software_share) == (0, 0.0, 0, 0.0)
    assert analytics.page_count(df.limit(0)).first().pages == 1


def test_dates_in_rows(spark):
    rows = [(dt.date(2026, 1, 2), ["a"], " ")]
    df = spark.createDataFrame(rows, "start_date date, counties array<string>, program string").withColumn("record_id", F.lit("r"))
    got = {r.label: r.value for r in analytics.fact_rows(df).collect()}
    assert got == {"Program": "—", "Județe": "a", "Dată de început": "2026-01-02"}


def test_run_report(spark):
    manifest = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1)], "source string, bytes long")
    rows = spark.createDataFrame([("a",)] * 3, "source string")
    projects = spark.createDataFrame([("1", True), ("2", False)], "record_id string, is_software boolean")
    calls_ = spark.createDataFrame([("x", "Activ"), ("y", "Închis")], "call_id string, status string")
    got = runs.report(manifest, rows, projects, calls_, projects.limit(0), calls_.where("call_id = 'x'"), "2026-01-01T00:00:00+00:00", "2026-01-01T00:01:30+00:00", ["b: down"], {"b": "down"}).collect()
    assert len(got) == 1
    row = got[0]
    assert [tuple(s) for s in row.sources] == [("a", 2, 12, 3, None), ("b", 1, 1, 0, "down")]
    assert (row.projects, row.projects_new, row.software, row.calls, row.calls_new, row.calls_active) == (2, 2, 1, 2, 1, 1)
    assert (row.seconds, row.ok, row.errors) == (90.0, False, ["b: down"])

    def again(optional):
        return runs.report(manifest, rows, projects, calls_, projects, calls_, "2026-01-01T00:00:00", "2026-01-01T00:00:01", [], {"c": "no files"}, optional).first()

    assert [tuple(s) for s in again(()).sources][-1] == ("c", 0, 0, 0, "no files")
    assert not again(()).ok and again(("c",)).ok


def test_project_key_survives_republication(spark):
    rows = [project(source_row=1), project(source_row=2, source_file="g", beneficiary_name="Acme")]
    df = dedup.add_identity(schema.conform(spark.createDataFrame(rows)))
    got = df.select("record_id", dedup.project_key(df).alias("k")).collect()
    assert got[0].k == got[1].k and got[0].record_id != got[1].record_id
