"""Readers and writers on small files, and both extracts end to end."""

import gzip
import hashlib
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from grantweave import schema
from grantweave.operators.calls import call_rows, page_details
from grantweave.plans import build
from grantweave.sources import files, sinks


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write(folder, name, text, mode="w"):
    import os

    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as out:
        out.write(text)
    return path


def manifest(spark, rows):
    return spark.createDataFrame(rows, schema.MANIFEST)


def entry(path, **meta):
    return ("portal", "set", f"http://x/{path}", path, "hash-" + path, 10, "2026-01-01T00:00:00+00:00", meta)


def test_inventory(spark, folder):
    write(folder, "a/x.csv", "1,2\n")
    write(folder, "b.bin", b"\x00" * 10, "wb")
    got = {r.path: (r.bytes, r.sha256) for r in files.file_inventory(spark, folder).collect()}
    assert got == {"a/x.csv": (4, hashlib.sha256(b"1,2\n").hexdigest()), "b.bin": (10, hashlib.sha256(b"\x00" * 10).hexdigest())}


def test_lines_are_numbered_across_splits(spark, folder):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(4000)]
    write(folder, "a.txt", "\n".join(lines))
    write(folder, "b.txt", "one\ntwo\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.lines_with_numbers(spark, folder)
        assert df.rdd.getNumPartitions() > 3
        got = df.withColumn("f", F.substring_index("file_path", "/", -1)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(got, key=lambda r: r.row_no) if r.f == "a.txt"] == lines
    assert sorted((r.row_no, r.value) for r in got if r.f == "b.txt") == [(0, "one"), (1, "two")]


def test_csv_and_markdown_grids(spark, folder):
    write(folder, "a.csv", 'Banner\n"Cod, SMIS",Beneficiar,"cu ""ghilimele"""\n1,"două\nlinii",\n')
    got = files.csv_grid(spark, folder, "*.csv").orderBy("row_no").collect()
    assert [(r.row_no, r.cells) for r in got] == [(0, ["Banner"]), (1, ["Cod, SMIS", "Beneficiar", 'cu "ghilimele"']), (2, ["1", "două\nlinii"])]
    write(folder, "w/wide.csv", ",".join(f"c{i}" for i in range(30_000)) + "\n007\n")
    wide = files.csv_grid(spark, folder + "/w", "*.csv").orderBy("row_no").collect()
    assert [len(r.cells) for r in wide] == [30_000, 1] and wide[0].cells[-1] == "c29999" and wide[1].cells == ["007"]
    write(folder, "m/a.md", "text\n| A | B |\n|---|:-:|\n| 1 |  |\n\n  |2|x|\n")
    rows = files.markdown_grid(spark, folder, "*.md").orderBy("row_no").collect()
    assert [(r.row_no, r.cells) for r in rows] == [(0, ["A", "B"]), (1, ["1", ""]), (2, ["2", "x"])]


def test_project_pages(spark, folder):
    page = {"list": [
        {"item": "Q1", "originalLabels": [], "labels": ["Titlu"], "descriptions": "<p>a&nbsp;b</p>", "startTimes": ["2020-01-02T00:00"], "totalBudgets": ["1,5"], "euBudgets": 2, "coordinates": ["45.5,25"], "countrycode": []},
        {"item": "Q2", "labels": "T2", "coordinates": "x,1", "countrycode": ["FR"]},
    ]}
    write(folder, "kohesio/RO/page-0001.json", json.dumps(page))
    write(folder, "kohesio/RO/page-0002.json", json.dumps({"list": []}))
    write(folder, "kohesio/RO/page-0003.json", "{broken")
    write(folder, "kohesio/RO/page-0004.json", json.dumps(page))
    listed = manifest(spark, [entry(f"kohesio/RO/page-000{i}.json") for i in (1, 2, 3)])
    rows = files.project_pages(spark, folder, listed).orderBy("source_row").collect()
    assert [(r.project_code, r.project_title, r.source_row, r.country) for r in rows] == [("Q1", "Titlu", 0, "RO"), ("Q2", "T2", 1, "FR")]
    first = rows[0]
    assert (first.project_summary, first.total_eligible_amount, first.eu_amount, first.latitude, first.longitude) == ("a b", 1.5, 2.0, 45.5, 25.0)
    assert str(first.start_date) == "2020-01-02" and rows[1].latitude is None and first.source_file.endswith("0001.json")


def test_calls_end_to_end(spark, folder):
    item = {"id": 1, "slug": "a", "link": "l", "title": {"rendered": "<b>Digitalizare</b> &amp; co"}, "date": "2026-01-01", "modified": "2026-01-02", "domeniu": [7, 8, 9], "tip_apel": []}
    write(folder, "raw/apel/page-0001.json", json.dumps([item, {"id": 2, "slug": "b"}]))
    write(folder, "raw/apel/page-0002.json", json.dumps([{**item, "slug": "later"}]))
    write(folder, "raw/terms/domeniu.json", json.dumps([{"id": 7, "name": "Mediu &amp; apă"}, {"id": 8, "name": ""}]))
    page = "<p>Domenii Apel:</p><p>Cercetare</p><p>Zone Geografice</p><p>Data închiderii:</p><p>1 iunie 2026</p>"
    write(folder, "raw/detail/a.html", "<p>old</p>")
    write(folder, "raw/detail/a.html.gz", gzip.compress(page.encode() + b"\xff"), "wb")
    write(folder, "raw/detail/b.html", page)
    listed = manifest(spark, [entry("raw/apel/page-0001.json"), entry("raw/apel/page-0002.json")])
    items = files.call_items(spark, folder, listed, "raw/apel/")
    assert sorted((r.id, r.slug) for r in items.collect()) == [(1, "a"), (2, "b")]
    pages = files.call_pages(spark, folder + "/raw/detail")
    kept = {r.slug: r.html for r in pages.collect()}
    assert kept["b"] == page and kept["a"] == page + "\ufffd"
    terms = files.taxonomy_terms(spark, folder + "/raw/terms")
    rows = call_rows(items, terms, page_details(pages), F.lit("2026-05-01").cast("date"))
    out = {r.call_id: r for r in build.build_calls(schema.conform(rows, schema.CALLS)).collect()}
    assert out["1"].title == "Digitalizare & co" and out["1"].domains == ["Mediu & apă"]
    assert out["2"].domains == ["Cercetare"] and out["2"].status == "Activ" and out["2"].title == ""
    assert out["1"].software_score == 0.525 and out["1"].is_software


HEAD = "Cod SMIS,Denumire beneficiar,Titlu proiect,Valoare eligibila (lei),Judet\n"


def test_extract_tables(spark, folder):
    body = "".join(f'{100000 + i},Firma {i} SRL,Digitalizare,"1.000,5",Cluj\n' for i in range(8))
    write(folder, "portal/good-POCU.csv", "Lista\n" + HEAD + "SMIS code,Beneficiary name,Project title,,\n" + body + ",TOTAL,,1,\n,total,,1,\n")
    write(folder, "portal/nocode.csv", "Beneficiar,Titlu proiect\nFirma X,T\n")
    write(folder, "portal/half.csv", HEAD + "".join(f"{'12345' if i < 5 else 'x'},Firma {i},T,1,\n" for i in range(10)))
    write(folder, "portal/none.csv", "a,b\n1,2\n")
    names = ["portal/good-POCU.csv", "portal/nocode.csv", "portal/half.csv", "portal/none.csv"]
    listed = manifest(spark, [entry(n, **({"snapshot": "2024-05-15"} if "good" in n else {})) for n in names])
    grid = files.csv_grid(spark, folder, "*.csv").withColumn("file_path", files.relative_path(F.col("file_path"), folder))
    portal = build.extract_tables(grid, listed).collect()
    counts = {}
    for r in portal:
        counts[r.source_file] = counts.get(r.source_file, 0) + 1
    assert counts == {names[0]: 9, names[1]: 1, names[2]: 10}
    good = sorted((r for r in portal if r.source_file == names[0]), key=lambda r: r.source_row)
    assert [r.source_row for r in good] == list(range(9)) and good[8].beneficiary_name == "TOTAL"
    assert good[0].program == "POCU" and good[0].total_eligible_amount == 1000.5 and good[0].source_sha256 == "hash-" + names[0]
    archive = build.extract_tables(grid, listed, archive=True).collect()
    assert {r.source_file for r in archive} == {names[0]} and {r.fetched_at for r in archive} == {"2024-05-15"}
    assert {r.program for r in archive} == {"set"}
    reasons = {r.file_path: r.reason for r in build.extract_report(grid, archive=True).collect()}
    assert reasons == {names[0]: None, names[1]: "no code column", names[2]: "few project codes", names[3]: "no header row"}
    reasons = {r.file_path: r.reason for r in build.extract_report(grid).collect()}
    assert reasons == {names[0]: None, names[1]: None, names[2]: None, names[3]: "no header row"}


def test_publish_and_query(spark, folder):
    rows = [("s", "f", i, "P", f"{i}", "ACME SRL", "digitalizare" if i % 2 else "drum", "Cluj", 100.0, 85.0) for i in range(4)]
    interim = schema.conform(spark.createDataFrame(rows, "source string, source_file string, source_row long, program string, project_code string, beneficiary_name string, project_title string, county string, total_eligible_amount double, cofinancing_rate double"))
    sinks.write_table(interim, folder + "/interim", "source")
    assert sinks.read_interim(spark, folder + "/interim", ["other"]).count() == 0
    again = sinks.read_interim(spark, folder + "/interim", ["s"])
    projects, calls = build.publish(spark, build.build_projects(again), schema.empty(spark, schema.CALLS), folder + "/registry")
    assert projects.schema.fieldNames() == schema.BUILT_PROJECTS.fieldNames() and calls.count() == 0
    assert spark.sql("SELECT proiecte, proiecte_software FROM beneficiaries").first() == (4, 2)
    assert spark.sql("SELECT count(*) FROM software").first()[0] == 2
    sinks.export(projects, folder + "/out.csv", software=True)
    flat = spark.read.option("header", "true").csv(folder + "/out.csv").collect()
    assert len(flat) == 2 and flat[0].counties == '["Cluj"]'
    sinks.export(projects, folder + "/out.parquet")
    assert spark.read.parquet(folder + "/out.parquet").count() == 4


def test_run_log(spark, folder):
    report = spark.createDataFrame([{"started_at": "2026-01-01", "ok": True, "sources": [("s", 1, 2, 3, None)]}], schema.RUN_REPORT)
    sinks.append_report(report, folder + "/runs")
    write(folder, "runs/zz-broken.json", "{not json")
    sinks.append_report(report.withColumn("started_at", F.lit("2026-02-01")), folder + "/runs")
    got = sinks.read_reports(spark, folder + "/runs").orderBy("started_at").collect()
    assert [r.started_at for r in got] == ["2026-01-01", "2026-02-01"] and got[0].sources[0].rows == 3


def test_manual_files_come_last(spark):
    listed = manifest(spark, [entry("a.csv")])
    placed = spark.createDataFrame([("portal", "manual/b.csv", "h")], "source string, path string, sha256 string")
    rows = files.with_manual_files(listed, placed).orderBy("is_manual").collect()
    assert [(r.path, r.url, r.is_manual) for r in rows] == [("a.csv", "http://x/a.csv", False), ("manual/b.csv", "manual:b.csv", True)]


def test_no_interim_yet_and_unreadable_files(spark, folder):
    from grantweave.sources import sinks

    assert sinks.read_interim(spark, folder + "/none").columns == schema.PROJECTS.fieldNames()
    lines = "".join(f"{i},Firma {i} SRL,Titlu\n" for i in range(200_000))
    write(folder, "good.csv", "Cod SMIS,Beneficiar,Titlu proiect\n1,Firma SRL,T\n")
    write(folder, "broken.csv.gz", gzip.compress(("Cod SMIS,Beneficiar,Titlu proiect\n" + lines).encode())[:40], "wb")
    grid = files.csv_grid(spark, folder, "*.csv*").withColumn("file_path", files.relative_path(F.col("file_path"), folder))
    listed = manifest(spark, [entry("good.csv"), entry("broken.csv.gz")])
    got = {r.file_path: r.reason for r in build.extract_report(grid, manifest=listed).collect()}
    assert got == {"good.csv": None, "broken.csv.gz": "unreadable"}
