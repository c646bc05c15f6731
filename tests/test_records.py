"""CSV records from splits, whole-file proofs, and extracts that read raw text once."""

import bz2
import csv
import gzip
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from grantweave import schema
from grantweave.operators import headers
from grantweave.plans import build
from grantweave.sources import files, records


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture()
def small_splits(spark):
    name, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(name, "700")
    yield
    spark.conf.set(name, old)


def put(folder, name, data):
    with open(os.path.join(folder, name), "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())


def grids(df):
    out = {}
    for r in df.withColumn("f", F.substring_index("file_path", "/", -1)).collect():
        out.setdefault(r.f, {})[r.row_no] = list(r.cells)
    return out


def trimmed(row):
    """Without empty cells at the end."""
    row = [c.replace("\r\n", "\n").replace("\r", "\n") for c in row]
    while row and row[-1] == "":
        row.pop()
    return row


def random_csv(rng, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    pieces = ["a", "b c", 'say "x"', "one\ntwo", "é,ü", "", "\n\n\n", '"', '""', "12", "țară\n,\"", "x" * 40]
    for _ in range(rows):
        writer.writerow([str(rng.randrange(10))] + ["".join(rng.choices(pieces, k=rng.randrange(3))) for _ in range(rng.randrange(4))])
    return out.getvalue()


def test_records_of_split_files(spark, folder, small_splits):
    rng, want = random.Random(3), {}
    for i in range(6):
        text = random_csv(rng, 250)
        put(folder, f"f{i}.csv", text if i else "﻿" + text)
        want[f"f{i}.csv"] = dict(enumerate(trimmed(r) for r in csv.reader(io.StringIO(text, newline="")) if r))
    put(folder, "g.csv.gz", gzip.compress(text.encode()))
    put(folder, "h.csv.bz2", bz2.compress(text[:900].encode()) + bz2.compress(text[900:].encode()))
    want["g.csv.gz"] = want["h.csv.bz2"] = want["f5.csv"]
    grid, states = files.csv_tables(spark, folder, "*.csv*")
    lines = records.read_records(spark, folder, "*.csv").lines
    assert lines.select("file_path", "start").distinct().count() > 30
    assert {f: {i: trimmed(c) for i, c in rows.items()} for f, rows in grids(grid).items()} == want
    assert {r.reason for r in states.collect()} == {None} and states.count() == 8


def states_by_hand(text):
    """Records of a text, one character after another."""
    out, cell, now = [], "start", ""
    for k, c in enumerate(text):
        if c == "\n" and cell != "quoted":
            if now:
                out.append(now)
            now, cell = "", "start"
            continue
        now += c
        if cell == "start":
            cell = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif cell == "quoted":
            cell = "closing" if c == '"' else "quoted"
        elif cell == "closing":
            cell = "quoted" if c == '"' else "start" if c == "," else "plain"
        else:
            cell = "start" if c == "," else "plain"
        if cell == "closing" and text[k + 1 : k + 2] != '"':
            cell = "start" if text[k + 1 : k + 2] == "," else "plain"
    return (out + [now] if now else out), cell == "quoted"


def test_record_borders_of_random_text(spark, folder, small_splits):
    rng, want, open_ = random.Random(8), {}, set()
    for i in range(12):
        text = "".join(rng.choices('ab",\n', weights=[4, 4, rng.choice([1, 3]), 2, 2], k=3000))
        put(folder, f"{i}.csv", text)
        found, unclosed = states_by_hand(text)
        if unclosed:
            open_.add(f"{i}.csv")
        else:
            want[f"{i}.csv"] = dict(enumerate(found))
    read = records.read_records(spark, folder)
    got = {}
    for r in read.records().withColumn("f", F.substring_index("file_path", "/", -1)).collect():
        got.setdefault(r.f, {})[r.row_no] = r.record
    assert got == want
    named = F.substring_index("file_path", "/", -1).alias("f")
    assert {r.f for r in read.files.where("reason = 'incomplete: open quote'").select(named).collect()} == open_


def test_a_file_that_breaks_after_many_good_rows_gives_none(spark, folder):
    rows = "".join(f"{i},Firma {i} SRL,Titlu\n" for i in range(200_000))
    packed = gzip.compress(("Cod SMIS,Beneficiar,Titlu proiect\n" + rows).encode())
    put(folder, "half.csv.gz", packed[: len(packed) // 2])
    put(folder, "flipped.csv.gz", packed[:5000] + bytes([packed[5000] ^ 255]) + packed[5001:])
    put(folder, "open.csv", 'Cod SMIS,Beneficiar,Titlu proiect\n1,Firma SRL,T\n2,"Firma\n')
    put(folder, "good.csv.gz", gzip.compress(b"Cod SMIS,Beneficiar,Titlu proiect\n1,Firma SRL,T\n"))
    put(folder, "bare.csv", "Cod SMIS,Beneficiar,Titlu proiect\r\n1,Firma SRL,T")
    put(folder, "empty.csv", "")
    grid, states = files.csv_tables(spark, folder)
    grid, states = (df.withColumn("file_path", files.relative_path(F.col("file_path"), folder)) for df in (grid, states))
    names = ["half.csv.gz", "flipped.csv.gz", "open.csv", "good.csv.gz", "bare.csv", "empty.csv"]
    listed = spark.createDataFrame([("p", "d", "u", n, "h", 1, "t", {}) for n in names], schema.MANIFEST)
    report = {r.file_path: (r.n_kept, r.reason) for r in build.extract_report(grid, manifest=listed, states=states).collect()}
    assert report == {
        "half.csv.gz": (0, "incomplete"), "flipped.csv.gz": (0, "incomplete"), "open.csv": (0, "incomplete: open quote"),
        "good.csv.gz": (1, None), "bare.csv": (1, None), "empty.csv": (0, "unreadable"),
    }
    assert {r.source_file for r in build.extract_tables(grid, listed).collect()} == {"good.csv.gz", "bare.csv"}


def test_a_plain_file_of_which_bytes_are_missing_is_not_whole(spark, folder):
    put(folder, "a.csv", "a,b\n1,2\n3,4\n")
    read = records.read_records(spark, folder)
    assert read.files.first().whole
    fewer = read.lines.where("place < 2")
    assert fewer.agg(F.sum("bytes")).first()[0] + 4 == fewer.first()["size"]


@pytest.mark.parametrize("archive", [False, True])
def test_raw_rows_are_read_once(spark, archive):
    """Each raw row passes an accumulator; it must count every row exactly once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    head = ["Cod SMIS", "Denumire beneficiar", "Titlu proiect"]
    rows = [(f"f{f}", i, head if i == 1 else [str(10000 + i), f"Firma {i}", "T"]) for f in range(4) for i in range(300)]
    grid = spark.createDataFrame(rows, "file_path string, row_no long, cells array<string>").repartition(3)
    grid = grid.mapInPandas(count, grid.schema)
    listed = spark.createDataFrame([("p", "d", "u", f"f{f}", "h", 1, "t", {}) for f in range(4)], schema.MANIFEST)
    found = build.extract_tables(grid, listed, archive=archive)
    assert found.count() == 4 * 298 and seen.value == len(rows)
    table = headers.grid_to_table(grid)
    assert table.count() == 4 * 298 and seen.value == 2 * len(rows)


def test_the_grid_of_files_scans_no_raw_text_again(spark, folder):
    put(folder, "a.csv", "a,b\n1,2\n")
    plan = files.csv_grid(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan and "binaryFile" not in plan


def test_two_readings_and_blocks_of_another_width(spark):
    head = ["Cod SMIS", "Denumire beneficiar", "Titlu proiect"]
    one = [(0, 0, head), (0, 1, ["12345", "Firma A", "T"]), (0, 2, ["12346", "Firma B", "T"]), (1, 3, ["a", "b"]), (1, 4, ["c", "d"]), (2, 5, ["12347", "Firma C", "T"])]
    two = [(0, 0, ["x", "y", "z"]), (0, 1, head), (0, 2, ["12345", "Firma A", "T"])]
    grid = [("f", v, *r) for v, rows in (("a", two), ("b", one)) for r in rows] + [("g", v, *r) for v in "ab" for r in one]
    grid = spark.createDataFrame(grid, "file_path string, variant string, block_no int, row_no long, cells array<string>")
    listed = spark.createDataFrame([("p", "d", "u", f, "h", 1, "t", {}) for f in "fg"], schema.MANIFEST)
    staged = build.stage_tables(grid, archive=True)
    rows = sorted((r.source_file, r.source_row, r.project_code) for r in build.extract_tables(staged, listed, archive=True).collect())
    assert rows == [(f, i, c) for f in "fg" for i, c in enumerate(["12345", "12346", "12347"])]
    report = {r.file_path: (r.variant, r.n_lines, r.n_kept, r.blocks_skipped, r.reason) for r in build.extract_report(staged, archive=True).collect()}
    assert report == {"f": ("b", 6, 3, 1, None), "g": ("a", 6, 3, 1, None)}
