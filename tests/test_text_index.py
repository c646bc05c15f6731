"""Search by trigram postings against the full scan."""

import random
import re
import tempfile
from functools import reduce

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from grantweave.operators import text_index
from grantweave.operators.analytics import text_matches

WORDS = ["ACME", "Digital", "SRL", "Școala", "țară", "erp", "DİGİTAL", "\u212aelvin", "ſoft", "SOFT", "a.b", "x+y", "RO1234567", "kelvin", "straße", "[id]", "ERP-42"]


@pytest.fixture(scope="module")
def indexed(spark):
    rng = random.Random(2)
    rows = [(f"r{i}", rng.choice([None, " ".join(rng.choices(WORDS, k=3))]), " ".join(rng.choices(WORDS, k=4)), rng.choice([None, "RO1234567", "9912"])) for i in range(400)]
    df = spark.createDataFrame([*rows, (None, "ACME", "ACME", None)], "id string, name string, title string, cui string").repartition(4).cache()
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    text_index.write_index(df, "id", ["name", "title", "cui"], folder)
    return df.where("id IS NOT NULL"), folder


@pytest.mark.parametrize("quote", [False, True])
@pytest.mark.parametrize("needle", [
    "digital", "DIGITAL", "soft", "Kelvin", "acme srl", "Școala", "ar", "straße", "a.b", "x+y", "erp|soft", "erp|s", "di.ital", "dig[aei]tal",
    "colou?r", "(acme|erp) srl", "srl (acme", "erp-\\d+", "[[x]id]", "123456", "9912", "soft{1,2}", "acme.*srl", "^acme", "srl$", "(?:erp)", "zzz", "\\bsoft\\b", "ri\\.",
])
def test_same_rows_as_the_full_scan(spark, indexed, needle, quote):
    df, folder = indexed
    tests = [text_matches(F.coalesce(F.col(c), F.lit("")), needle, quote) for c in ("name", "title")] + [F.coalesce("cui", F.lit("")).contains(needle)]
    found = text_index.indexed_search(df, folder, needle, "id", ["name", "title"], ["cui"], quote)
    try:
        want = sorted(r.id for r in df.where(reduce(Column.__or__, tests)).collect())
    except Exception:
        with pytest.raises(Exception):
            found.collect()
        return
    assert sorted(r.id for r in found.collect()) == want


def test_literal_stretches_must_occur():
    rng = random.Random(4)
    for _ in range(3000):
        pattern = "".join(rng.choices(["a", "b", "c", "ab", "abc", "|", "(", ")", "?", "*", "+", ".", "[ab]", "\\.", "\\d", "{2}", "^", "$"], k=rng.randrange(1, 7)))
        try:
            compiled = re.compile(pattern)
        except re.error:
            continue
        ways = text_index.alternatives(pattern)
        if ways is None:
            continue
        for _ in range(20):
            text = "".join(rng.choices("abc.1", k=rng.randrange(10)))
            if compiled.search(text):
                assert any(all(r in text for r in w) for w in ways), (pattern, text, ways)


def test_candidates_prune(spark, indexed):
    df, folder = indexed
    found = text_index.candidates(folder, spark, "ERP-42")
    assert 0 < found.count() < df.count()
    assert text_index.candidates(folder, spark, "ar") is None and text_index.candidates(folder, spark, "erp|s") is None
    plan = text_index.indexed_search(df, folder, "erp-42", "id", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "In(trigram" in plan


def test_postings_of_repeated_rows(spark):
    rows = [("r1", "erp soft"), ("r1", "erp soft"), ("r1", "acme"), ("r2", "soft"), (None, "erp soft")]
    df = spark.createDataFrame(rows, "id string, name string").repartition(3)
    # No task holds a table of its postings: they go straight to their ranges.
    plan = text_index.postings(df, "id", ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    text_index.write_index(df, "id", ["name"], folder)
    for needle, want in (("erp soft", ["r1"]), ("soft", ["r1", "r2"]), ("erp|acme", ["r1"]), ("zzz", [])):
        assert sorted(r.key for r in text_index.candidates(folder, spark, needle).collect()) == want
    found = text_index.indexed_search(df.where("id IS NOT NULL"), folder, "soft", "id", ["name"])
    assert sorted(map(tuple, found.collect())) == [("r1", "erp soft"), ("r1", "erp soft"), ("r2", "soft")]
