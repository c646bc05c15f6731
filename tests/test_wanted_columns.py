"""A build of some columns shuffles no others, and gives the same values; closed lists are looked up by one pattern."""

import random
import re

import pytest
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave import schema
from grantweave.functions import keywords, places
from grantweave.functions.text import slug
from grantweave.operators import dedup
from grantweave.plans import build


def interim(spark):
    rows = [
        ("POCU", "1", "Aplicație software", None, "ACME SRL", "Cluj, BN", 100.0, None, "portal", "f", 1, "2024-01-01", "Finalizat"),
        ("POCU", "1", "Aplicație software", "inteligență artificială", "Acme", None, 90.0, 60.0, "portal", "f", 2, "2023-01-01", None),
        ("POR", None, "Drum", None, "Beta SA", "Olt", None, None, "arhiva", "g", 3, None, "Reziliat"),
        (None, None, None, None, None, None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, 5.0, None, None, None, 4, None, None),
    ]
    names = "program project_code project_title project_summary beneficiary_name county total_eligible_amount eu_amount source source_file source_row fetched_at project_status"
    kinds = {"total_eligible_amount": "double", "eu_amount": "double", "source_row": "long"}
    return schema.conform(spark.createDataFrame(rows, ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names.split())))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "columns",
    [("is_software",), ("record_id",), ("counties", "status"), ("eu_amount_derived", "eu_amount"), ("program",), ("record_id", "software_label", "fetched_at")],
)
def test_some_columns_hold_what_the_whole_build_holds(spark, columns):
    whole = build.build_projects(interim(spark))
    assert whole.columns == schema.BUILT_PROJECTS.fieldNames()
    assert rows(build.build_projects(interim(spark), columns=columns)) == rows(whole.select(*columns))


def test_the_id_is_that_of_the_row_kept(spark):
    built = build.build_projects(interim(spark))
    with_id = dedup.deduplicate(dedup.add_identity(interim(spark)))
    assert rows(built.select("record_id", "source_row", "project_summary")) == rows(with_id.select("record_id", "source_row", "project_summary"))


def test_the_merge_shuffles_only_what_is_wanted(spark):
    text = build.build_projects(interim(spark), columns=["is_software"])._jdf.queryExecution().optimizedPlan().toString()
    for unused in ("county", "total_eligible_amount", "source_sha256", "cofinancing_rate"):
        assert unused not in re.search(r"Aggregate .*", text)[0]
    assert "project_title" in text


def test_phrases_are_found_by_one_pattern(spark):
    texts = ["aplicatii software pentru ERP", "soft", "platforma online si platforme software", "", "xerp erp", "constructii si canalizare"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    known = [k for k, *_ in [*fv.KEYWORDS, *fv.NEGATIVE_KEYWORDS]]
    padded = F.concat(F.lit(" "), slug(F.col("t")), F.lit(" "))
    for t, found in df.select("t", keywords.phrases_in(padded, known)).collect():
        assert found == [n for n, k in enumerate(known, 1) if re.search(keywords.phrase_pattern(k), f" {t.lower()} ")]
    plan = df.select(keywords.phrases_in(F.col("t"), known))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("contains(") + plan.count("rlike(") < 3


def test_names_within_names_count(spark):
    texts = {"bucuresti-ilfov": ["București", "Ilfov"], "satu mare, olt": ["Olt", "Satu Mare"], "oltenia": [], "caras severin CJ": ["Caraș-Severin", "Cluj"]}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    named = places.named_counties(F.lower("t"), places.isolated_codes(F.col("t")), places.PlaceDictionary())
    assert dict(map(tuple, df.select("t", named).collect())) == texts
    none = places.named_counties(F.lower("t"), places.isolated_codes(F.col("t")), places.PlaceDictionary(counties={}))
    assert {len(r[0]) for r in df.select(none).collect()} == {0}


def test_words_that_fit_several_phrases_count_for_each(spark):
    known = ["digitala", "digitalizare", "digitala digitalizare", "cloud", "clou", "automata", "automatizare proces", "a"]
    texts = ["digitalizar digitalizarea", "digitalizari", "digital", "clou", "cloudy", "automatizar procese", "a a", "", "digitalizareaxx"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", keywords.phrases_in(F.concat(F.lit(" "), "t", F.lit(" ")), known))
    for t, numbers in found.collect():
        assert numbers == [n for n, k in enumerate(known, 1) if re.search(keywords.phrase_pattern(k), f" {t} ")]


def test_patterns_are_constants(spark):
    known = [k for k, *_ in fv.KEYWORDS]
    plan = spark.range(1).select(keywords.phrases_in(F.col("id").cast("string"), known).alias("n"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike(" not in plan and plan.count("regexp_replace(") <= 2


def test_only_the_wanted_parts_of_a_score_are_made(spark):
    text = build.build_projects(interim(spark), columns=["is_software"])._jdf.queryExecution().optimizedPlan().toString()
    assert fv.LABEL_UNKNOWN not in text and "intervenție" not in text


def test_absent_columns_are_filled_in_after_the_merge(spark):
    whole = interim(spark)
    given = [c for c in whole.columns if whole.where(F.col(c).isNotNull()).count()]
    built = build.build_projects(whole.select(*given, "source_url"))
    assert built.schema == build.build_projects(whole).schema and rows(built) == rows(build.build_projects(whole))
    aggregate = re.search(r"Aggregate .*", built._jdf.queryExecution().optimizedPlan().toString())[0]
    assert "latitude" not in aggregate


def test_rows_dealt_by_key_merge_as_by_partial_aggregates(spark):
    rnd, sample = random.Random(7), []
    for n in range(600):
        code = "hot" if n % 3 == 0 else None if n % 10 == 0 else str(rnd.randrange(150))
        sample.append((
            rnd.choice(["POR", None]), code, rnd.choice(["Drum", None]), rnd.choice(["Acme", "ACME SRL", "Beta", None]), rnd.choice(["portal", None]),
            rnd.choice(["f", "g", None]), n, rnd.choice(["2024-01-01", "2023-05-01", None]), rnd.choice([1.0, 2.0, None]), rnd.choice(["Olt", None]),
        ))
    named = "program string, project_code string, project_title string, beneficiary_name string, source string, source_file string, source_row long, fetched_at string, eu_amount double, county string"
    df = dedup.add_identity(schema.conform(spark.createDataFrame(sample, named)))
    whole = dedup.deduplicate(df)
    for rows_per_task in (20, 1_000, 1):
        dealt = dedup.deduplicate(df, rows_per_task=rows_per_task)
        assert rows(dealt) == rows(whole)
        text = dealt._jdf.queryExecution().executedPlan().toString()
        assert ("REPARTITION_BY_NUM" in text) == (rows_per_task < 600) and ("Union" in text) == (rows_per_task < 600)
    assert rows(dealt.where("program = 'POR'")) == rows(whole.where("program = 'POR'"))


def test_rows_are_dealt_without_what_is_read_off_them(spark):
    plain = interim(spark).drop("record_id")
    order = [c for c in dedup.SEQUENCE if c != "record_id"]
    dealt = dedup.deduplicate(plain, wanted={"beneficiary_key", "eu_amount"}, sequence=order, rows_per_task=3, identity="literal")
    text = dealt._jdf.queryExecution().executedPlan().toString()
    shuffled = text[text.index("REPARTITION_BY_NUM"):]
    assert "beneficiary_name" in shuffled and "regexp_replace" not in shuffled and "translate(hex" not in shuffled
    whole = dedup.deduplicate(dedup.add_identity(plain))
    assert rows(dealt) == rows(whole.select(dealt.columns))


def test_rows_are_dealt_among_tasks_written_to_straight_away(spark):
    assert dedup._dealing(spark.range(600).selectExpr("id AS x"), ["x"], 1)[0] == 200
    assert dedup._dealing(spark.range(100).selectExpr("id AS x"), ["x"], 1)[0] == 100
    assert dedup._dealing(spark.range(5 * 300).selectExpr("id AS x"), ["x"], 1)[0] == 300
