"""Golden values of the scalar functions."""

import datetime as dt
import html as stdlib_html
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from grantweave.functions import amounts, html, keywords, links, parse, places, text, vectors
from grantweave.operators import selection


def many(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", function(df.x).alias("y")).orderBy("i").collect()]


def test_plain_letters_match_unicode(spark):
    rng = random.Random(1)
    pool = [chr(c) for c in (*range(0x20, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2200), *range(0xFB00, 0xFB07), *range(0x300, 0x370), 0x1D400, 0x1F600)]
    values = ["Județ", "ﬁn ½ ™ … Ĳ", "ascii", ""] + ["".join(rng.choices(pool, k=40)) for _ in range(200)]
    wanted = [
        "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)) for v in values
    ]
    assert many(spark, text.plain_letters, values) == wanted


def test_slug_and_squeeze(spark):
    assert many(spark, text.slug, ["  Ștefan-cel  MARE! ", None, "—"]) == ["stefan cel mare", "", ""]
    assert many(spark, text.squeeze, [" a \n\t b\xa0 c ", None]) == ["a b c", ""]


@pytest.mark.parametrize(
    ("mode", "wanted"),
    [("literal", ["acme", "acme", "acme r l", "", "alfa beta"]), ("intended", ["acme", "acme", "acme", "", "alfa beta"])],
)
def test_company_key(spark, mode, wanted):
    names = ["ACME SRL", "Acme", "S.C. ACME S.R.L.", None, "SC Alfa S Beta SRL SA"]
    assert many(spark, lambda c: text.company_key(c, mode), names) == wanted


def test_fiscal_code(spark):
    values = ["RO 12345678", "12345678", "RO12345678", "-", "nan", None, "000", "00123", "RO1.234.567", "x1"]
    wanted = ["12345678"] * 3 + [None] * 4 + ["123", "1234567", None]
    assert many(spark, text.fiscal_code, values) == wanted


def test_money(spark):
    values = ["1.234.567,89 lei", "1,234,567.89", "1,5", "1.234.567", "-", "1.234", "", None, "-5,5", "1,2,3"]
    assert many(spark, parse.money, values) == [1234567.89, 1234567.89, 1.5, None, None, 1.234, None, None, -5.5, None]


def test_dates(spark):
    day = dt.date(2020, 12, 31)
    values = ["31.12.2020", "31/12/2020", "2020-12-31", "31-12-2020", "12/31/2020", "2020/12/31", "31.12.2020 10:00",
              "45292", "1.2.98", "1.2.68", "31.02.2020", "nan", None, "200001", "1", "45292,5", "1e300"]
    wanted = [day] * 7 + [dt.date(2024, 1, 1), dt.date(1998, 2, 1), dt.date(2068, 2, 1), None, None, None, None, None, dt.date(2024, 1, 1), None]
    assert many(spark, parse.date, values) == wanted


def test_long_and_iso_dates(spark):
    day = dt.date(2026, 12, 31)
    values = ["31 decembrie 2026 23:59", "31.12.2026", "2026-12-31T10:00", "31 februarie 2026", "5 foo 2026", None]
    assert many(spark, parse.long_date, values) == [day, day, day, None, None, None]
    assert many(spark, parse.iso_date, ["2026-12-31T00:00", "20261231", "x", None]) == [day, day, None, None]


def test_call_amount(spark):
    values = ["33.435.294 EUR", "1.234,50 lei", "1,5 RON", "fără", None]
    got = [tuple(r) for r in many(spark, parse.call_amount, values)]
    assert got == [(33435294.0, "EUR"), (1234.5, "RON"), (None, "RON"), (None, None), (None, None)]


def test_json_values(spark):
    rows = ['{"a":["x","y"],"c":"45.1, 25.3"}', '{"a":"x","c":"45"}', '{"a":[],"c":"a,1"}', "{}"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string").withColumn("v", F.parse_json("s"))
    out = df.orderBy("i").select(
        parse.first_value(F.col("v"), "a").alias("a"), parse.lat_long(parse.first_value(F.col("v"), "c")).alias("p")
    ).collect()
    assert [r.a for r in out] == ["x", "x", None, None]
    assert [tuple(r.p) for r in out] == [(45.1, 25.3), (None, None), (None, None), (None, None)]
    assert many(spark, parse.comma_decimal, ["1,5", "2", "1d", None]) == [1.5, 2.0, None, None]
    assert many(spark, parse.clean_markup, ["<p>a&nbsp;b</p>", "<br>", None]) == ["a b", None, None]


def test_unescape_matches_html(spark):
    rng = random.Random(2)
    names = sorted(__import__("html.entities").entities.html5)
    values = ["&amp;lt; a & b", "&#233;&#xe9;&#0;&#128;&#xD800;&#1114112;&#9999999999999999999999999;&#xFFFFFFFFFFFFFFFFFFFFFFFF;&#x0000000000000000000041;&#000065;&#x0;&#xFFFE;&#xFDD0;&#x", "&notit; &ampx &copy2", "&&;&", "plain"]
    values += ["x".join("&" + rng.choice(names) for _ in range(8)) for _ in range(60)]
    assert many(spark, html.unescape, values) == [stdlib_html.unescape(v) for v in values]


PAGE = """<html><script>var a="<p>";</script><style>p{}</style><h3>Buget UE:</h3><b>33.435.294 EUR</b>
<p>Data deschiderii:</p> <p>1 ianuarie 2026</p><p>Data închiderii: </p><p>31 decembrie 2026 23:59</p>
<p>Tip Apel:</p><p>&nbsp;Competitiv fără termen</p><p>Obiectivul specific:</p><p>RSO1.2 &amp; altele</p>
<p>Beneficiari eligibili</p><ul><li>IMM</li><li>ONG, UAT.</li><li>IMM</li></ul><p>Criterii de eligibilitate</p>
<p>Domenii Apel:</p><p>Digitalizare</p><p>Cercetare</p><p>Zone Geografice</p>
<a href="https://x.ro/b.pdf">b</a><a href="https://x.ro/a.pdf">a</a><a href="https://x.ro/b.pdf">b</a><a href="/c.pdf">c</a></html>"""


def test_call_page(spark):
    df = spark.createDataFrame([(PAGE,)], "page string").withColumn("text", html.plain_text(F.col("page")))
    row = df.select(*[c.alias(n) for n, c in html.call_page(F.col("text"), F.col("page")).items()]).first()
    assert row.budget_amount == 33435294.0 and row.budget_currency == "EUR"
    assert (row.opens_at, row.closes_at) == (dt.date(2026, 1, 1), dt.date(2026, 12, 31))
    assert row.call_type == "Competitiv fără termen" and row.continuous
    assert row.specific_objective == "RSO1.2 & altele"
    assert row.beneficiaries == ["IMM", "ONG", "UAT"]
    assert row.domains == ["Digitalizare", "Cercetare"]
    assert row.documents == ["https://x.ro/a.pdf", "https://x.ro/b.pdf"] and row.programs == []


def test_plain_text_survives_long_runs(value):
    page = "<p>" + "<br> \n" * 50_000 + "x" + "\n" * 50_000 + "</p>"
    assert value(html.plain_text, page).strip("\n") == "|x|"


def test_counties_and_regions(spark):
    rows = ["Bihor,BN, Cluj, MM, SM, SJ", "nivel national", "Maramureș", "Sud-Vest Oltenia", "nord vest", "bucuresti ilfov", "", None, "Bistrita Nasaud; CSA"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, county string")
    got = places.with_places(df).orderBy("i").collect()
    assert got[0].counties == ["Bihor", "Bistrița-Năsăud", "Cluj", "Maramureș", "Satu Mare", "Sălaj"]
    assert got[0].regions == ["Nord-Vest"]
    assert [r.counties for r in got[1:]] == [["Național"], ["Maramureș"], [], [], ["București", "Ilfov"], [], [], ["Bistrița-Năsăud"]]
    assert [r.regions for r in got[3:6]] == [["Sud-Vest Oltenia"], ["Nord-Vest", "Vest"], ["București-Ilfov"]]
    assert got[1].regions == [] and set(got[0].asDict()) == {"i", "county", "counties", "regions"}


def test_status(spark):
    rows = ["Finalizat", "FINALIZAT ", "fINALIZAT", "Proiect finalizat", "nefinalizat", "în curs de reziliere", "22", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, project_status string")
    got = [r.status for r in places.with_status(df).orderBy("i").collect()]
    assert got == ["Finalizat"] * 4 + ["Nefinalizat", "În reziliere", "Necunoscut", "Necunoscut"]


def test_call_status(spark):
    day = dt.date(2026, 6, 1)
    rows = [(None, dt.date(2026, 5, 31), True), (dt.date(2026, 6, 2), None, False), (None, day, False), (None, None, True), (None, None, False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, o date, c date, k boolean")
    got = df.orderBy("i").select(places.call_status(df.o, df.c, df.k, F.lit(day)).alias("s"), places.days_left(df.c, F.lit(day)).alias("d")).collect()
    assert [r.s for r in got] == ["Închis", "Urmează", "Activ", "Activ", "Necunoscut"]
    assert [r.d for r in got] == [None, None, 0, None, None]


def test_eu_amount(spark):
    rows = [(100.0, None, 85.0), (100.0, None, 0.85), (100.0, 120.0, 50.0), (100.0, None, 8580.0), (None, 50.0, 10.0), (100.0, 30.0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, total_eligible_amount double, eu_amount double, cofinancing_rate double")
    got = [(r.eu_amount_derived, r.eu_amount_source) for r in amounts.with_eu_amount(df).orderBy("i").collect()]
    assert got == [(85.0, "calculat"), (85.0, "calculat"), (None, None), (None, None), (50.0, "publicat"), (30.0, "publicat")]


def test_keyword_score(spark):
    rows = [
        ("capitalizare interpretare biotehnologie apicultură", None, None),
        ("digitalizare", None, None),
        ("Digitalizării", "soluții informatice", None),
        ("canalizare și cloud", None, "16"),
        ("software", None, None),
    ]
    df = spark.createDataFrame([(i, *r, "6201") if i == 4 else (i, *r, None) for i, r in enumerate(rows)], "i int, t string, s string, iv string, caen string")
    got = keywords.with_keyword_score(df, "t", "s", activity="caen", intervention="iv").orderBy("i").collect()
    assert (got[0].software_score, got[0].software_label, got[0].software_evidence) == (0.0, "necunoscut", "")
    assert (got[1].software_score, got[1].software_label) == (0.525, "digitalizare")
    # Equal weight sums: the label hit first keeps the row.
    assert (got[2].software_score, got[2].software_label, got[2].software_evidence) == (0.735, "produs", "solutie informatica; digitalizare")
    assert got[3].software_evidence == "intervenție 016; cloud; -canalizare" and got[3].software_label == "infrastructura"
    assert got[4].software_score == 0.9 and got[4].software_evidence == "CAEN 6201; software"


def test_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, None), (3, [1.0, 0.9])], "i int, v array<float>")
    got = [r.s for r in df.select("i", vectors.contrastive_score(df.v, [[2.0, 0.0]], [[0.0, 1.0]]).alias("s")).orderBy("i").collect()]
    assert got[:3] == [1.0, 0.0, 0.0] and got[3] == round((0.1 / 1.81**0.5 - 0.03) / 0.27, 3)


def test_links(spark):
    from urllib.parse import quote

    df = spark.createDataFrame([("kohesio", "Q1", "Școala a/b & c~*", None), ("x", "Q1", "t", "Ro 1")], "s string, c string, t string, u string")
    got = df.select(links.project_link(df.s, df.c).alias("p"), links.search_link(df.t, df.u).alias("q"), links.fiscal_link(df.u).alias("f")).collect()
    assert [r.p for r in got] == ["https://kohesio.ec.europa.eu/en/projects/Q1", None]
    assert [r.q.split("=")[1].split("&")[0] for r in got] == [quote("Școala a/b & c~*"), quote("t Ro 1")]
    assert got[0].f is None and got[1].f.endswith("cui=Ro%201")


def test_selection(spark):
    names = ["http://x.ro/Lista%20proiectelor.pdf?x=1", "http://x.ro/lista_contracte.xlsx", "http://x.ro/lista_contracte_respins.pdf", "http://x.ro/ghid.pdf", "http://x.ro/lista_proiectelor.doc"]
    assert many(spark, selection.is_project_list, names) == [True, True, False, False, False]
    assert many(spark, selection.program_in, ["Lista POCU 2024", "pocument", None]) == ["POCU", None, None]
    assert many(spark, selection.snapshot_date, ["https://web.archive.org/web/20240515125245id_/x", "x"]) == ["2024-05-15", None]
    assert many(spark, lambda c: selection.usable_url(c, F.lit("http://b")), ["", " https://a ", "/rel"]) == ["http://b", "https://a", "http://b"]


def test_common_letters_need_no_table_of_all(spark):
    """Rare letters, ligatures and marks beside common ones read as without the short table."""
    values = ["înșățe", "é" + "҉x", "ﬁn ăș", "αβγέ ț", "Ⅷ①", "é⃐", "ǅŉĲµªẞ", "한 î", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").orderBy("i").select(text.plain_letters(F.col("t"))).collect()]
    assert got[0] == "insate" and got[2] == "fin as" and got[-2:] == ["", None]
    for value, plain in zip(values, got):
        if value and "한" not in value:
            assert plain == "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    plan = spark.range(1).select(text.plain_letters(F.col("id").cast("string")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") >= 2
