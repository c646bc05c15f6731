"""Named queries over the driver tables, each with the same answer in plain SQL.

``INPUT`` expressions are written so that Spark and the checking engine read
them alike; everything after the input is written twice, once with this
package's operators and once as SQL.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grantweave import fixed_values as fv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and, where there is one, its SQL twin."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(value: str, *options: str) -> str:
    """SQL choosing an option by a whole number, round robin."""
    cases = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE ({value}) % {len(options)} {cases} ELSE {options[-1]} END"


def text_of(value: str) -> str:
    return f"cast({value} as string)"


def two_digits(value: str) -> str:
    return f"lpad(cast({value} as string), 2, '0')"


def grouped(whole: str, mark: str) -> str:
    """A whole number below 10^9 with thousands marks, in SQL."""
    w = f"cast({whole} as bigint)"
    thousands = f"cast(floor({w} / 1000) as bigint)"
    millions = f"cast(floor({w} / 1000000) as bigint)"
    low = f"lpad(cast({w} % 1000 as string), 3, '0')"
    mid = f"lpad(cast({thousands} % 1000 as string), 3, '0')"
    return (
        f"CASE WHEN {w} >= 1000000 THEN concat(cast({millions} as string), '{mark}', {mid}, '{mark}', {low}) "
        f"WHEN {w} >= 1000 THEN concat(cast({thousands} as string), '{mark}', {low}) "
        f"ELSE cast({w} as string) END"
    )


# ------------------------------------------------- SQL twins of the functions

SPACES = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def plain_sql(x: str) -> str:
    return f"strip_accents({x})"


def slug_sql(x: str) -> str:
    return f"coalesce(trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g')), '')"


def squeeze_sql(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{SPACES}+', ' ', 'g')), '')"


_FORMS = "|".join(fv.LEGAL_FORMS)


def company_sql(x: str, mode: str = "literal") -> str:
    key = slug_sql(x)
    if mode == "intended":
        spelled = "|".join(fv.SPELLED_LEGAL_FORMS)
        key = f"regexp_replace({key}, '((^| )({spelled}|{_FORMS}))+$', '')"
    kept = (
        f"array_to_string(list_filter(string_split({key}, ' '), "
        "lambda t: t NOT IN ('', 'sc', 's', 'c')), ' ')"
    )
    return f"coalesce(trim(regexp_replace({kept}, '((^| )({_FORMS}))+$', '')), '')"


def number_sql(x: str) -> str:
    pattern = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN try_cast({x} as double) END"


def money_sql(x: str) -> str:
    t = f"regexp_replace({x}, '[^0-9,.-]', '', 'g')"
    last = f"(length({t}) - strpos(reverse({t}), ',') > length({t}) - strpos(reverse({t}), '.'))"
    number = (
        f"CASE WHEN contains({t}, ',') AND contains({t}, '.') AND {last} "
        f"THEN replace(replace({t}, '.', ''), ',', '.') "
        f"WHEN contains({t}, ',') AND contains({t}, '.') THEN replace({t}, ',', '') "
        f"ELSE replace({t}, ',', '.') END"
    )
    return number_sql(f"({number})")


def _word_sql(plain: str, name: str) -> str:
    form = "".join(
        c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)
    ).lower()
    body = "[ -]".join(re.split("[ -]", form))
    return f"regexp_matches({plain}, '(^|[^a-z]){body}([^a-z]|$)')"


def counties_sql(text: str) -> str:
    """Sorted list of counties named in a text (or the national entry)."""
    plain = f"lower(strip_accents({text}))"
    items = []
    for county, (code, _) in fv.COUNTIES.items():
        tests = [_word_sql(plain, county)]
        tests += [_word_sql(plain, s) for s, c in fv.COUNTY_SPELLINGS.items() if c == county]
        if len(code) == 2:
            tests.append(f"regexp_matches({text}, '(^|[^A-Za-z]){code}([^A-Za-z]|$)')")
        items.append(f"CASE WHEN {' OR '.join(tests)} THEN '{county}' END")
    found = f"list_sort(list_filter([{', '.join(items)}], lambda c: c IS NOT NULL))"
    markers = " OR ".join(f"contains({plain}, '{m}')" for m in fv.NATIONAL_MARKERS)
    return f"CASE WHEN len({found}) = 0 AND ({markers}) THEN ['{fv.NATIONAL}'] ELSE {found} END"


def regions_sql(text: str, counties: str) -> str:
    plain = f"lower(strip_accents({text}))"
    region_of = " ".join(f"WHEN '{c}' THEN '{r}'" for c, (_, r) in fv.COUNTIES.items())
    owned = (
        f"list_sort(list_distinct(list_filter(list_transform({counties}, "
        f"lambda c: CASE c {region_of} END), lambda r: r IS NOT NULL)))"
    )
    named = []
    for region, pattern in fv.REGION_PATTERNS.items():
        body = pattern.replace("(?<![a-z-])", "(^|[^a-z-])").replace("(?<![a-z])", "(^|[^a-z])")
        body = body.replace("(?![a-z])", "([^a-z]|$)")
        named.append(f"CASE WHEN regexp_matches({plain}, '{body}') THEN '{region}' END")
    listed = f"list_sort(list_filter([{', '.join(named)}], lambda r: r IS NOT NULL))"
    return f"CASE WHEN len({owned}) > 0 THEN {owned} ELSE {listed} END"


def status_sql(x: str) -> str:
    rules = " ".join(
        f"WHEN contains({slug_sql(x)}, '{fragment}') THEN '{status}'"
        for fragment, status in fv.STATUS_RULES
    )
    return f"CASE {rules} ELSE '{fv.STATUS_UNKNOWN}' END"


def eu_sql(eligible: str, published: str, rate: str) -> tuple[str, str]:
    fraction = (
        f"CASE WHEN {rate} > 0 AND {rate} <= 100 THEN "
        f"CASE WHEN {rate} > 1 THEN {rate} / 100.0 ELSE {rate} END END"
    )
    product = f"round({eligible} * ({fraction}), 2)"
    computed = f"CASE WHEN {product} > {eligible} THEN NULL ELSE {product} END"
    combined = f"coalesce({published}, {computed})"
    over = f"coalesce({combined} > {eligible}, false)"
    amount = f"CASE WHEN {over} THEN NULL ELSE {combined} END"
    source = (
        f"CASE WHEN {over} THEN NULL WHEN {published} IS NOT NULL THEN 'publicat' "
        f"WHEN ({computed}) IS NOT NULL THEN 'calculat' END"
    )
    return amount, source


def phrase_sql(slug: str, phrase: str) -> str:
    words = [
        w if len(w) < fv.STEM_MIN_CHARS else f"{w[:-1]}[a-z]{{0,{fv.STEM_MAX_ENDING}}}"
        for w in phrase.split()
    ]
    return f"regexp_matches({slug}, '(^|[^a-z0-9]){'[ -]+'.join(words)}([^a-z0-9]|$)')"


def round3_sql(x: str) -> str:
    """Three decimals, half up, judged on the digits the number is written with."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(20, 17)), 3) AS double)"


def keyword_ctes(
    source: str,
    key: str,
    text: str,
    keywords: list[tuple[str, str, float]],
    negatives: list[tuple[str, float]],
    extra: list[tuple[str, str, str, float]] | None = None,
    columns: tuple[str, ...] = (),
) -> str:
    """CTEs ending in ``scored(key, software_score, software_label,
    software_evidence)``. ``extra`` are (condition, reason SQL, label, weight)
    of code signals, counted before the text; they read ``columns``. Each distinct
    text is scored once."""
    hits = []
    for i, (condition, reason, label, weight) in enumerate(extra or []):
        hits.append(
            f"SELECT _tid, {i} AS ord, 'code' AS kind, '{label}' AS label, {weight}::double AS w, "
            f"{reason} AS reason FROM slugged_texts WHERE {condition}"
        )
    base = len(hits)
    for i, (phrase, label, weight) in enumerate(keywords):
        hits.append(
            f"SELECT _tid, {base + i} AS ord, 'text' AS kind, '{label}' AS label, {weight}::double AS w, '{phrase}' AS reason "
            f"FROM slugged_texts WHERE {phrase_sql('_slug', phrase)}"
        )
    base = len(hits)
    for i, (phrase, penalty) in enumerate(negatives):
        hits.append(
            f"SELECT _tid, {base + i}, 'minus', '', {penalty}::double, '-{phrase}' "
            f"FROM slugged_texts WHERE {phrase_sql('_slug', phrase)}"
        )
    union = "\n UNION ALL ".join(hits)
    same = "".join(f" AND s.{c} IS NOT DISTINCT FROM t.{c}" for c in columns)
    return f"""
    slugged AS MATERIALIZED (SELECT *, {slug_sql(text)} AS _slug FROM {source}),
    slugged_texts AS MATERIALIZED (SELECT *, row_number() OVER () AS _tid FROM (SELECT DISTINCT {", ".join(("_slug", *columns))} FROM slugged)),
    hits AS ({union}),
    points AS (
      SELECT _tid,
        coalesce(sum(w) FILTER (kind = 'code'), 0) AS code_points,
        list_sort(coalesce(list(w) FILTER (kind = 'text'), []), 'DESC') AS weights,
        coalesce(sum(w) FILTER (kind = 'minus'), 0) AS penalty,
        array_to_string(list_slice(list(reason ORDER BY ord), 1, {fv.EVIDENCE_MAX}), '; ') AS evidence
      FROM hits GROUP BY _tid),
    label_sums AS (
      SELECT _tid, label, sum(w) AS total, min(ord) AS first_ord
      FROM hits WHERE kind <> 'minus' GROUP BY _tid, label),
    labels_won AS (
      SELECT _tid, label FROM label_sums
      QUALIFY row_number() OVER (PARTITION BY _tid ORDER BY round(total, 9) DESC, first_ord) = 1),
    scored AS (
      SELECT s.{key},
        {round3_sql(f"""greatest(0.0, least(1.0, coalesce(code_points, 0)
          + {fv.WEIGHT_TEXT}::double * (coalesce(weights[1], 0) + {fv.WEIGHT_SECOND_HIT}::double * coalesce(weights[2], 0))
          - coalesce(penalty, 0)))""")} AS software_score,
        coalesce(label, '{fv.LABEL_UNKNOWN}') AS software_label,
        coalesce(evidence, '') AS software_evidence
      FROM slugged s JOIN slugged_texts t ON s._slug = t._slug{same} LEFT JOIN points p ON t._tid = p._tid LEFT JOIN labels_won l ON t._tid = l._tid)
    """
