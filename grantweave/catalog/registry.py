"""Places, status, shares, classification and the two builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave import schema
from grantweave.catalog.base import (
    company_sql, counties_sql, eu_sql, keyword_ctes, pick, query, regions_sql, round3_sql, status_sql, table,
)
from grantweave.functions import amounts, places
from grantweave.functions.keywords import KeywordDictionary, activity_bucket, is_digital_intervention, with_keyword_score
from grantweave.functions.vectors import contrastive_scores
from grantweave.operators import calls as calls_ops
from grantweave.operators import classify
from grantweave.plans import build
from grantweave.sources.files import project_items as project_items_of

# ------------------------------------------------------- places, status, shares

PLACE_TEXT = pick(
    "c_custkey", "'Bihor,BN, Cluj, MM, SM, SJ'", "'nivel național'", "'Maramureș'", "'Sud-Vest Oltenia'", "'nord vest'",
    "'bucuresti ilfov'", "concat(c_mktsegment, ' CSA Cluj-Napoca')", "'Bistrita Nasaud; Caraș Severin'", "'Regiunea CENTRU'",
    "'Municipiul București'", "'Dâmbovița/Prahova,TM'", "'Toate județele'", "''", "'Satu-Mare, Satu Mare'", "'Olt, Oltenia'",
    "'Sud - Est, sud-est'",
)


@query(
    "extract_places",
    f"""SELECT c_custkey, array_to_string(counties, '; ') AS counties, array_to_string({regions_sql('t', 'counties')}, '; ') AS regions
    FROM (SELECT c_custkey, t, {counties_sql('t')} AS counties FROM (SELECT c_custkey, {PLACE_TEXT} || ' ' || c_name AS t FROM customer))""",
)
def extract_places(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("c_custkey", f"{PLACE_TEXT} AS county", "c_name AS locality")
    found = places.with_places(rows)
    return found.select(
        "c_custkey", F.array_join("counties", "; ").alias("counties"), F.array_join("regions", "; ").alias("regions")
    )


STATUS_TEXT = pick(
    "o_orderkey", "'Finalizat'", "'FINALIZAT '", "'nefinalizat'", "'în curs de reziliere'", "'Reziliat'", "'22'",
    "'În implementare'", "'Proiect etapizabil'", "'nefuncțional'", "'Suspendat temporar'", "'indicatori 0'", "''",
    "'încetat'", "o_orderpriority", "'proces de reziliere'", "'Project status'",
)


@query("status_rules", f"SELECT o_orderkey, {status_sql(STATUS_TEXT)} AS status FROM orders")
def status_rules(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", f"{STATUS_TEXT} AS project_status")
    return places.with_status(rows).select("o_orderkey", "status")


_RATE = pick("l_linenumber", "l_discount * 973.219371", "l_discount * 8.127391", "84.73921", "8580.0", "0.0", "cast(NULL as double)")
_PUBLISHED = "CASE WHEN l_partkey % 4 = 0 THEN l_extendedprice - 10.0 WHEN l_partkey % 11 = 0 THEN l_extendedprice + 1.0 END"
_ELIGIBLE = "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_extendedprice END"


@query(
    "derived_share",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, round({eu_sql('e', 'p', 'r')[0]}, 2) AS eu_amount_derived,
      {eu_sql('e', 'p', 'r')[1]} AS eu_amount_source
    FROM (SELECT *, {_ELIGIBLE} AS e, {_PUBLISHED} AS p, cast({_RATE} AS double) AS r FROM lineitem)""",
)
def derived_share(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    rows = table(spark, sf, "lineitem").selectExpr(
        *keys, f"{_ELIGIBLE} AS total_eligible_amount", f"{_PUBLISHED} AS eu_amount", f"cast({_RATE} as double) AS cofinancing_rate"
    )
    derived = amounts.with_eu_amount(rows)
    return derived.select(*keys, F.round("eu_amount_derived", 2).alias("eu_amount_derived"), "eu_amount_source")


# ------------------------------------------------------------- classification

ENGLISH = KeywordDictionary(
    keywords=[
        ("license", "legal", 0.55), ("copyright notice", "legal", 0.75), ("the entire", "legal", 0.3),
        ("thering", "prose", 0.35), ("the", "prose", 0.45), ("reting", "prose", 0.4), ("and the", "prose", 0.25),
        ("email", "contact", 0.65), ("address", "contact", 0.35), ("with", "prose", 0.15), ("password", "secret", 0.85),
        ("key", "secret", 0.5), ("subscribe", "web", 0.6), ("cookies", "web", 0.6),
    ],
    negatives=[("that", 0.3), ("entire nation", 0.4), ("for", 0.25)],
)


@query(
    "keyword_score",
    f"WITH {keyword_ctes('documents', 'doc_id', 'text', ENGLISH.keywords, ENGLISH.negatives)} SELECT * FROM scored",
)
def keyword_score(spark, sf):
    docs = table(spark, sf, "documents").withColumn("none", F.lit(None).cast("string"))
    scored = with_keyword_score(docs, "text", "none", dictionary=ENGLISH)
    return scored.select("doc_id", "software_score", "software_label", "software_evidence")


_PHRASE = pick(
    "doc_id", "'Digitalizarea serviciilor publice digitale'", "'Aplicații software și soluții informatice'", "'Canalizare și reabilitare'",
    "'capitalizare, interpretare'", "'platformă ERP + CRM, cloud'", "'construcții; semnătură electronică'", "'Inteligența artificială; big data; IoT'",
    "''", "'API'",
)
_CAEN = pick("doc_id", "'6201'", "NULL", "'7211 x'", "'2620'", "NULL")
_INTERVENTION = pick("doc_id", "'16'", "'013 - x'", "NULL", "'999'", "''", "'1'", "'36'")
_CODE_KEY = "CASE WHEN length(trim(iv)) < 3 THEN lpad(trim(iv), 3, '0') ELSE substr(trim(iv), 1, 3) END"
_CODE_SIGNALS = [
    (f"substr(trim(caen), 1, 4) IN ({', '.join(repr(c) for c in fv.ACTIVITY_BUCKETS['software'])})", "'CAEN ' || caen", "produs", 0.45),
    (f"substr(trim(caen), 1, 4) IN ({', '.join(repr(c) for c in fv.ACTIVITY_BUCKETS['cdi'])})", "'CAEN ' || caen || ' (C-D)'", "cdi", 0.45 * 0.6),
    (f"iv <> '' AND {_CODE_KEY} IN ({', '.join(repr(c) for c in fv.DIGITAL_INTERVENTIONS)})", f"'intervenție ' || {_CODE_KEY}", "digitalizare", 0.35),
]
_PROJECT_TEXTS = f"(SELECT doc_id, {_PHRASE} AS t, text, {_CAEN} AS caen, {_INTERVENTION} AS iv FROM documents)"


@query(
    "classify_projects",
    f"""WITH {keyword_ctes(_PROJECT_TEXTS, 'doc_id', "t || ' ' || text", fv.KEYWORDS, fv.NEGATIVE_KEYWORDS, _CODE_SIGNALS, ('caen', 'iv'))}
    SELECT *, software_score >= 0.5 AS is_software FROM scored""",
)
def classify_projects(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id", f"{_PHRASE} AS project_title", "text AS project_summary", f"{_CAEN} AS caen", f"{_INTERVENTION} AS intervention_code"
    )
    done = classify.classify_projects(docs)
    return done.select("doc_id", "software_score", "software_label", "software_evidence", "is_software")


@query(
    "activity_codes",
    f"""SELECT doc_id, CASE WHEN {_CODE_SIGNALS[0][0]} THEN 'software' WHEN {_CODE_SIGNALS[1][0]} THEN 'cdi'
      WHEN substr(trim(caen), 1, 4) IN ('2611', '2620', '6110', '6120', '6190') THEN 'adiacent' END AS bucket,
      coalesce({_CODE_SIGNALS[2][0]}, false) AS digital FROM {_PROJECT_TEXTS}""",
)
def activity_codes(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", f"{_CAEN} AS caen", f"{_INTERVENTION} AS iv")
    return docs.select(
        "doc_id", activity_bucket(F.col("caen")).alias("bucket"), is_digital_intervention(F.col("iv")).alias("digital")
    )


_CALL_TITLE = f"concat({_PHRASE}, ' ', source)"


@query(
    "domain_boost",
    f"""WITH {keyword_ctes(f"(SELECT doc_id, {_CALL_TITLE} AS t, text FROM documents)", 'doc_id', "t || ' ' || text", fv.KEYWORDS, fv.NEGATIVE_KEYWORDS)},
    tagged AS (SELECT s.*, coalesce(quality = 1, false) AS tag FROM scored s LEFT JOIN labels USING (doc_id)),
    boosted AS (SELECT doc_id,
      CASE WHEN tag THEN {round3_sql('least(1.0, software_score + 0.35)')} ELSE software_score END AS software_score,
      CASE WHEN tag AND software_label = 'necunoscut' THEN 'digitalizare' ELSE software_label END AS software_label,
      CASE WHEN tag THEN concat_ws('; ', 'domeniu: Digitalizare', nullif(software_evidence, '')) ELSE software_evidence END AS software_evidence
      FROM tagged)
    SELECT *, software_score >= 0.5 AS is_software FROM boosted""",
)
def domain_boost(spark, sf):
    tags = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, F.array(F.lit("Sănătate"), F.lit("Digitalizare"))).alias("domains")
    )
    docs = table(spark, sf, "documents").selectExpr("doc_id", f"{_CALL_TITLE} AS title", "text AS specific_objective")
    done = classify.classify_calls(docs.join(tags, "doc_id", "left"))
    return done.select("doc_id", "software_score", "software_label", "software_evidence", "is_software")


def _centroids(spark, sf) -> DataFrame:
    """Mean vectors of the labels (label, vec, wanted): every third label is wanted, the rest are not."""
    embeddings = table(spark, sf, "embeddings")
    dims = embeddings.select("label", F.posexplode("embedding").alias("place", "x"))
    means = dims.groupBy("label", "place").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vectors = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("place", "m"))).alias("v"))
    return vectors.select("label", F.col("v.m").alias("vec"), (F.col("label") % 3 == 0).alias("wanted"))


_CONTRAST = """
  dims AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS place FROM embeddings),
  means AS (SELECT label, place, avg(x) AS m FROM dims GROUP BY ALL),
  protos AS (SELECT label, list(m ORDER BY place) AS v FROM means GROUP BY label),
  best AS (SELECT vec_id, max(list_cosine_similarity(embedding::double[], v)) FILTER (p.label % 3 = 0)
      - max(list_cosine_similarity(embedding::double[], v)) FILTER (p.label % 3 > 0) AS delta
    FROM embeddings e, protos p GROUP BY vec_id),
  meaning AS (SELECT vec_id, round(greatest(0.0, least(1.0, (delta - 0.03) / 0.27)), 3) AS score FROM best)
"""


@query("contrastive_score", f"WITH {_CONTRAST} SELECT * FROM meaning")
def contrastive(spark, sf):
    return contrastive_scores(table(spark, sf, "embeddings"), _centroids(spark, sf), "vec_id", "embedding")


@query(
    "meaning_blend",
    f"""WITH {_CONTRAST},
    {keyword_ctes(f"(SELECT doc_id, {_PHRASE} AS t, text FROM documents)", 'doc_id', "t || ' ' || text", fv.KEYWORDS, fv.NEGATIVE_KEYWORDS).strip()},
    joined AS (SELECT s.*, coalesce(score, 0) AS m FROM scored s LEFT JOIN meaning ON doc_id = vec_id)
    SELECT doc_id,
      CASE WHEN m > 0 THEN {round3_sql('least(1.0, software_score + 0.6 * m)')} ELSE software_score END AS software_score,
      CASE WHEN m > 0 AND software_label = 'necunoscut' THEN 'digitalizare' ELSE software_label END AS software_label,
      CASE WHEN m > 0 THEN concat_ws('; ', nullif(software_evidence, ''), 'înțeles ' || format('{{:.2f}}', m)) ELSE software_evidence END AS software_evidence
    FROM joined""",
)
def meaning_blend(spark, sf):
    meaning = contrastive(spark, sf).select(F.col("vec_id").alias("doc_id"), F.col("score").alias("meaning"))
    docs = table(spark, sf, "documents").selectExpr("doc_id", f"{_PHRASE} AS project_title", "text AS project_summary")
    done = classify.classify_projects(docs.join(meaning, "doc_id", "left"), meaning="meaning")
    return done.select("doc_id", "software_score", "software_label", "software_evidence")


# ---------------------------------------------------------------------- calls
# Items from orders, pages by slug, terms from nations and regions.

_IDS = {
    "beneficiar": "[o_custkey % 30, o_orderkey % 25, 99]",
    "domeniu": "CASE WHEN o_orderkey % 3 = 0 THEN [] ELSE [o_orderkey % 8] END",
    "tip_apel": "[o_orderkey % 4, 1]",
}
_ITEM_CTES = f"""
  terms AS (SELECT 'beneficiar' AS taxonomy, n_nationkey AS id, CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE 'IMM ' || n_name END AS name FROM nation
    UNION ALL SELECT 'domeniu', r_regionkey, 'Domeniul ' || r_name FROM region
    UNION ALL SELECT 'tip_apel', r_regionkey, 'Tip ' || r_name FROM region),
  items AS (SELECT o_orderkey AS id, {_IDS['beneficiar']} AS beneficiar, {_IDS['domeniu']} AS domeniu, {_IDS['tip_apel']} AS tip_apel FROM orders)
"""


def _names_sql(taxonomy: str) -> str:
    return f"""(SELECT array_to_string(list(name ORDER BY place), '; ') FROM
      (SELECT unnest(i.{taxonomy}) AS term, generate_subscripts(i.{taxonomy}, 1) AS place) JOIN terms t ON t.id = term
      WHERE t.taxonomy = '{taxonomy}' AND name <> '')"""


def _items(spark, sf) -> DataFrame:
    arrays = {n: e.replace("[]", "cast(array() as array<bigint>)").replace("[", "array(").replace("]", ")") for n, e in _IDS.items()}
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "concat('p', cast(o_orderkey as string)) AS slug", "o_orderpriority AS link",
        "named_struct('rendered', concat('<b>Apel</b> ', o_orderpriority, ' &amp; ', o_orderstatus)) AS title",
        "cast(cast(o_orderdate as date) as string) AS date", "cast(cast(o_orderdate as date) as string) AS modified",
        *[f"{e} AS {n}" for n, e in arrays.items()], "cast(NULL as array<bigint>) AS zona_geografica",
        "'apeluri' AS source", "'2026-01-01' AS fetched_at",
    )


def _terms(spark, sf) -> DataFrame:
    nations = table(spark, sf, "nation").selectExpr(
        "'beneficiar' AS taxonomy", "cast(n_nationkey as bigint) AS id", "IF(n_nationkey % 6 = 0, '', concat('IMM ', n_name)) AS name"
    )
    regions = table(spark, sf, "region")
    tagged = [
        regions.selectExpr(f"'{t}' AS taxonomy", "cast(r_regionkey as bigint) AS id", f"concat('{p} ', r_name) AS name")
        for t, p in (("domeniu", "Domeniul"), ("tip_apel", "Tip"))
    ]
    return nations.unionByName(tagged[0]).unionByName(tagged[1])


@query(
    "taxonomy_names",
    f"""WITH {_ITEM_CTES} SELECT id, coalesce({_names_sql('beneficiar')}, '') AS beneficiaries, coalesce({_names_sql('domeniu')}, '') AS domains,
      coalesce({_names_sql('tip_apel')}, '') AS call_types FROM items i""",
)
def taxonomy_names(spark, sf):
    taxonomies = {k: v for k, v in fv.TAXONOMIES.items() if k != "zona_geografica"}
    items = _items(spark, sf)
    names = calls_ops.taxonomy_names(items, _terms(spark, sf), "id", taxonomies)
    shown = [F.coalesce(F.array_join(c, "; "), F.lit("")).alias(c) for c in taxonomies.values()]
    return items.select("id").join(names, "id", "left").select("id", *shown)


_PAGE_LISTS = "html || '<p>Domenii Apel:</p><p>Digitalizare</p><p>Zone Geografice</p><p>Data închiderii:</p><p>15.06.2026</p><p>Buget UE:</p><p>' || page_id || '.000 EUR</p>'"


@query(
    "call_rows",
    f"""WITH {_ITEM_CTES},
    detail AS (SELECT 'p' || page_id AS slug, page_id * 1000.0 AS budget FROM pages)
    SELECT o_orderkey::varchar AS call_id, 'Apel ' || o_orderpriority || ' & ' || o_orderstatus AS title,
      'https://oportunitati-ue.gov.ro/apel/p' || o_orderkey || '/' AS url,
      CASE WHEN d.slug IS NOT NULL THEN 'Activ' ELSE 'Necunoscut' END AS status,
      CASE WHEN d.slug IS NOT NULL THEN '2026-06-15' END AS closes_at,
      cast(budget AS double) AS budget_amount, CASE WHEN d.slug IS NOT NULL THEN 'EUR' END AS budget_currency,
      coalesce(nullif({_names_sql('domeniu')}, ''), CASE WHEN d.slug IS NOT NULL THEN 'Digitalizare' END, '') AS domains,
      coalesce({_names_sql('tip_apel')}, '') AS call_types
    FROM orders o JOIN items i ON o.o_orderkey = i.id LEFT JOIN detail d ON d.slug = 'p' || o_orderkey""",
)
def call_rows(spark, sf):
    pages = table(spark, sf, "pages").selectExpr("concat('p', cast(page_id as string)) AS slug", f"{_PAGE_LISTS} AS html")
    details = calls_ops.page_details(pages)
    rows = calls_ops.call_rows(_items(spark, sf), _terms(spark, sf), details, F.lit("2026-06-01").cast("date"))
    return rows.select(
        "call_id", "title", "url", "status", F.col("closes_at").cast("string").alias("closes_at"), "budget_amount",
        "budget_currency", F.array_join("domains", "; ").alias("domains"), F.array_join("call_types", "; ").alias("call_types"),
    )


# Project items as their source publishes them: lists or scalars, written as JSON.
_ITEM_JSON = (
    "concat('{{\"item\":\"Q', {key}, '\",\"originalLabels\":[],\"labels\":[\"Titlu ', o_orderstatus, '\"],\"descriptions\":\"<p>a&nbsp;', o_orderpriority, "
    "'</p>\",\"startTimes\":[\"', {day}, 'T00:00\"],\"totalBudgets\":[\"', {key}, ',5\"],\"euBudgets\":', {cust}, "
    "',\"coordinates\":\"45.5,', {place}, '\",\"countrycode\":', CASE WHEN o_custkey % 2 = 0 THEN '[]' ELSE '\"FR\"' END, '}}')"
).format(key="cast(o_orderkey as string)", day="cast(cast(o_orderdate as date) as string)", cust="cast(o_custkey as string)", place="cast(o_custkey % 90 as string)")


@query(
    "project_items",
    """SELECT 'Q' || o_orderkey AS project_code, 'Titlu ' || o_orderstatus AS project_title, 'a ' || o_orderpriority AS project_summary,
      cast(cast(o_orderdate AS date) AS varchar) AS start_date, o_orderkey + 0.5::double AS total_eligible_amount, o_custkey::double AS eu_amount,
      CASE WHEN o_custkey % 2 = 0 THEN 'RO' ELSE 'FR' END AS country, 45.5::double AS latitude, (o_custkey % 90)::double AS longitude,
      o_orderkey % 50 AS source_row, o_orderpriority AS source_dataset FROM orders""",
)
def project_items(spark, sf):
    items = table(spark, sf, "orders").selectExpr(
        f"try_parse_json({_ITEM_JSON}) AS value", "o_orderkey % 50 AS pos", "'api' AS source", "o_orderpriority AS dataset", "'u' AS url",
        "'p' AS path", "'h' AS sha256", "'2026-01-01' AS fetched_at",
    )
    return project_items_of(items).select(
        "project_code", "project_title", "project_summary", F.col("start_date").cast("string").alias("start_date"), "total_eligible_amount", "eu_amount",
        "country", "latitude", "longitude", "source_row", "source_dataset",
    )


# ----------------------------------------------------------------- the builds
# Every line item is one published row of a project: lists repeat a project
# (order, supplier) under several spellings of its beneficiary.

_INTERIM = {
    "source": "CASE WHEN l_returnflag = 'A' THEN 'arhiva' ELSE 'portal' END",
    "source_dataset": "l_returnflag",
    "source_url": "CASE WHEN l_partkey % 50 = 0 THEN 'manual:lista.xlsx' ELSE 'http://x.example/lista.xlsx' END",
    "source_file": "concat('liste/', l_linestatus, '/', cast(l_partkey % 40 as string), '/', cast(l_orderkey as string), '.xlsx')",
    "source_row": "l_linenumber * 100000000000000000 + l_partkey * 100000000 + cast(round(l_extendedprice * 100) as bigint)",
    "source_sha256": "cast(l_partkey % 40 as string)",
    "fetched_at": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE cast(cast(l_shipdate as date) as string) END",
    "program": pick("l_orderkey", "'POCU'", "'POR'", "NULL", "'POC'"),
    "project_code": "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE cast(100000 + l_orderkey as string) END",
    "project_title": pick(
        "l_orderkey", "'Digitalizarea serviciilor'", "'Aplicații software și soluții informatice'", "'Canalizare și reabilitare'",
        "'Platformă ERP, cloud'", "'Drum județean'", "NULL",
    ),
    "project_summary": pick("l_partkey", "'inteligență artificială'", "NULL", "'big data și algoritmi'", "'lucrări'"),
    "beneficiary_name": pick(
        "l_partkey", "concat('S.C. Firma ', cast(l_suppkey % 20 as string), ' SRL')", "concat('FIRMA ', cast(l_suppkey % 20 as string), ' S.A.')",
        "concat('Firma ', cast(l_suppkey % 20 as string))",
    ),
    "beneficiary_cui": "CASE WHEN l_partkey % 3 = 0 THEN cast(1000 + l_suppkey as string) END",
    "total_eligible_amount": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END",
    "eu_amount": "CASE WHEN l_partkey % 5 = 0 THEN l_extendedprice - 10.0 END",
    "payments_amount": "CASE WHEN l_partkey % 2 = 0 THEN l_tax * 1000.0 END",
    "cofinancing_rate": pick("l_linenumber", "84.73921", "l_discount * 8.127391", "NULL"),
    "intervention_code": pick("l_partkey", "NULL", "'16'", "'999'"),
    "county": pick("l_suppkey", "'Cluj, BN'", "'Județul Iași'", "NULL", "'nivel național'", "'București'", "''"),
    "region": pick("l_suppkey", "NULL", "'Nord-Est'", "'Sud-Vest Oltenia'", "'Centru'"),
    "project_status": pick("l_linenumber", "'Finalizat'", "'în implementare'", "'Reziliat'", "NULL"),
}
_INTERIM_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _INTERIM.items()) + " FROM lineitem"


def interim_projects(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in _INTERIM.items()])
    return schema.conform(rows)


def registry(spark, sf, *columns: str) -> DataFrame:
    """The build, with all columns or the given ones."""
    return build.build_projects(interim_projects(spark, sf).select(*_INTERIM), columns=columns or None)


_SEQ = "source, coalesce(starts_with(source_url, 'manual:'), false), source_file, source_row, record_id"
_FILLED = ", ".join(f"first({c} ORDER BY {_SEQ}) FILTER ({c} IS NOT NULL) AS f_{c}" for c in fv.MERGED_FIELDS if c in _INTERIM)
_KEPT_COLUMNS = ", ".join(
    f"coalesce(k.{c}, f_{c}) AS {c}" if c in fv.MERGED_FIELDS else f"k.{c}" for c in _INTERIM
)
_PLACE = "concat_ws(' ', nullif(county, ''), nullif(region, ''))"
_SIGNAL = [
    (
        f"intervention_code <> '' AND {_CODE_KEY.replace('iv', 'intervention_code')} IN ({', '.join(repr(c) for c in fv.DIGITAL_INTERVENTIONS)})",
        f"'intervenție ' || {_CODE_KEY.replace('iv', 'intervention_code')}", "digitalizare", 0.35,
    )
]
REGISTRY_CTES = f"""
  interim AS ({_INTERIM_SQL}),
  identified AS (SELECT *, substr(sha1(source || '|' || source_file || '|' || source_row), 1, 16) AS record_id,
    {company_sql('beneficiary_name')} AS beneficiary_key FROM interim),
  coded AS (SELECT *, coalesce(project_code, project_title, record_id) AS code FROM identified),
  fills AS (SELECT program, code, beneficiary_key, {_FILLED} FROM coded GROUP BY ALL),
  winners AS (SELECT * FROM coded
    QUALIFY row_number() OVER (PARTITION BY program, code, beneficiary_key ORDER BY fetched_at DESC NULLS FIRST, {_SEQ}) = 1),
  merged AS (SELECT {_KEPT_COLUMNS}, k.record_id, k.beneficiary_key FROM winners k JOIN fills f
    ON k.program IS NOT DISTINCT FROM f.program AND k.code = f.code AND k.beneficiary_key = f.beneficiary_key),
  {keyword_ctes('merged', 'record_id', "coalesce(project_title, '') || ' ' || coalesce(project_summary, '')", fv.KEYWORDS, fv.NEGATIVE_KEYWORDS, _SIGNAL, ('intervention_code',)).strip()},
  places AS MATERIALIZED (SELECT *, {regions_sql('_place', 'counties')} AS regions FROM (
    SELECT *, {counties_sql('_place')} AS counties FROM (SELECT DISTINCT {_PLACE} AS _place FROM merged))),
  registry AS (SELECT p.*, l.counties, l.regions, {status_sql('project_status')} AS status,
      {eu_sql('total_eligible_amount', 'eu_amount', 'cofinancing_rate')[0]} AS eu_amount_derived,
      {eu_sql('total_eligible_amount', 'eu_amount', 'cofinancing_rate')[1]} AS eu_amount_source,
      software_score, software_label, software_evidence, software_score >= 0.5 AS is_software
    FROM merged p JOIN places l ON l._place = {_PLACE} JOIN scored s USING (record_id))
"""


@query(
    "build_projects",
    f"""WITH {REGISTRY_CTES} SELECT record_id, program, project_code, beneficiary_name, beneficiary_key, beneficiary_cui, project_title,
      project_summary, county, region, intervention_code, total_eligible_amount, round(eu_amount, 2) AS eu_amount, payments_amount,
      round(eu_amount_derived, 2) AS eu_amount_derived, eu_amount_source, status, array_to_string(counties, '; ') AS counties,
      array_to_string(regions, '; ') AS regions, software_score, software_label, software_evidence, is_software, source, source_file,
      fetched_at FROM registry""",
)
def build_projects(spark, sf):
    built = registry(
        spark, sf, "record_id", "program", "project_code", "beneficiary_name", "beneficiary_key", "beneficiary_cui", "project_title",
        "project_summary", "county", "region", "intervention_code", "total_eligible_amount", "eu_amount", "payments_amount",
        "eu_amount_derived", "eu_amount_source", "status", "counties", "regions", "software_score", "software_label",
        "software_evidence", "is_software", "source", "source_file", "fetched_at",
    )
    shown = {
        **{c: F.round(c, 2) for c in ("eu_amount", "eu_amount_derived")}, **{c: F.array_join(c, "; ") for c in ("counties", "regions")},
    }
    return built.select(*[shown.get(c, F.col(c)).alias(c) for c in built.columns])


# Calls: one row per order and publication; the second copy of a call drops out.
_CALL = {
    "call_id": "cast(o_orderkey - o_orderkey % 2 as string)",
    "title": f"concat({_PHRASE.replace('doc_id', 'o_orderkey')}, ' ', o_orderpriority)",
    "url": "cast(o_orderkey as string)",
    "specific_objective": pick("o_custkey", "NULL", "'tehnologii avansate'", "'transformare digitală'"),
    "status": pick("o_custkey", "'Activ'", "'Închis'", "'Urmează'", "'Necunoscut'"),
    "closes_at": "CASE WHEN o_custkey % 5 > 0 THEN cast(o_orderdate as date) END",
    "budget_amount": "CASE WHEN o_custkey % 7 > 0 THEN o_totalprice END",
    "budget_currency": "CASE WHEN o_custkey % 3 = 0 THEN 'RON' ELSE 'EUR' END",
    "source": "o_orderstatus",
    "fetched_at": "'2026-01-01'",
}
_CALL_DOMAINS = pick("o_custkey", "['Digitalizare', 'Sănătate']", "['Mediu']", "['Transport', '']", "NULL")
_CALL_BENEFICIARIES = pick("o_custkey", "['IMM', 'ONG']", "['UAT']", "['IMM']")


def interim_calls(spark, sf) -> DataFrame:
    def array(e):
        return e.replace("[", "array(").replace("]", ")")

    rows = table(spark, sf, "orders").selectExpr(
        *[f"{e} AS {n}" for n, e in _CALL.items()],
        f"{array(_CALL_DOMAINS)} AS domains", f"{array(_CALL_BENEFICIARIES)} AS beneficiaries",
    )
    return schema.conform(rows, schema.CALLS)


def calls(spark, sf) -> DataFrame:
    return build.build_calls(interim_calls(spark, sf))


CALLS_CTES = f"""
  raw_calls AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _CALL.items())}, {_CALL_DOMAINS} AS domains,
    {_CALL_BENEFICIARIES} AS beneficiaries FROM orders),
  first_calls AS (SELECT *, source || call_id AS key FROM raw_calls
    QUALIFY row_number() OVER (PARTITION BY source, call_id ORDER BY fetched_at, url, title) = 1),
  {keyword_ctes('first_calls', 'key', "title || ' ' || coalesce(specific_objective, '')", fv.KEYWORDS, fv.NEGATIVE_KEYWORDS).strip()},
  tagged AS (SELECT c.*, s.software_score AS s0, s.software_label AS l0, s.software_evidence AS e0,
    coalesce(list_contains(domains, 'Digitalizare'), false) AS tag FROM first_calls c JOIN scored s USING (key)),
  boosted AS (SELECT *,
    CASE WHEN tag THEN {round3_sql('least(1.0, s0 + 0.35)')} ELSE s0 END AS software_score,
    CASE WHEN tag AND l0 = 'necunoscut' THEN 'digitalizare' ELSE l0 END AS software_label,
    CASE WHEN tag THEN concat_ws('; ', 'domeniu: Digitalizare', nullif(e0, '')) ELSE e0 END AS software_evidence FROM tagged),
  calls_registry AS (SELECT *, software_score >= 0.5 AS is_software FROM boosted)
"""


@query(
    "build_calls",
    f"""WITH {CALLS_CTES} SELECT source, call_id, url, title, status, cast(closes_at AS varchar) AS closes_at, budget_amount, budget_currency,
      coalesce(array_to_string(domains, '; '), '-') AS domains, software_score, software_label, software_evidence, is_software FROM calls_registry""",
)
def build_calls(spark, sf):
    return calls(spark, sf).select(
        "source", "call_id", "url", "title", "status", F.col("closes_at").cast("string").alias("closes_at"), "budget_amount",
        "budget_currency", F.coalesce(F.array_join("domains", "; "), F.lit("-")).alias("domains"), "software_score",
        "software_label", "software_evidence", "is_software",
    )
