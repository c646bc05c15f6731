"""Questions asked of the published registry: the build is written once, and filters and columns reach its scan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantweave import schema
from grantweave.catalog.base import query, table
from grantweave.catalog.registry import _INTERIM, REGISTRY_CTES, registry
from grantweave.catalog.reports import _ROLLUP, _buckets, _cents
from grantweave.catalog.tables import _LATEST, _PROPS, _VALUE
from grantweave.operators import analytics as a
from grantweave.operators import facet_counts as fc
from grantweave.operators import merge_state as ms
from grantweave.operators import text_index
from grantweave.sources import sinks
from grantweave.sources.staging import FREED, dealt, settings, shared_folder, written

R = f"WITH {REGISTRY_CTES}"
_published: dict[tuple[str, str], DataFrame] = {}


def published(spark, sf) -> DataFrame:
    """The registry of these tables as a written table, once for a session."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _published:
        with settings(spark, FREED):
            _published[at] = written(registry(spark, sf))
    return _published[at]


#: Rows from which a written registry is dealt into buckets by its key; files of fewer would be tiny.
DEALT_ROWS = 4_000_000
_dealt: dict[tuple[str, str], DataFrame] = {}


def published_by_key(spark, sf) -> tuple[DataFrame, int]:
    """The written registry, and the buckets of a table of it by its key. A large one is dealt into these buckets,
    once for a session, so that no such table needs a shuffle of all its columns."""
    at = (spark.sparkContext.applicationId, sf)
    rows = published(spark, sf)
    known = rows.count()
    buckets = sinks.buckets_for(known)
    if known < DEALT_ROWS:
        return rows, buckets
    if at not in _dealt:
        _dealt[at] = dealt(rows, "record_id", buckets)
    return _dealt[at], buckets


_FILTER = a.ProjectFilter(program="POCU", county="Cluj", min_amount="1.000")
_REST = "coalesce(total_eligible_amount, 0) >= 1000"
_TEST = {"program": "program = 'POCU'", "county": "list_contains(counties, 'Cluj')"}


def _entries(facet: str, option: str, source: str = "registry") -> str:
    holds = " AND ".join(f"coalesce({t}, false)" for f, t in _TEST.items() if f != facet)
    return f"SELECT '{facet}' AS facet, {option} AS option, total_eligible_amount AS e, payments_amount AS p, is_software AS s FROM {source} WHERE {_REST} AND {holds}"


_FACETS = " UNION ALL ".join([
    _entries("all", "NULL"), _entries("beneficiary", "beneficiary_key"), _entries("program", "program"), _entries("label", "software_label"),
    _entries("status", "status"), _entries("county", "c", "registry, (SELECT unnest(counties)) u(c)"),
    _entries("region", "c", "registry, (SELECT unnest(regions)) u(c)"),
])


@query(
    "facets_at_once",
    f"""{R} SELECT facet, option, count(*) AS n, round(sum(e), 1) AS eligible, round(sum(p), 1) AS payments, count(*) FILTER (s) AS software
      FROM ({_FACETS}) GROUP BY facet, option""",
)
def facets_at_once(spark, sf):
    return fc.facet_counts(published(spark, sf), _FILTER).select("facet", "option", "n", _cents("eligible"), _cents("payments"), "software")


@query("published_buckets", f"{R}, hit AS (SELECT * FROM registry WHERE {_REST} AND list_contains(counties, 'Cluj')) {_buckets('program', 'total_eligible_amount', 'hit', 12)}")
def published_buckets(spark, sf):
    return fc.buckets(fc.facet_counts(published(spark, sf), _FILTER), "program")


@query(
    "published_kpis",
    f"""{R} SELECT count(*) AS rows, round(coalesce(sum(total_eligible_amount), 0), 1) AS eligible,
      round(coalesce(sum(payments_amount), 0), 1) AS payments, count(DISTINCT beneficiary_key) AS beneficiaries,
      round(coalesce(avg(cast(is_software AS int)), 0), 6) AS software_share FROM registry WHERE program = 'POCU'""",
)
def published_kpis(spark, sf):
    found = a.project_kpis(a.ProjectFilter(program="POCU").apply(published(spark, sf)))
    return found.select("rows", _cents("eligible"), _cents("payments"), "beneficiaries", F.round("software_share", 6).alias("software_share"))


@query("published_rollup", f"{R} {_ROLLUP}")
def published_rollup(spark, sf):
    rolled = a.beneficiary_rollup(published(spark, sf))
    return rolled.select(*[_cents(c) if t == "double" else F.col(c) for c, t in rolled.dtypes])


@query("published_labels", f"{R} SELECT software_label, count(*) AS n FROM registry GROUP BY 1 ORDER BY n DESC, 1 LIMIT 8")
def published_labels(spark, sf):
    return a.label_counts(published(spark, sf), top=8)


@query("published_pages", f"{R} SELECT cast(greatest(1, ceil(count(*) / 25.0)) AS bigint) AS pages FROM registry WHERE is_software")
def published_pages(spark, sf):
    return a.page_count(published(spark, sf).where("is_software"))


def _third_page(df: DataFrame, sort: str, tie: str) -> DataFrame:
    """The third page, each found from the last row of the one before."""
    last = None
    for _ in range(2):
        rows = a.page_after(df, last, sort, tie=tie).select(sort, tie).collect()
        last = tuple(rows[-1]) if rows else last
    return a.page_after(df, last, sort, tie=tie).select(tie, sort)


@query("keyset_parts", "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC NULLS LAST, p_partkey LIMIT 25 OFFSET 50")
def keyset_parts(spark, sf):
    return _third_page(table(spark, sf, "part"), "p_size", "p_partkey")


def _keyset(sort: str):
    @query(f"keyset_{sort}", f"{R} SELECT record_id, {sort} FROM registry ORDER BY {sort} DESC NULLS LAST, record_id LIMIT 25 OFFSET 50")
    def page(spark, sf):
        return _third_page(published(spark, sf), sort, "record_id")


for _sort in ("total_eligible_amount", "payments_amount", "software_score"):
    _keyset(_sort)


@query("keyset_start_date", f"{R} SELECT record_id, cast(NULL AS varchar) AS start_date FROM registry ORDER BY record_id LIMIT 25 OFFSET 50")
def keyset_start_date(spark, sf):
    return _third_page(published(spark, sf), "start_date", "record_id").select("record_id", F.col("start_date").cast("string").alias("start_date"))


@query("published_lookup", f"{R} SELECT record_id, project_code, beneficiary_name FROM registry WHERE record_id = (SELECT max(record_id) FROM registry)")
def published_lookup(spark, sf):
    """By key in a bucketed table of the catalog."""
    name = f"lookup_{uuid.uuid4().hex}"
    rows, buckets = published_by_key(spark, sf)
    sinks.write_keyed(rows, name, "record_id", buckets, shared_folder(spark))
    projects = spark.table(name)
    found = a.point_lookup(projects, projects.agg(F.max("record_id")).first()[0])
    return found.select("record_id", "project_code", "beneficiary_name")


@query(
    "lasting_catalog",
    f"""{R} SELECT program, count(*) AS projects, count(DISTINCT beneficiary_key) AS repeat_beneficiaries FROM registry
      WHERE is_software AND beneficiary_key IN (SELECT beneficiary_key FROM registry GROUP BY 1 HAVING count(*) > 1) GROUP BY program""",
)
def lasting_catalog(spark, sf):
    """The same question of tables and views that other sessions see."""
    calls = spark.createDataFrame([], schema.CALLS)
    database = f"registry_{uuid.uuid4().hex}"
    rows, buckets = published_by_key(spark, sf)
    names = sinks.publish_catalog(spark, rows, calls, database, buckets, location=shared_folder(spark))
    return spark.newSession().sql(
        f"""SELECT program, count(*) AS projects, count(DISTINCT s.beneficiary_key) AS repeat_beneficiaries
        FROM {names['software']} s LEFT SEMI JOIN {names['beneficiaries']} b ON s.beneficiary_key = b.beneficiary_key AND b.proiecte > 1
        GROUP BY program"""
    )


def _exported(kind: str, name: str) -> str:
    known = {*_INTERIM, "record_id", "beneficiary_key", "counties", "regions", "status", "eu_amount_derived", "eu_amount_source",
             "software_score", "software_label", "software_evidence", "is_software"}
    if name not in known:
        return f"cast(NULL AS {'double' if kind == 'double' else 'varchar'}) AS {name}"
    if kind.startswith("array"):
        return f"cast(to_json({name}) AS varchar) AS {name}"
    return f"round({name}, 2) AS {name}" if kind == "double" else name


_EXPORT = [(f.name, f.dataType.simpleString()) for f in schema.BUILT_PROJECTS.fields]


@query("flat_export_all", f"{R} SELECT {', '.join(_exported(t, n) for n, t in _EXPORT)} FROM registry")
def flat_export_all(spark, sf):
    """All projects with all columns, as the export writes them."""
    shown = {"double": lambda c: F.round(c, 2), "date": lambda c: F.col(c).cast("string")}
    return sinks.flat(published(spark, sf)).select(*[shown.get(t, F.col)(n).alias(n) for n, t in _EXPORT])


_PATTERNS = ["customer#0+1", "mach", "customer#[0-9]+7$", "000012|build", "fur.iture", "7"]


@query(
    "indexed_search",
    " UNION ALL ".join(
        f"SELECT c_custkey, '{p}' AS pattern FROM customer WHERE regexp_matches(c_name, '(?i){p}') OR contains(c_mktsegment, '{p.upper()}')" for p in _PATTERNS
    ),
)
def indexed_search(spark, sf):
    customers, folder = table(spark, sf, "customer"), shared_folder(spark)
    text_index.write_index(customers, "c_custkey", ["c_name", "c_mktsegment"], folder)
    found = None
    for p in _PATTERNS:
        named = a.text_matches(F.col("c_name"), p) | F.col("c_mktsegment").contains(p.upper())
        keys = text_index.candidates(folder, spark, p)
        rows = customers if keys is None else customers.join(keys, F.col("c_custkey") == F.col("key"), "left_semi")
        rows = rows.where(named).select("c_custkey", F.lit(p).alias("pattern"))
        found = rows if found is None else found.union(rows)
    return found


@query(
    "merge_daily",
    f"""WITH e AS (SELECT event_id, user_id, event_type, {_LATEST} AS seen, {_VALUE} AS value, {_PROPS} AS props FROM events),
    fills AS (SELECT user_id, event_type, first(value ORDER BY event_id) FILTER (value IS NOT NULL) AS fv,
      first(props ORDER BY event_id) FILTER (props IS NOT NULL) AS fp FROM e GROUP BY ALL)
    SELECT event_id, user_id, event_type, seen, coalesce(value, fv) AS value, coalesce(props, fp) AS props
    FROM e JOIN fills USING (user_id, event_type)
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY seen DESC NULLS FIRST, event_id) = 1""",
)
def merge_daily(spark, sf):
    """Four snapshots absorbed one after another."""
    events = table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "event_type", f"{_LATEST} AS seen", f"{_VALUE} AS value", f"{_PROPS} AS props"
    )
    store, shape = ms.MergeStore(spark, shared_folder(spark), buckets=8), None
    for day in (2, 0, 3, 1):
        snapshot = events.where(F.pmod(F.col("event_id"), F.lit(4)) == day)
        state = ms.merge_state(snapshot, ["user_id", "event_type"], ["event_id"], "seen", ["value", "props"])
        store.absorb(state)
        shape = state.schema
    return ms.merged_rows(store.state(shape))
