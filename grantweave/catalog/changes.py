"""Manifests, stale items, new ids and the run log over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantweave.catalog.base import query, table
from grantweave.operators import incremental, runs

# Two manifests of one file per document: the second lacks some, adds others,
# and holds new content for every seventh.


def _manifests(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), "doc_id", "source", "text", "n_chars"
    )
    old = docs.where("doc_id % 5 > 0").select("path", "source", F.sha2("text", 256).alias("sha256"), F.lit("2026-01-01").alias("fetched_at"))
    changed = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    new = docs.where("doc_id % 4 > 0").select("path", "source", F.sha2(changed, 256).alias("sha256"), F.lit("2026-02-01").alias("fetched_at"))
    return old, new


_MANIFESTS = """
  old AS (SELECT source || '/' || doc_id AS path, source, sha256(text) AS sha256, '2026-01-01' AS fetched_at FROM documents WHERE doc_id % 5 > 0),
  new AS (SELECT source || '/' || doc_id AS path, source, sha256(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS sha256,
    '2026-02-01' AS fetched_at FROM documents WHERE doc_id % 4 > 0)
"""


@query(
    "manifest_upsert",
    f"WITH {_MANIFESTS} SELECT * FROM new UNION ALL SELECT o.* FROM old o ANTI JOIN new n ON o.path = n.path",
)
def manifest_upsert(spark, sf):
    return incremental.manifest_upsert(*_manifests(spark, sf))


@query(
    "manifest_diff",
    f"""WITH {_MANIFESTS} SELECT coalesce(o.path, n.path) AS path, o.sha256 AS old_sha256, n.sha256 AS new_sha256,
      CASE WHEN o.path IS NULL THEN 'nou' WHEN n.path IS NULL THEN 'lipsă' WHEN o.sha256 = n.sha256 THEN 'neschimbat' ELSE 'actualizat' END AS change
    FROM old o FULL JOIN new n ON o.path = n.path""",
)
def manifest_diff(spark, sf):
    return incremental.manifest_diff(*_manifests(spark, sf))


@query("existing_only", f"WITH {_MANIFESTS} SELECT o.path, o.sha256 FROM old o SEMI JOIN new n ON o.path = n.path")
def existing_only(spark, sf):
    old, new = _manifests(spark, sf)
    return incremental.existing_only(old, new).select("path", "sha256")


@query(
    "parse_pending",
    f"""WITH {_MANIFESTS} SELECT n.path FROM new n WHERE n.sha256 NOT IN (
      SELECT sha256(text) FROM documents WHERE doc_id % 5 > 0 AND doc_id % 2 = 0)""",
)
def parse_pending(spark, sf):
    old, new = _manifests(spark, sf)
    version = F.when(F.substring_index("path", "/", -1).cast("bigint") % 2 == 0, 5).otherwise(4)
    parsed = old.select("sha256", version.alias("parser_version"))
    return incremental.parse_pending(new, parsed, 5).select("path")


@query(
    "stale_items",
    """SELECT o_orderkey, cast(o_orderdate::date AS varchar) AS modified FROM orders LEFT JOIN
      (SELECT l_orderkey, max(l_shipdate) AS stored_at FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1) ON o_orderkey = l_orderkey
    WHERE stored_at IS NULL OR o_orderdate > stored_at ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""",
)
def stale_items(spark, sf):
    stored = table(spark, sf, "lineitem").where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("stored_at")
    )
    items = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    stale = incremental.stale_items(items, stored, "o_orderkey", F.col("o_orderdate"), budget=500)
    return stale.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("modified"))


@query("new_ids", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def new_ids(spark, sf):
    return incremental.new_ids(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


# One run report per hour of events: errors are error events of high value.


def _runs(spark, sf):
    hour = F.date_format("ts", "yyyy-MM-dd'T'HH:00:00")
    bad = (F.col("event_type") == "error") & (F.col("value") > 200)
    events = table(spark, sf, "events").groupBy(hour.alias("started_at")).agg(
        (F.count_if(bad) == 0).alias("ok"),
        F.count(F.lit(1)).alias("projects"),
        F.count_if(F.col("event_type") == "view").alias("calls"),
        F.count_if(bad).alias("_bad"),
    )
    said = F.when(F.col("_bad") > 0, F.array(F.concat(F.col("_bad").cast("string"), F.lit(" erori"))))
    return events.withColumn("errors", F.coalesce(said, F.array().cast("array<string>"))).drop("_bad")


_RUNS = """
  runs AS (SELECT strftime(ts, '%Y-%m-%dT%H:00:00') AS started_at, count(*) FILTER (event_type = 'error' AND value > 200) = 0 AS ok,
    count(*) AS projects, count(*) FILTER (event_type = 'view') AS calls,
    count(*) FILTER (event_type = 'error' AND value > 200) AS bad FROM events GROUP BY 1)
"""


@query("run_history", f"WITH {_RUNS} SELECT started_at, ok, projects, calls FROM runs ORDER BY started_at DESC LIMIT 20")
def run_history(spark, sf):
    return runs.history(_runs(spark, sf)).select("started_at", "ok", "projects", "calls")


@query(
    "freshness",
    f"""WITH {_RUNS} SELECT substr(max(started_at), 1, 16) AS started_at,
      CASE WHEN arg_max(ok, started_at) THEN 'ok' ELSE 'with errors' END AS outcome FROM runs""",
)
def freshness(spark, sf):
    return runs.freshness(_runs(spark, sf))


@query(
    "completeness",
    f"""WITH {_RUNS} SELECT CASE WHEN NOT arg_max(ok, started_at) THEN 'last run had errors: ' || arg_max(bad, started_at) || ' erori'
      WHEN arg_max(calls, started_at) = 0 THEN 'last run found no calls' END AS reason FROM runs""",
)
def completeness(spark, sf):
    return runs.completeness(_runs(spark, sf))


@query(
    "run_report",
    """SELECT (SELECT string_agg(source || ':' || files || ':' || bytes || ':' || rows, ' ' ORDER BY source) FROM (
        SELECT source, files, bytes, coalesce(n, 0) AS rows FROM
          (SELECT source, count(*) AS files, cast(sum(n_chars) AS bigint) AS bytes FROM documents GROUP BY 1)
          LEFT JOIN (SELECT 'src' || (user_id % 15) AS source, count(*) AS n FROM events GROUP BY 1) USING (source))) AS sources,
      (SELECT count(*) FROM orders) AS projects, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS projects_new,
      (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS software, (SELECT count(*) FROM conversations) AS calls,
      (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id % 4 = 0) AS calls_new,
      (SELECT count(*) FROM conversations WHERE role = 'user') AS calls_active, true AS ok, 90.0::double AS seconds""",
)
def run_report(spark, sf):
    manifest = table(spark, sf, "documents").selectExpr("source", "n_chars AS bytes")
    rows = table(spark, sf, "events").selectExpr("concat('src', cast(user_id % 15 as string)) AS source")
    projects = table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) AS record_id", "o_orderstatus = 'P' AS is_software", "o_orderkey % 3 > 0 AS old")
    calls = table(spark, sf, "conversations").selectExpr("cast(conv_id as string) AS call_id", "IF(role = 'user', 'Activ', role) AS status", "conv_id % 4 > 0 AS old")
    report = runs.report(manifest, rows, projects, calls, projects.where("old"), calls.where("old"), "2026-01-01T00:00:00", "2026-01-01T00:01:30")
    shown = F.transform("sources", lambda s: F.concat_ws(":", s["source"], s["files"].cast("string"), s["bytes"].cast("string"), s["rows"].cast("string")))
    return report.select(
        F.array_join(shown, " ").alias("sources"), "projects", "projects_new", "software", "calls", "calls_new", "calls_active", "ok", "seconds"
    )
