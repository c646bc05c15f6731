"""Questions to the run log: history, freshness, completeness."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantweave import schema
from grantweave.operators.analytics import build_totals, one_row, source_totals
from grantweave.operators.incremental import new_ids


def report(
    manifest: DataFrame,
    extracted: DataFrame,
    projects: DataFrame,
    calls: DataFrame,
    old_projects: DataFrame,
    old_calls: DataFrame,
    started_at: str,
    finished_at: str,
    errors: list[str] | None = None,
    failed_sources: dict[str, str] | None = None,
    optional: Collection[str] = (),
) -> DataFrame:
    """One run as a report row: per source files, bytes and rows, then totals and
    ids the old registries did not have. ``failed_sources`` maps a source to its
    error; such a source shows even without a file. Any entry in ``errors`` marks the
    run as failed, and so does a failed source that isn't ``optional``."""
    errors, failed = errors or [], failed_sources or {}
    listed = source_totals(manifest, extracted)
    if failed:
        # Also the sources that stored no file before they failed.
        why = manifest.sparkSession.createDataFrame(list(failed.items()), "source STRING, error STRING")
        listed = listed.join(why, "source", "full").fillna(0, ["files", "bytes", "rows"])
    else:
        listed = listed.withColumn("error", F.lit(None).cast("string"))
    sources = listed.agg(
        F.array_sort(F.collect_list(F.struct("source", "files", "bytes", "rows", "error"))).alias("sources")
    )
    counts = [
        build_totals(projects, calls),
        new_ids(projects, old_projects, "record_id").agg(F.count(F.lit(1)).alias("projects_new")),
        new_ids(calls, old_calls, "call_id").agg(F.count(F.lit(1)).alias("calls_new")),
    ]
    row = one_row(sources, *counts)
    started, finished = F.lit(started_at), F.lit(finished_at)
    seconds = F.unix_timestamp(finished.cast("timestamp")) - F.unix_timestamp(started.cast("timestamp"))
    said = F.array(*[F.lit(e) for e in errors]).cast("array<string>")
    return schema.conform(
        row.withColumns(
            {
                "started_at": started, "finished_at": finished, "seconds": seconds.cast("double"),
                "ok": F.lit(not errors and failed.keys() <= set(optional)), "errors": said,
            }
        ),
        schema.RUN_REPORT,
    )


def history(runs: DataFrame, n: int = 20) -> DataFrame:
    """The last runs, newest first."""
    return runs.orderBy(F.desc("started_at")).limit(n)


def _last(runs: DataFrame, *fields: str) -> DataFrame:
    latest = F.max_by(F.struct("started_at", *fields), F.col("started_at"))
    return runs.agg(latest.alias("last")).select("last.*")


def freshness(runs: DataFrame) -> DataFrame:
    """Start and outcome of the last run: one row, nulls without any run."""
    outcome = F.when(F.col("ok"), F.lit("ok")).when(~F.col("ok"), F.lit("with errors"))
    return _last(runs, "ok").select(
        F.substring("started_at", 1, 16).alias("started_at"), outcome.alias("outcome")
    )


def completeness(runs: DataFrame, has_projects: bool = True, has_calls: bool = True, shown: int = 200) -> DataFrame:
    """The first thing that is missing, as one row; null when all is in place. Of
    errors the first ``shown`` characters."""
    reason = (
        F.when(~F.lit(has_projects), F.lit("registry missing"))
        .when(~F.lit(has_calls), F.lit("calls missing"))
        .when(F.col("started_at").isNull(), F.lit("no run log"))
        .when(
            ~F.coalesce("ok", F.lit(False)),
            F.concat(
                F.lit("last run had errors: "),
                F.substring(F.array_join(F.coalesce("errors", F.array().cast("array<string>")), "; "), 1, shown),
            ),
        )
        .when(F.coalesce("calls", F.lit(0)) == 0, F.lit("last run found no calls"))
    )
    return _last(runs, "ok", "errors", "calls").select(reason.alias("reason"))
