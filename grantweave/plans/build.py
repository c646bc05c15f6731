"""The two builds, from interim rows to published registries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave import schema
from grantweave.functions.amounts import with_eu_amount
from grantweave.functions.keywords import PARTS
from grantweave.functions.places import with_places, with_status
from grantweave.functions.text import record_id
from grantweave.operators import clean, headers
from grantweave.operators.classify import classify_calls, classify_projects
from grantweave.operators.dedup import SEQUENCE, deduplicate, keep_top
from grantweave.operators.selection import archive_program, program_in
from grantweave.sources import sinks
from grantweave.sources.staging import written


def _has(field: str) -> Column:
    """Does the file map this field? The list holds nulls for unknown columns."""
    return F.array_position("fields", F.lit(field)) > 0


@dataclass(frozen=True)
class Extract:
    """A grid read once: its parsed rows as written, and what is known of each file.

    rows: below the headers, parsed, with ``_kept``. counts: by file and chunk. files: ``n_lines``,
    ``n_rows``, ``n_kept``, ``n_coded``, ``blocks_skipped`` and why a file is left out.
    """

    rows: DataFrame
    counts: DataFrame
    files: DataFrame
    by: list[str]


def stage_tables(
    grid: DataFrame, archive: bool = False, mode: str = "literal", aliases: headers.Aliases | None = None
) -> Extract:
    """Reads a grid of published tables once and writes its parsed rows.

    A grid may have two more columns. ``variant`` tells several readings of a file apart: the one with
    most usable rows counts, the first of them on a tie. ``block_no`` numbers the tables of a file:
    those that are not as wide as the header's are skipped and counted.
    """
    by = ["file_path", *[c for c in ("variant",) if c in grid.columns]]
    marked = written(headers.with_marks(grid, aliases))
    found = written(headers.headers_of(marked, by))
    lines = marked.groupBy(*by).agg(F.count(F.lit(1)).alias("n_lines"))
    body, skipped = marked, None
    if "block_no" in grid.columns:
        at = found.select(*by, F.col("header_row").alias("row_no"))
        body, skipped = clean.check_widths(marked, marked.join(at, [*by, "row_no"]).select(*by, "block_no"), by)
    needed = _has("beneficiary_name") & (_has("project_code") if archive else F.lit(True))
    parsed = clean.parse_fields(headers.table_rows(body, found.where(needed), by, aliases))
    parsed = parsed.withColumn("_kept", clean.is_beneficiary(F.col("beneficiary_name"), mode))
    coded = clean.has_code(F.col("project_code"))
    rows = written(headers.with_chunks(parsed.withColumn("_coded", F.col("_kept") & coded)))
    counts = headers.chunk_counts(rows, by, F.count_if("_kept").alias("n_kept"), F.count_if("_coded").alias("n_coded"))

    numbers = ["n_rows", "n_kept", "n_coded"]
    totals = clean.judge_counts(counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in numbers]))
    files = lines.join(found.select(*by, "fields"), by, "left").join(totals, by, "left")
    if skipped is not None:
        files = files.join(skipped.select(*by, "blocks_skipped"), by, "left")
    reason = (
        F.when(F.col("fields").isNull(), F.lit("no header row"))
        .when(~_has("beneficiary_name"), F.lit("no beneficiary column"))
        .when(~_has("project_code") if archive else F.lit(False), F.lit("no code column"))
        .when(F.coalesce("n_kept", F.lit(0)) == 0, F.lit("no usable rows"))
    )
    if archive:
        reason = F.coalesce(reason, F.col("reason"))
    more = ["blocks_skipped"] if skipped is not None else []
    files = files.select(*by, "n_lines", *[F.coalesce(c, F.lit(0)).alias(c) for c in [*numbers, *more]], reason.alias("reason"))
    if len(by) > 1:
        files = keep_top(files, ["file_path"], [F.desc("n_kept"), F.asc("variant")])
    return Extract(rows, counts, written(files), by)


def extract_tables(
    grid: DataFrame | Extract,
    manifest: DataFrame,
    archive: bool = False,
    mode: str = "literal",
    aliases: headers.Aliases | None = None,
) -> DataFrame:
    """Published tables as interim project rows with full provenance.

    ``grid`` holds raw rows (``file_path`` as in the manifest's ``path``; see ``stage_tables`` for
    several readings and blocks). Archived lists also pass the file gates, and are dated by their snapshot.
    """
    staged = grid if isinstance(grid, Extract) else stage_tables(grid, archive, mode, aliases)
    # One row per file. Without a hint, Spark broadcasts it only below
    # its size limit and splits skewed files otherwise.
    passing = staged.files.where("reason IS NULL").select(*staged.by)
    rows = staged.rows.join(passing, staged.by, "left_semi")
    kept = headers.place_rows(rows, staged.counts, staged.by).where("_kept")
    sourced = kept.join(manifest.withColumnRenamed("path", "file_path"), "file_path")
    meta = F.col("meta")
    named = (
        archive_program(F.col("dataset"), F.try_element_at(meta, F.lit("original_url")), F.col("file_path"))
        if archive
        else program_in(
            F.coalesce(
                F.nullif(F.try_element_at(meta, F.lit("resource_name")), F.lit("")), F.col("file_path")
            )
        )
    )
    # The file's own program column wins even where a cell is blank.
    own = _has("program")
    when = (
        F.coalesce(F.try_element_at(meta, F.lit("snapshot")), F.col("fetched_at"))
        if archive
        else F.col("fetched_at")
    )
    return schema.conform(
        sourced.withColumns(
            {
                "program": F.when(own, F.col("program")).otherwise(named),
                "source_dataset": F.col("dataset"),
                "source_url": F.col("url"),
                "source_file": F.col("file_path"),
                "source_sha256": F.col("sha256"),
                "fetched_at": when,
                "country": F.lit("RO"),
                "currency": F.lit("RON"),
                "programming_period": F.lit("2014-2020"),
            }
        )
    )


def extract_report(
    grid: DataFrame | Extract, archive: bool = False, mode: str = "literal", aliases: headers.Aliases | None = None,
    manifest: DataFrame | None = None, states: DataFrame | None = None,
) -> DataFrame:
    """Per file: rows read and kept, and why it was left out (null when it was
    not). No file stops the others; this is where it shows. With the reader's
    ``states`` files that weren't read to their end show, with the manifest those
    of which no line could be read."""
    staged = grid if isinstance(grid, Extract) else stage_tables(grid, archive, mode, aliases)
    report, reason = staged.files, F.col("reason")
    numbers = [c for c in report.columns if c not in ("file_path", "reason")]
    if states is not None:
        broken = states.where("reason IS NOT NULL").select("file_path", F.col("reason").alias("_broken"))
        report, reason = report.join(broken, "file_path", "full"), F.coalesce("_broken", reason)
    if manifest is not None:
        listed = manifest.select(F.col("path").alias("file_path")).distinct()
        report = report.join(listed, "file_path", "full")
    unread = F.when(F.coalesce("n_lines", F.lit(0)) == 0, F.lit("unreadable"))
    if states is not None:
        unread = F.when(F.col("_broken").isNull(), unread)
    filled = [F.coalesce(c, F.lit(0)).alias(c) if c != "variant" else F.col(c) for c in numbers]
    return report.select("file_path", *filled, F.coalesce(unread, reason).alias("reason"))


#: Steps after the merge: what each adds, and what it reads.
_STEPS = (
    (("counties", "regions"), ("county", "region", "locality"), with_places),
    (("status",), ("project_status",), with_status),
    (("eu_amount_derived", "eu_amount_source"), ("total_eligible_amount", "eu_amount", "cofinancing_rate"), with_eu_amount),
)
_SCORED = ("software_score", "software_label", "software_evidence", "is_software")
_SCORED_BY = ("project_title", "project_summary", "intervention_code", "caen")


def build_projects(
    interim: DataFrame,
    mode: str = "literal",
    blanks_are_missing: bool = False,
    vectors: DataFrame | None = None,
    score: Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Interim project rows to the project registry, with all columns or the given ones; the
    merge shuffles only what these are made of.

    ``vectors`` (record_id, vec) and ``score`` (an expression over ``vec``, see
    ``functions.vectors``) add the meaning signal.
    """
    columns = schema.BUILT_PROJECTS.fieldNames() if columns is None else columns
    meant = vectors is not None and score is not None
    steps = [s for s in _STEPS if any(c in columns for c in s[0]) and any(c in interim.columns for c in s[1])]
    scored = any(c in columns for c in _SCORED)
    made = {c for s in steps for c in s[0]} | set(_SCORED)
    needed = {c for c in columns if c not in made} | {c for s in steps for c in s[1]}
    if scored:
        needed |= {*_SCORED_BY, *(["record_id"] if meant else [])}
    # Source, file and row give the id again, and order rows as with it: it isn't shuffled.
    origin = ("source", "source_file", "source_row")
    carried = needed | set(origin) if "record_id" in needed else needed
    rows = interim.drop(*made)
    derived = deduplicate(rows, blanks_are_missing, carried - {"record_id"}, [c for c in SEQUENCE if c != "record_id"], identity=mode)
    # Columns that no row gives aren't merged but filled in.
    absent = [f for f in schema.PROJECTS.fields if f.name in needed and f.name not in (*rows.columns, "record_id")]
    derived = derived.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    if "record_id" in needed:
        derived = derived.withColumn("record_id", record_id(*[F.col(c) for c in origin]))
    for _, _, step in steps:
        derived = step(derived)
    if not scored:
        return derived.select(*columns)
    if meant:
        known = vectors.select("record_id", score.alias("meaning"))
        derived = classify_projects(derived.join(known, "record_id", "left"), meaning="meaning")
    else:
        said = [p for p in PARTS if f"software_{p}" in columns or (p == "score" and "is_software" in columns)]
        derived = classify_projects(derived, parts=said)
    return derived.select(*columns)


def build_calls(interim: DataFrame) -> DataFrame:
    """Interim call rows to the call registry: one row per source and call."""
    first = keep_top(
        interim, ["source", "call_id"], [F.asc_nulls_last("fetched_at"), F.asc_nulls_last("url"), F.asc("title")]
    )
    return classify_calls(first).select(*schema.CALLS.fieldNames())


def publish(
    spark: SparkSession, projects: DataFrame, calls: DataFrame, folder: str
) -> tuple[DataFrame, DataFrame]:
    """Writes both registries and publishes views over the written tables."""
    sinks.write_table(projects, f"{folder}/projects")
    sinks.write_table(calls, f"{folder}/calls")
    tables = spark.read.parquet(f"{folder}/projects"), spark.read.parquet(f"{folder}/calls")
    sinks.publish_views(*tables)
    return tables


__all__ = ["Extract", "build_calls", "build_projects", "extract_report", "extract_tables", "publish", "stage_tables"]
