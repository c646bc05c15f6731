"""Which published files count: formats, addresses, names, sizes, dates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.text import let, strip_space
from grantweave.operators.dedup import keep_top


def usable_url(*candidates: Column) -> Column:
    """The first address that is an absolute web address."""
    texts = [strip_space(c) for c in candidates]
    return F.coalesce(*[F.when(t.rlike("^https?://"), t) for t in texts])


def select_resources(resources: DataFrame, newest: int | None = None) -> DataFrame:
    """Tabular resources with a usable address; per data set the newest first.

    The limit counts resources before the address test, as the portal lists them.
    """
    tabular = resources.where(F.lower("format").isin(fv.TABULAR_FORMATS))
    if newest is not None:
        order = [F.desc(F.coalesce("last_modified", F.lit(""))), F.asc("id")]
        tabular = keep_top(tabular, ["dataset"], order, newest)
    url = usable_url(F.col("datagovro_download_url"), F.col("url"))
    return tabular.withColumn("download_url", url).where(F.col("download_url").isNotNull())


def file_name_of(url: Column) -> Column:
    """Decoded last part of an address, without its query."""
    decoded = F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)
    return F.substring_index(F.substring_index(decoded, "?", 1), "/", -1)


def is_project_list(url: Column) -> Column:
    """A document whose name says it lists projects, and not something else."""

    def listed(name: Column) -> Column:
        document = F.lower(name).rlike("(" + "|".join(re.escape(e) for e in fv.LIST_FILE_SUFFIXES) + ")$")
        return document & name.rlike(fv.LIST_FILE_NAMES) & ~name.rlike(fv.OTHER_FILE_NAMES)

    return let(file_name_of(url), listed)


def select_snapshots(index: DataFrame, budget: int | None = None) -> DataFrame:
    """Project lists of an archive index (timestamp, original), newest first, one
    per output path, at most ``budget``."""
    listed = index.where(is_project_list(F.col("original"))).withColumn(
        "path",
        F.concat(
            F.substring("timestamp", 1, 4), F.lit("/"), F.col("timestamp"), F.lit("-"),
            file_name_of(F.col("original")),
        ),
    )
    distinct = keep_top(listed, ["path"], [F.desc("timestamp"), F.desc("original")])
    if budget is None:
        return distinct
    return distinct.orderBy(F.desc("timestamp"), F.desc("original")).limit(budget)


def large_enough(size: Column, least: int = fv.MIN_PAYLOAD_BYTES) -> Column:
    return size >= least


def program_in(name: Column, pattern: str = fv.PORTAL_PROGRAMS) -> Column:
    """Program named in a file name or path, upper case, else null."""
    return F.nullif(F.upper(F.regexp_extract(name, pattern, 1)), F.lit(""))


def archive_program(dataset: Column, original_url: Column, path: Column) -> Column:
    """The data set's program; where unknown, that of the address, then the path."""
    return F.when(dataset != fv.UNKNOWN_PROGRAM, dataset).otherwise(
        F.coalesce(
            program_in(original_url, fv.ARCHIVE_PROGRAMS), program_in(path, fv.ARCHIVE_PROGRAMS)
        )
    )


def snapshot_date(url: Column) -> Column:
    """Date of an archived copy, from ``/web/20240515…`` in its address."""
    stamp = F.regexp_extract(url, r"/web/(\d{8})", 1)
    return F.when(
        stamp != "",
        F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2)),
    )
