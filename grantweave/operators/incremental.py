"""What changed: manifests, stale items, new ids, files still to parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave.operators.dedup import keep_top


def manifest_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """All paths of both; the new row where both have one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = [F.desc("_new"), F.desc_nulls_last("fetched_at"), F.asc_nulls_last("sha256")]
    return keep_top(both, ["path"], order).drop("_new")


def existing_only(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Manifest rows whose file is there."""
    return manifest.join(inventory.select("path"), "path", "left_semi")


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per path of either side: nou, neschimbat, actualizat or lipsă."""
    left = old.select("path", F.col("sha256").alias("old_sha256"))
    right = new.select("path", F.col("sha256").alias("new_sha256"))
    change = (
        F.when(F.col("old_sha256").isNull(), F.lit("nou"))
        .when(F.col("new_sha256").isNull(), F.lit("lipsă"))
        .when(F.col("old_sha256") == F.col("new_sha256"), F.lit("neschimbat"))
        .otherwise(F.lit("actualizat"))
    )
    return left.join(right, "path", "full_outer").withColumn("change", change)


def stale_items(
    items: DataFrame,
    stored: DataFrame,
    key: str,
    modified: Column,
    stored_at: str = "stored_at",
    budget: int | None = None,
) -> DataFrame:
    """Items with no stored page, or changed after it was stored. An item whose
    ``modified`` time is missing or unreadable is not stale once it is stored."""
    joined = items.join(stored.select(key, stored_at), key, "left")
    stale = joined.where(F.col(stored_at).isNull() | (modified > F.col(stored_at)))
    if budget is None:
        return stale
    return stale.orderBy(F.desc_nulls_last(modified), key).limit(budget)


def new_ids(after: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Distinct ids of the new build that the old one did not have; nulls do not count."""
    known = before.select(key).where(F.col(key).isNotNull())
    return after.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")


def parse_pending(manifest: DataFrame, parsed: DataFrame, version: int) -> DataFrame:
    """Files this version of the parser has not read yet, by content hash."""
    done = parsed.where(F.col("parser_version") == version).select("sha256")
    return manifest.join(done, "sha256", "left_anti")
