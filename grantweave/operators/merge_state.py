"""Merging as a stored state, so that a new snapshot costs its own keys and not all of them.

A key's state is what ``merge_duplicates`` needs to know of its rows: the winning row with its order, and for
each filled field the first known value with its place. Two states of a key merge into one by the same
minimum, so rows may come in any number of snapshots, in any order, and again.

The store deals keys into buckets. A snapshot reads and writes the buckets of its keys only, as a new
generation; a manifest of one row for each bucket and generation makes it count. A run that fails before
leaves the store as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.operators.dedup import latest_first
from grantweave.sources.staging import written

BUCKETS = 64


def merge_state(
    df: DataFrame, key: Sequence[str | Column], sequence: Sequence[str], latest: str = "fetched_at",
    fill: Sequence[str] = tuple(fv.MERGED_FIELDS),
) -> DataFrame:
    """One row per key: ``_key_i``, the winner's ``_order`` and ``_row``, and ``_place_c`` and ``_fill_c`` of filled fields."""
    plain = [k for k in key if isinstance(k, str)]
    place = F.struct(*sequence)
    order = F.struct(F.col(latest).isNotNull(), latest_first(F.col(latest)), *sequence)
    columns = {f"_key_{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(key)}
    columns |= {"_order": order, "_row": F.struct(*df.columns)}
    for c in fill:
        if c in df.columns and c not in plain:
            columns |= {f"_place_{c}": F.when(F.col(c).isNotNull(), place), f"_fill_{c}": F.col(c)}
    return _least(df.select(*[v.alias(k) for k, v in columns.items()]))


def _least(states: DataFrame) -> DataFrame:
    keys = [c for c in states.columns if c.startswith("_key_")]
    fills = [c.removeprefix("_fill_") for c in states.columns if c.startswith("_fill_")]
    chosen = [F.min_by("_row", "_order").alias("_row")]
    for c in fills:
        chosen += [F.min(f"_place_{c}").alias(f"_place_{c}"), F.min_by(f"_fill_{c}", f"_place_{c}").alias(f"_fill_{c}")]
    return states.groupBy(*keys).agg(F.min("_order").alias("_order"), *chosen).select(*states.columns)


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all their rows together."""
    return _least(reduce(DataFrame.unionByName, states))


def merged_rows(state: DataFrame) -> DataFrame:
    """The merged rows of a state, as ``merge_duplicates`` gives them."""
    return state.select(*[
        F.coalesce(F.col(f"_row.{c}"), F.col(f"_fill_{c}")).alias(c) if f"_fill_{c}" in state.columns else F.col(f"_row.{c}").alias(c)
        for c in state.schema["_row"].dataType.names
    ])


class MergeStore:
    """The state of all snapshots so far, below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _generations(self) -> dict[int, int]:
        """The generation that counts, by bucket: as many rows as there are buckets."""
        try:
            rows = self.spark.read.schema("bucket int, generation int").parquet(f"{self.folder}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r.bucket: r.generation for r in rows.groupBy("bucket").agg(F.max("generation").alias("generation")).collect()}

    def _read(self, schema, generations: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/generation={g}/bucket={b}" for b, g in sorted(generations.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def absorb(self, state: DataFrame) -> list[int]:
        """Merges a snapshot's state in; the buckets that it touched."""
        keys = [c for c in state.columns if c.startswith("_key_")]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        new = written(state.withColumn("bucket", bucket))
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
        if not touched:
            return []
        known = self._generations()
        generation = max(known.values(), default=-1) + 1
        old = self._read(state.schema, {b: known[b] for b in touched if b in known})
        merged = merge_states(old, new.drop("bucket")).withColumn("bucket", bucket)
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/generation={generation}")
        rows = self.spark.createDataFrame([(b, generation) for b in touched], "bucket int, generation int")
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        return touched

    def state(self, schema) -> DataFrame:
        """All keys' state; schema is that of the snapshots' states."""
        return self._read(schema, self._generations())
