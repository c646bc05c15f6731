"""Tables that a plan writes once and reads several times, on storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_unset: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a temporary one where a local session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _unset:
            _unset.append(tempfile.mkdtemp(prefix="staged-"))
        root = _unset[0]
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a written table: their lineage is read once, and lost executors don't bring it back."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Shuffle files of a write are of no use once it is done.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what is planned and run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Bytes of a written table that a task deals into buckets. It sorts its rows for that, some 17 times as many bytes in memory.
DEALT_BYTES = "32m"


def dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of a written table in another one, each of whose files holds rows of one bucket of ``key``. A table of as
    many buckets by this key (``sinks.write_keyed``) is made of it without a shuffle: its tasks read the files of their bucket."""
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    with settings(spark, {"spark.sql.files.maxPartitionBytes": DEALT_BYTES}):
        writer = df.write.option("compression", "zstd").option("path", shared_folder(spark))
        writer.bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)
