"""Contrastive meaning score: closer to the wanted examples than to the others?"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv


def _unit_rows(vectors: Sequence[Sequence[float]]) -> np.ndarray:
    matrix = np.asarray(vectors, dtype=np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def contrastive_score(
    vector: Column,
    wanted: Sequence[Sequence[float]],
    other: Sequence[Sequence[float]],
    floor: float = fv.MEANING_FLOOR,
    ceiling: float = fv.MEANING_CEILING,
) -> Column:
    """Best cosine with ``wanted`` minus best cosine with ``other``, scaled from
    [floor, ceiling] to [0, 1] and rounded to 3; 0 without a vector.

    One matrix product per Arrow batch. Built-in array functions would interpret
    every multiplication of every row.
    """
    prototypes = np.vstack([_unit_rows(wanted), _unit_rows(other)]).T
    split = len(wanted)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        known = vectors.notna().to_numpy()
        out = np.zeros(len(vectors))
        if known.any():
            matrix = np.stack(vectors[known].to_numpy()).astype(np.float64)
            norms = np.linalg.norm(matrix, axis=1)
            cosines = (matrix @ prototypes) / np.where(norms == 0, 1.0, norms)[:, None]
            delta = cosines[:, :split].max(axis=1) - cosines[:, split:].max(axis=1)
            scaled = np.clip((delta - floor) / (ceiling - floor), 0.0, 1.0)
            out[known] = np.where(norms == 0, 0.0, scaled)
        return pd.Series(np.round(out, 3))

    return score(vector)


#: Prototypes in a block, and vectors that meet it at once.
BLOCK = 1024


def _matrix(values: pa.Array) -> np.ndarray:
    return np.stack(values.to_numpy(zero_copy_only=False)).astype(np.float64)


def prototype_blocks(prototypes: DataFrame, vector: str = "vec", wanted: str = "wanted") -> DataFrame:
    """(block, wanted, width, matrix): unit prototypes, packed. Rows without a vector or of length 0 are left out."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = batch.column(wanted).to_numpy(zero_copy_only=False)
            for side in (True, False):
                own = batch.column(vector).filter(pa.array(sides == side))
                for at in range(0, len(own), BLOCK):
                    rows = _matrix(own.slice(at, BLOCK))
                    norms = np.linalg.norm(rows, axis=1, keepdims=True)
                    unit = (rows / np.where(norms == 0, 1.0, norms))[norms[:, 0] > 0]
                    if len(unit):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([side]), pa.array([unit.shape[1]], pa.int64()), pa.array([unit.tobytes()], pa.binary())],
                            names=["wanted", "width", "matrix"],
                        )

    known = prototypes.where(F.col(vector).isNotNull() & F.col(wanted).isNotNull()).select(vector, wanted)
    blocks = known.mapInArrow(packed, "wanted boolean, width long, matrix binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())


def contrastive_scores(
    vectors: DataFrame, prototypes: DataFrame, key: str, vector: str,
    floor: float = fv.MEANING_FLOOR, ceiling: float = fv.MEANING_CEILING,
) -> DataFrame:
    """(key, score) of ``contrastive_score`` for prototypes (``vec``, ``wanted``) of any number.

    Prototypes are blocks of a distributed matrix. Vectors are packed as well; a pack meets each
    block in one product, and of that only the best cosine of each vector goes on. The best of all blocks is a
    maximum, so nothing is gathered: not on the driver, and a task holds a pack and a block. Keys must be unique.
    """
    from grantweave.sources.staging import written

    blocks = written(prototype_blocks(prototypes))
    kind = vectors.schema[key].dataType.simpleString()
    plain = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vec"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows = _matrix(part.column("vec"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("key").to_pylist()], pa.list_(part.column("key").type)), pa.array([rows.tobytes()], pa.binary())],
                    names=["keys", "rows"],
                )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                width = batch.column("width")[i].as_py()
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), np.float64).reshape(-1, width) for c in ("rows", "matrix"))
                norms = np.linalg.norm(a, axis=1)
                top = (a @ b.T).max(axis=1) / np.where(norms == 0, 1.0, norms)
                side = batch.column("wanted")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("keys")[i].values, pa.array([side] * len(a)), pa.array(top), pa.array(norms > 0)],
                    names=["key", "wanted", "cosine", "known"],
                )

    packs = plain.where("vec IS NOT NULL").mapInArrow(pack, f"keys array<{kind}>, rows binary")
    numbers = [r.block for r in blocks.select("block").collect()]
    if not numbers:
        return plain.select(F.col("key").alias(key), F.lit(0.0).alias("score"))
    # Every pack meets every block: a stated set of blocks, joined by number.
    met = packs.withColumn("block", F.explode(F.array(*[F.lit(n) for n in numbers]))).join(blocks, "block")
    cosines = met.select("keys", "rows", "wanted", "width", "matrix").mapInArrow(best, f"key {kind}, wanted boolean, cosine double, known boolean")
    tops = cosines.groupBy("key").agg(
        F.max(F.when(F.col("wanted"), F.col("cosine"))).alias("_for"), F.max(F.when(~F.col("wanted"), F.col("cosine"))).alias("_against"),
        F.bool_or("known").alias("_known"),
    )
    scaled = (F.col("_for") - F.col("_against") - floor) / (ceiling - floor)
    score = F.when(F.col("_known"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)), 3))
    scores = tops.select(F.col("key").alias(key), F.coalesce(score, F.lit(0.0)).alias("score"))
    rest = plain.where("vec IS NULL").select(F.col("key").alias(key), F.lit(0.0).alias("score"))
    return scores.unionByName(rest)
