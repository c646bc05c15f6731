"""The two published schemas and the operators that bring frames to them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def struct(columns: str) -> T.StructType:
    """A schema from ``name TYPE`` pairs, without needing a session."""
    pairs = [column.split() for column in re.split(r",\s+", columns.strip())]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PROJECTS = struct(
    """
    record_id STRING, program STRING, programming_period STRING, project_status STRING,
    beneficiary_name STRING, beneficiary_cui STRING, beneficiary_type STRING,
    project_code STRING, project_title STRING, project_summary STRING,
    start_date DATE, end_date DATE, total_eligible_amount DOUBLE,
    total_project_amount DOUBLE, eu_amount DOUBLE, payments_amount DOUBLE,
    currency STRING, cofinancing_rate DOUBLE, fund STRING, specific_objective STRING,
    intervention_code STRING, country STRING, region STRING, county STRING,
    locality STRING, latitude DOUBLE, longitude DOUBLE, eu_amount_derived DOUBLE,
    eu_amount_source STRING, status STRING, counties ARRAY<STRING>,
    regions ARRAY<STRING>, software_score DOUBLE, software_label STRING,
    software_evidence STRING, is_software BOOLEAN, source STRING,
    source_dataset STRING, source_url STRING, source_file STRING,
    source_sha256 STRING, source_row BIGINT, fetched_at STRING
    """
)
BUILT_PROJECTS = T.StructType([*PROJECTS.fields, T.StructField("beneficiary_key", T.StringType())])

CALLS = struct(
    """
    call_id STRING, title STRING, url STRING, external_url STRING,
    programs ARRAY<STRING>, specific_objective STRING, call_type STRING,
    call_types ARRAY<STRING>, status STRING, opens_at DATE, closes_at DATE,
    continuous BOOLEAN, budget_amount DOUBLE, budget_currency STRING,
    beneficiaries ARRAY<STRING>, domains ARRAY<STRING>, geo_areas ARRAY<STRING>,
    documents ARRAY<STRING>, software_score DOUBLE, software_label STRING,
    software_evidence STRING, is_software BOOLEAN, published_at STRING,
    modified_at STRING, source STRING, source_url STRING, fetched_at STRING
    """
)

MANIFEST = struct(
    """
    source STRING, dataset STRING, url STRING, path STRING, sha256 STRING,
    bytes BIGINT, fetched_at STRING, meta MAP<STRING,STRING>
    """
)

GRID = struct("file_path STRING, row_no BIGINT, cells ARRAY<STRING>")

_SOURCE_RESULT = struct("source STRING, files BIGINT, bytes BIGINT, rows BIGINT, error STRING")
RUN_REPORT = T.StructType(
    [
        *struct("started_at STRING, finished_at STRING, seconds DOUBLE, ok BOOLEAN"),
        T.StructField("sources", T.ArrayType(_SOURCE_RESULT)),
        *struct("projects BIGINT, projects_new BIGINT, calls BIGINT, calls_new BIGINT"),
        *struct("calls_active BIGINT, software BIGINT, errors ARRAY<STRING>"),
    ]
)


def conform(df: DataFrame, schema: T.StructType = PROJECTS) -> DataFrame:
    """Exactly the columns of ``schema``: gaps become typed nulls, extras go,
    values that do not fit their type become null."""
    present = set(df.columns)

    def fitted(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select([fitted(field) for field in schema.fields])


def union_conformed(frames: list[DataFrame], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """Union of all frames after conforming each; the empty frame when there are none."""
    if not frames:
        return empty(spark, schema)
    out = conform(frames[0], schema)
    for frame in frames[1:]:
        out = out.unionByName(conform(frame, schema))
    return out


def empty(spark: SparkSession, schema: T.StructType = PROJECTS) -> DataFrame:
    return spark.createDataFrame([], schema)
