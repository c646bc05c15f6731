"""Row cleaning and the gates that reject whole files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions import parse
from grantweave.functions.text import fiscal_code, squeeze


def is_beneficiary(name: Column, mode: str = "literal") -> Column:
    """Three letters in a row, and not a total or left-over header row.

    ``literal`` drops names holding one of the words in lower case anywhere;
    ``intended`` drops names starting with one, in any case.
    """
    if mode == "literal":
        total = name.rlike(fv.TOTAL_ROW_WORDS)
    elif mode == "intended":
        total = name.rlike("(?i)^" + fv.TOTAL_ROW_WORDS)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(name.rlike("[A-Za-zÀ-ž]{3}") & ~total, F.lit(False))


def parse_fields(df: DataFrame) -> DataFrame:
    """Names squeezed, fiscal codes, amounts and dates parsed, where present."""
    parsers = {"beneficiary_name": squeeze, "beneficiary_cui": fiscal_code}
    parsers |= {name: parse.money for name in fv.MONEY_FIELDS}
    parsers |= {name: parse.date for name in fv.DATE_FIELDS}
    return df.withColumns(
        {name: parser(F.col(name)) for name, parser in parsers.items() if name in df.columns}
    )


def clean_rows(df: DataFrame, mode: str = "literal") -> DataFrame:
    """Parsed fields of the rows that name a beneficiary."""
    df = parse_fields(df)
    if "beneficiary_name" not in df.columns:
        return df
    return df.where(is_beneficiary(F.col("beneficiary_name"), mode))


def file_report(
    df: DataFrame,
    kept: Column,
    coded: Column,
    by: Sequence[str] = ("file_path",),
    min_code_share: float = fv.MIN_CODE_SHARE,
    min_kept_share: float = fv.MIN_KEPT_SHARE,
) -> DataFrame:
    """Per file: rows, kept rows, kept rows with a code, and the first reason to
    reject it (null when it passes). ``kept`` and ``coded`` are row conditions."""
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(kept).alias("n_kept"),
        F.count_if(kept & coded).alias("n_coded"),
    )
    return judge_counts(counts, min_code_share, min_kept_share)


def judge_counts(
    counts: DataFrame, min_code_share: float = fv.MIN_CODE_SHARE, min_kept_share: float = fv.MIN_KEPT_SHARE
) -> DataFrame:
    """Counts per file (``n_rows``, ``n_kept``, ``n_coded``) with the first reason to reject it."""
    reason = (
        F.when(F.col("n_kept") == 0, F.lit("no usable rows"))
        .when(F.col("n_coded") < F.col("n_kept") * min_code_share, F.lit("few project codes"))
        .when(F.col("n_kept") < F.col("n_rows") * min_kept_share, F.lit("few usable rows"))
    )
    return counts.withColumn("reason", reason)


def keep_passing(df: DataFrame, report: DataFrame, by: Sequence[str] = ("file_path",)) -> DataFrame:
    """Rows of the files without a reason to reject."""
    passing = report.where(F.col("reason").isNull()).select(*by)
    return df.join(passing, list(by), "left_semi")


def has_code(code: Column) -> Column:
    return F.coalesce(code.rlike(r"^\s*\d{4,7}\s*$"), F.lit(False))


def best_variant(
    rows: DataFrame,
    usable: Column,
    priority: Column,
    by: Sequence[str] = ("file_path",),
    variant: str = "variant",
) -> DataFrame:
    """Per file, the reading with most usable rows; the lower ``priority`` on a tie."""
    counts = rows.groupBy(*by, variant).agg(
        F.count_if(usable).alias("n_usable"), F.min(priority).alias("_priority")
    )
    order = F.struct(F.col("n_usable"), -F.col("_priority"))
    return counts.groupBy(*by).agg(
        F.max_by(variant, order).alias(variant), F.max("n_usable").alias("n_usable")
    )


def check_widths(
    grid: DataFrame, header_blocks: DataFrame, by: Sequence[str] = ("file_path",)
) -> tuple[DataFrame, DataFrame]:
    """Table blocks as wide as the header's block, and per file how many are not.

    ``header_blocks`` gives per file the ``block_no`` that holds the header. A
    block's width is that of its first row.
    """
    widths = grid.groupBy(*by, "block_no").agg(
        F.min_by(F.size("cells"), F.col("row_no")).alias("width")
    )
    wanted = header_blocks.join(widths, [*by, "block_no"]).select(
        *by, F.col("block_no").alias("_header"), F.col("width").alias("_width")
    )
    judged = widths.join(wanted, list(by)).where(F.col("block_no") >= F.col("_header"))
    fits = F.col("width") == F.col("_width")
    kept = grid.join(judged.where(fits).select(*by, "block_no"), [*by, "block_no"], "left_semi")
    report = judged.groupBy(*by).agg(
        F.count_if(fits).alias("blocks_kept"), F.count_if(~fits).alias("blocks_skipped")
    )
    return kept, report
