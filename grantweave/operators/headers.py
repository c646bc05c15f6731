"""Raw grids to named columns: header detection, alias mapping, row numbers.

A grid has one row per line of a published table: ``file_path``, ``row_no`` (the
line's place in its file) and ``cells``. Header look-ups never join: each header
is matched by one pattern, longest spelling first.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.text import slug, squeeze
from grantweave.sources.staging import written

Aliases = dict[str, list[str]]
CHUNK_ROWS = 65_536


def _spellings(aliases: Aliases | None) -> list[tuple[str, str]]:
    """(spelling, field), longest first; the first field to claim a spelling keeps it."""
    owner: dict[str, str] = {}
    for field, names in (aliases or fv.HEADER_ALIASES).items():
        for name in names:
            owner.setdefault(name, field)
    return sorted(owner.items(), key=lambda pair: -len(pair[0]))


def header_field(key: Column, aliases: Aliases | None = None) -> Column:
    """Canonical field of a header slug: the longest spelling it starts with
    (an exact match is the longest there can be), else null.

    One pattern tries the spellings longest first; what it finds names the field.
    """
    spellings = _spellings(aliases)
    longest = "^(?:" + "|".join(re.escape(name) for name, _ in spellings) + ")"
    fields = F.from_json(F.lit(json.dumps(dict(spellings))), "map<string,string>")
    # What fits none is '', which the map doesn't hold either.
    return F.try_element_at(fields, F.regexp_extract(key, longest, 0))


def header_fields(cells: Column, aliases: Aliases | None = None) -> Column:
    """Canonical field, or null, of each cell of a header row."""
    return F.transform(F.transform(cells, slug), lambda key: header_field(key, aliases))


def distinct_fields(fields: Column) -> Column:
    return F.size(F.array_distinct(F.array_compact(fields)))


def header_names(cells: Column) -> Column:
    """Unique column names: blanks become ``col_i``, repeats get ``_1``, ``_2``, …"""
    named = F.transform(
        F.transform(cells, squeeze),
        lambda name, i: F.when(name == "", F.concat(F.lit("col_"), i.cast("string"))).otherwise(name),
    )

    def unique(name: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(named, 1, i), lambda other: other == name))
        return F.when(earlier > 0, F.concat_ws("_", name, earlier.cast("string"))).otherwise(name)

    return F.transform(named, unique)


def _header_texts(cells: Column) -> Column:
    """Cells that a repeated header may have: short, without a digit, and with a letter."""
    return F.filter(
        cells,
        lambda c: ~c.rlike(r"[\p{Nd}\p{No}]")
        & (
            (F.length(c) <= fv.HEADER_CELL_MAX_CHARS)
            | (F.length(squeeze(c)) <= fv.HEADER_CELL_MAX_CHARS)
        ),
    )


def looks_like_header(cells: Column, aliases: Aliases | None = None) -> Column:
    """Is this row one more header? Cells that are short and hold no digit must
    map to two fields at least.

    The cheap tests come first, and only what passes them is mapped.
    """
    return distinct_fields(header_fields(_header_texts(cells), aliases)) >= fv.HEADER_MIN_FIELDS


def with_marks(grid: DataFrame, aliases: Aliases | None = None) -> DataFrame:
    """The grid with ``_fields``, the canonical fields of its first lines, and
    ``_again``, whether a row repeats a header. Fewer than two cells can't."""
    first = F.when(F.col("row_no") < fv.HEADER_SCAN_ROWS, header_fields(F.col("cells"), aliases))
    several = F.size("_texts") >= fv.HEADER_MIN_FIELDS
    again = F.when(several, distinct_fields(header_fields(F.col("_texts"), aliases)) >= fv.HEADER_MIN_FIELDS)
    marked = grid.withColumn("_texts", _header_texts(F.col("cells"))).withColumns({"_fields": first, "_again": F.coalesce(again, F.lit(False))})
    return marked.drop("_texts")


def headers_of(marked: DataFrame, by: Sequence[str] = ("file_path",)) -> DataFrame:
    """One row per file with a header (row number, cells, fields) of a grid with ``_fields``."""
    scanned = marked.where(F.col("row_no") < fv.HEADER_SCAN_ROWS).withColumn("_n", distinct_fields(F.col("_fields")))
    best = F.max_by(F.struct("row_no", "cells", "_fields", "_n"), F.struct(F.col("_n"), -F.col("row_no")))
    return scanned.groupBy(*by).agg(best.alias("h")).select(
        *by,
        F.col("h.row_no").alias("header_row"),
        F.col("h.cells").alias("header_cells"),
        F.col("h._fields").alias("fields"),
        F.col("h._n").alias("n_fields"),
    ).where(F.col("n_fields") >= fv.HEADER_MIN_FIELDS)


def detect_headers(
    grid: DataFrame, by: Sequence[str] = ("file_path",), aliases: Aliases | None = None
) -> DataFrame:
    """One row per file with a header: its row number, cells and fields.

    Among the first lines, the row with most distinct fields; the earliest on a
    tie; at least two fields.
    """
    first = grid.where(F.col("row_no") < fv.HEADER_SCAN_ROWS)
    return headers_of(first.withColumn("_fields", header_fields(F.col("cells"), aliases)), by)


def column_map(headers: DataFrame, by: Sequence[str] = ("file_path",)) -> DataFrame:
    """(file, field, position, header): the first header wins per field."""
    cell = F.posexplode(
        F.zip_with("fields", "header_cells", lambda f, h: F.struct(f.alias("field"), h.alias("header")))
    ).alias("position", "cell")
    return (
        headers.select(*by, "fields", cell)
        .where(F.col("cell.field").isNotNull())
        .where(F.array_position("fields", F.col("cell.field")) == F.col("position") + 1)
        .select(*by, F.col("cell.field").alias("field"), "position", F.col("cell.header").alias("header"))
    )


def with_chunks(df: DataFrame, order: str = "row_no", chunk: int = CHUNK_ROWS) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(order) / chunk))


def chunk_counts(rows: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """One row per file and chunk: its rows ``n_rows``, and more aggregates. Reads no other column."""
    return written(rows.groupBy(*by, "_chunk").agg(F.count(F.lit(1)).alias("n_rows"), *more))


def place_rows(
    rows: DataFrame, counts: DataFrame, by: Sequence[str], order: str = "row_no", name: str = "source_row"
) -> DataFrame:
    """rows, which have chunks, with their 0-based position in the file."""
    keys = [*by, "_chunk"]
    before = F.sum("n_rows").over(
        Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = counts.select(*keys, F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (
        rows.withColumn("_within", within)
        .join(shifts, keys)
        .withColumn(name, F.col("_before") + F.col("_within") - 1)
        .drop("_chunk", "_within", "_before")
    )


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: str = "row_no",
    name: str = "source_row",
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """0-based position of each row in its file, by a unique whole number.

    A file may be most of the data, so no task gets a whole file: rows are
    numbered within chunks of the order column, and the chunks' row counts,
    summed up to each chunk, shift them. The rows are written first, so what
    made them runs once; the counts read two columns of that table.
    """
    rows = written(with_chunks(df, order, chunk))
    return place_rows(rows, chunk_counts(rows, by), by, order, name)


def table_rows(
    marked: DataFrame, headers: DataFrame, by: Sequence[str] = ("file_path",), aliases: Aliases | None = None
) -> DataFrame:
    """Rows below the header as canonical fields, repeated headers removed, not numbered yet."""
    body = marked.join(headers.select(*by, "header_row", "fields"), list(by))
    body = body.where((F.col("row_no") > F.col("header_row")) & ~F.col("_again"))

    def value(field: str) -> Column:
        place = F.array_position("fields", F.lit(field))
        return F.when(place > 0, squeeze(F.get("cells", (place - 1).cast("int"))))

    names = list(aliases or fv.HEADER_ALIASES)
    return body.select(*by, "row_no", "fields", *[value(name).alias(name) for name in names])


def grid_to_table(
    grid: DataFrame,
    by: Sequence[str] = ("file_path",),
    aliases: Aliases | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """Rows below the header as canonical fields, repeated headers removed.

    A mapped column with a missing cell reads '' (as published tables do); a
    field the file does not have is null. ``fields`` stays for the file gates.
    The grid is read once: marked rows are written, and headers come from that table.
    """
    marked = written(with_marks(grid, aliases))
    headers = written(headers_of(marked, by)) if headers is None else headers
    return number_rows(table_rows(marked, headers, by, aliases), by)
