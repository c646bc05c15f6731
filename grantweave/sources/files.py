"""Readers: raw files, CSV and Markdown grids, JSON pages, call pages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions import html, parse
from grantweave.functions.text import strip_space
from grantweave.sources.records import read_records


def _path() -> Column:
    return F.col("_metadata.file_path")


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``; both may carry a scheme such as ``file:``."""
    bare = root.split(":", 1)[-1].lstrip("/").rstrip("/")
    return F.regexp_replace(path, rf"^[a-z0-9]*:?/*\Q{bare}\E/", "")


#: Bytes that are hashed at once of a file too large for a cell.
HASH_BLOCK = 8 << 20


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The content hash of each file, read block by block."""
    for batch in batches:
        hashes = []
        for path in batch.column("path").to_pylist():
            scheme, _, rest = path.partition(":")
            local = scheme == "file"
            system, name = (LocalFileSystem(), "/" + rest.lstrip("/")) if local else FileSystem.from_uri(quote(path, safe="/:@"))
            found = hashlib.sha256()
            with system.open_input_stream(name, compression=None) as stream:
                while block := stream.read(HASH_BLOCK):
                    found.update(block)
            hashes.append(found.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], names=[*batch.schema.names, "sha256"])


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Each raw file with path, size, content hash and time.

    A file that fits a cell (spark.sql.sources.binaryFile.maxLength, 2 GiB at most) is hashed as one; larger
    ones are streamed in blocks, each by the task that lists it. Spark lists no files without a byte.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files, most = reader.load(root), int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))
    fits = files.where(F.col("length") <= most).select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > most).select("path", "length", "modificationTime")
    large = large.mapInArrow(_hashed, "path string, length long, modificationTime timestamp, sha256 string")
    return fits.unionByName(large).select(
        relative_path(F.col("path"), root).alias("path"),
        "sha256",
        F.col("length").alias("bytes"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetched_at"),
    )


def lines_with_numbers(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Lines of text files with their 0-based number in the file. Files that weren't read to their end are left out."""
    lines = read_records(spark, paths, glob, quoted=False).placed()
    return lines.select("file_path", F.col("line_no").alias("row_no"), F.col("line").alias("value"))


def markdown_cells(line: Column) -> Column:
    """Cells of a Markdown table line; null for other lines and separators."""
    text = strip_space(line)
    inner = F.regexp_replace(text, r"^\|+|\|+$", "")
    cells = F.transform(F.split(inner, r"\|"), strip_space)
    return F.when(text.startswith("|") & ~text.rlike(r"^\|[\s:|-]+\|?$"), cells)


def markdown_grid(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Table rows of Markdown text. ``row_no`` counts table rows only."""
    from grantweave.operators.headers import number_rows

    rows = lines_with_numbers(spark, paths, glob).withColumn("cells", markdown_cells(F.col("value")))
    table = rows.where("cells IS NOT NULL").withColumnRenamed("row_no", "line_no")
    return number_rows(table, ["file_path"], "line_no", "row_no").select("file_path", "row_no", "cells")


def csv_cells(record: Column) -> Column:
    """The cells of one CSV record as it is written, however many there are. Quotes
    go, doubled ones stay once, and empty cells at the end are left out."""
    raw = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(r'((?:"(?:[^"]|"")*+")?+[^,]*+),'), 1)
    filled = F.coalesce(F.array_max(F.transform(raw, lambda c, i: F.when(c != "", i + 1))), F.lit(0))
    return F.transform(
        F.slice(raw, F.lit(1), filled),
        lambda c: F.when(
            c.startswith('"') & c.endswith('"') & (F.length(c) > 1),
            F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"'),
        ).otherwise(c),
    )


def csv_tables(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, multiline: bool = True
) -> tuple[DataFrame, DataFrame]:
    """CSV records as grids (no header, all text, any number of cells), and the state of each file.

    Files are split, also where cells hold line breaks; the raw text is scanned once. A file that breaks
    off anywhere gives no row at all, and its state says "incomplete" (see ``records``). Without
    ``multiline`` every line is a record, whatever its quotes.
    """
    found = read_records(spark, paths, glob, quoted=multiline)
    grid = found.records().select("file_path", "row_no", csv_cells(F.col("record")).alias("cells"))
    return grid, found.files


def csv_grid(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, multiline: bool = True
) -> DataFrame:
    """The grids of ``csv_tables``; ``extract_report`` names the files left out when it gets their states."""
    return csv_tables(spark, paths, glob, multiline)[0]


def project_pages(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Projects from paged JSON (``{"list": [...]}``), with provenance from the
    manifest; ``source_row`` is the item's place on its page."""
    pages = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        .text(root, wholetext=True)
        .select(relative_path(_path(), root).alias("path"), F.try_parse_json("value").alias("page"))
        .where("page IS NOT NULL")
    )
    items = pages.lateralJoin(
        spark.tvf.variant_explode_outer(F.try_variant_get(F.col("page").outer(), "$.list", "variant"))
    ).where("value IS NOT NULL")
    return project_items(items.join(manifest, "path"))


def project_items(items: DataFrame) -> DataFrame:
    """Fields of JSON project items (``value`` VARIANT, ``pos``) joined with manifest rows."""
    item = F.col("value")

    def first(name: str) -> Column:
        return parse.first_value(item, name)

    def either(one: str, other: str) -> Column:
        return F.coalesce(F.nullif(first(one), F.lit("")), first(other))

    place = parse.lat_long(F.coalesce(first("coordinates"), F.lit("")))
    return items.select(
        F.try_variant_get(item, "$.item", "string").alias("project_code"),
        either("originalLabels", "labels").alias("project_title"),
        parse.clean_markup(either("originalDescriptions", "descriptions")).alias("project_summary"),
        parse.iso_date(first("startTimes")).alias("start_date"),
        parse.iso_date(first("endTimes")).alias("end_date"),
        parse.comma_decimal(first("totalBudgets")).alias("total_eligible_amount"),
        parse.comma_decimal(first("euBudgets")).alias("eu_amount"),
        F.lit("EUR").alias("currency"),
        F.coalesce(F.nullif(first("countrycode"), F.lit("")), F.lit("RO")).alias("country"),
        first("objectiveIds").alias("specific_objective"),
        place["latitude"].alias("latitude"),
        place["longitude"].alias("longitude"),
        F.lit("2014-2020").alias("programming_period"),
        "source",
        F.col("dataset").alias("source_dataset"),
        F.col("url").alias("source_url"),
        F.col("path").alias("source_file"),
        F.col("sha256").alias("source_sha256"),
        F.col("pos").cast("bigint").alias("source_row"),
        "fetched_at",
    )


CALL_ITEM = """
    id BIGINT, slug STRING, link STRING, title STRUCT<rendered:STRING>, date STRING,
    modified STRING, beneficiar ARRAY<BIGINT>, domeniu ARRAY<BIGINT>,
    tip_apel ARRAY<BIGINT>, zona_geografica ARRAY<BIGINT>
"""


def call_items(spark: SparkSession, root: str, manifest: DataFrame, prefix: str) -> DataFrame:
    """Call items of the JSON pages below ``prefix`` that the manifest lists,
    one row per call id (the first in file and item order)."""
    from grantweave.operators.dedup import keep_top

    pages = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        .text(root, wholetext=True)
        .select(relative_path(_path(), root).alias("path"), "value")
        .where(F.col("path").startswith(prefix))
        .join(manifest.select("path", "source", "fetched_at"), "path")
    )
    parsed = pages.select(
        "path", "source", "fetched_at",
        F.posexplode(F.from_json("value", f"array<struct<{_struct_fields(CALL_ITEM)}>>")).alias("_pos", "_item"),
    ).select("path", "source", "fetched_at", "_pos", "_item.*")
    return keep_top(parsed, ["id"], [F.asc("path"), F.asc("_pos")]).drop("_pos", "path")


def _struct_fields(ddl: str) -> str:
    """``name TYPE`` pairs as ``name:TYPE``."""
    pairs = [part.strip().split(" ", 1) for part in ddl.strip().split(",\n")]
    fields = []
    for part in ", ".join(" ".join(p) for p in pairs).split(", "):
        name, kind = part.strip().split(" ", 1)
        fields.append(f"{name}:{kind.strip()}")
    return ",".join(fields)


def taxonomy_terms(spark: SparkSession, root: str) -> DataFrame:
    """(taxonomy, id, name) of the term lists ``<taxonomy>.json``, names decoded."""
    files = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        .text(root, wholetext=True)
        .select(F.regexp_extract(_path(), r"([^/]+)\.json$", 1).alias("taxonomy"), "value")
        .where(F.col("taxonomy").isin(list(fv.TAXONOMIES)))
    )
    return files.select(
        "taxonomy", F.explode(F.from_json("value", "array<struct<id:bigint,name:string>>")).alias("t")
    ).select("taxonomy", "t.id", html.unescape(F.coalesce("t.name", F.lit(""))).alias("name"))


def call_pages(spark: SparkSession, root: str) -> DataFrame:
    """Stored call pages by slug, plain or gzipped; bad bytes are replaced. With
    both forms of a slug, the name that sorts last wins."""
    from grantweave.operators.dedup import keep_top

    pages = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{html,html.gz}")
        .text(root, wholetext=True)
        .select(
            F.col("_metadata.file_name").alias("name"),
            F.make_valid_utf8("value").alias("html"),
            F.col("_metadata.file_modification_time").alias("stored_at"),
        )
        .withColumn("slug", F.regexp_replace("name", r"\.html(\.gz)?$", ""))
    )
    return keep_top(pages, ["slug"], [F.desc("name")]).select("slug", "html", "stored_at")


def with_manual_files(manifest: DataFrame, manual: DataFrame) -> DataFrame:
    """The manifest plus hand-placed files, which sort after it: their address
    is ``manual:`` and their name."""
    name = F.substring_index("path", "/", -1)
    placed = manual.withColumns(
        {"url": F.concat(F.lit("manual:"), name), "is_manual": F.lit(True)}
    )
    return manifest.withColumn("is_manual", F.lit(False)).unionByName(placed, allowMissingColumns=True)
