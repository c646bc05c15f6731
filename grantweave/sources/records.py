"""CSV records from files that Spark splits, and the proof that a file was read to its end.

Whether a line break ends a record depends on the quotes before it, back to the file's beginning. A
line is therefore taken as a function of two states, outside and inside a quoted cell: it tells the state
at its end for both. A split is the composition of its lines, a file that of its splits. The scan
writes each line once, with what both states make of it; one row for each split then tells which
of the two holds, and where the split's records begin in the file. Only lines of records that span several are
put together by a shuffle.

Plain files are read by split. Compressed ones (.gz, .bz2) can't be split and are unpacked piece by
piece. A plain file was read whole if the bytes of its lines make up its size, a compressed one if
its packed stream comes to its end. Files that weren't, or that end within a quoted cell, give no rows.
"""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantweave.sources.staging import written

_CELL = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'
#: A line that begins outside a quoted cell and ends inside one; one that begins inside and ends outside.
OPENS = rf'^(?:{_CELL},)*"(?:[^"]|"")*$'
CLOSES = rf'^(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_CELL})*$'

PACKED = r"\.(gz|bz2)$"
#: Bytes of a compressed file that are unpacked at once.
PIECE = 1 << 16

_LINE = (
    "file_path string, start long, size long, place long, bytes long, line string, "
    "begins array<boolean>, ends array<boolean>, records array<long>, done boolean"
)


def _lines_of(packed: memoryview, name: str) -> Iterator[list[bytes] | None]:
    """Lines of a compressed file as they come; a last None says that its end was reached."""
    make = bz2.BZ2Decompressor if name.endswith(".bz2") else lambda: zlib.decompressobj(31)
    machine, rest, at, fed = make(), b"", 0, False
    while at < len(packed):
        piece = bytes(packed[at : at + PIECE])
        at += len(piece)
        while piece:
            try:
                out = machine.decompress(piece)
            except (zlib.error, OSError):
                return
            fed, piece = True, machine.unused_data if machine.eof else b""
            *lines, rest = (rest + out).split(b"\n")
            if lines:
                yield lines
            if machine.eof:
                # Packed files may follow one another; zeros may fill up the last block.
                piece, machine, fed = piece.lstrip(b"\0"), make(), False
    if not fed:
        if rest:
            yield [rest]
        yield None


def _states(kinds: np.ndarray, before: int) -> tuple[np.ndarray, int]:
    """Whether each line begins inside a quoted cell, and the state after the last.

    kinds: 0 leaves the state, 1 turns it, 2 ends outside, 3 ends inside.
    """
    turns = np.cumsum(kinds == 1)
    fixed = np.maximum.accumulate(np.where(kinds >= 2, np.arange(len(kinds)), -1))
    known = np.where(fixed >= 0, kinds[fixed] - 2, before)
    after = (known + turns - np.where(fixed >= 0, turns[fixed], 0)) % 2
    return np.concatenate([[before], after[:-1]]).astype(bool), int(after[-1])


class _Split:
    """Lines of one split, in order, taken from both states."""

    def __init__(self):
        self.place, self.state, self.records = 0, [0, 1], [0, 0]

    def add(self, lines: pa.Array, quoted: bool) -> list[pa.Array]:
        """place, begins, ends and records of the next lines. records: record beginnings so far in the split."""
        n = len(lines)
        places = np.arange(self.place, self.place + n)
        self.place += n
        kinds = np.zeros(n, np.int64)
        marked = np.flatnonzero(pc.match_substring(lines, b'"').to_numpy(zero_copy_only=False)) if quoted else []
        if len(marked):
            some = lines.take(pa.array(marked))
            opens, closes = (pc.match_substring_regex(some, p.encode()).to_numpy(zero_copy_only=False) for p in (OPENS, CLOSES))
            kinds[marked] = np.select([opens & closes, closes, opens], [1, 2, 3], 0)
        blank = pc.binary_length(lines).to_numpy(zero_copy_only=False) == 0
        begins, ends, records = np.empty((n, 2), bool), np.empty((n, 2), bool), np.empty((n, 2), np.int64)
        for s in (0, 1):
            inside, self.state[s] = _states(kinds, self.state[s])
            begins[:, s] = ~inside & ~blank
            ends[:, s] = ~np.append(inside[1:], bool(self.state[s]))
            records[:, s] = self.records[s] + np.cumsum(begins[:, s])
            self.records[s] = int(records[-1, s])
        pairs = pa.array(np.arange(0, 2 * n + 1, 2), pa.int32())
        return [pa.array(places), *[pa.ListArray.from_arrays(pairs, pa.array(x.ravel())) for x in (begins, ends, records)]]


def _batch(path: str, start: int, size: int, lines: pa.Array, sizes: pa.Array, split: _Split, quoted: bool) -> pa.RecordBatch:
    n = len(lines)
    places, begins, ends, records = split.add(lines, quoted)
    columns = [pa.array([path] * n, pa.string()), pa.array([start] * n, pa.int64()), pa.array([size] * n, pa.int64()), places, sizes]
    return pa.RecordBatch.from_arrays(
        [*columns, lines, begins, ends, records, pa.array([False] * n)],
        names=["file_path", "start", "size", "place", "bytes", "line", "begins", "ends", "records", "done"],
    )


def _reader(spark: SparkSession, form: str, glob: str | None):
    reader = spark.read.format(form).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    return reader.option("pathGlobFilter", glob) if glob else reader


def _plain_lines(spark: SparkSession, paths, glob: str | None, quoted: bool) -> DataFrame:
    """Lines by split. Line ends are \\n, \\r\\n or \\r; the bytes of the end count with the line."""
    m = F.col("_metadata")
    whole = F.when(F.endswith("value", F.lit("\r")), F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    parts = F.when(F.contains(whole, F.lit("\r")), F.split(whole, "\r")).otherwise(F.array(whole))
    scan = _reader(spark, "text", glob).option("lineSep", "\n").load(paths).where(~m["file_name"].rlike(PACKED))
    lines = scan.select(
        m["file_path"].alias("file_path"), m["file_block_start"].alias("start"), m["file_size"].alias("size"),
        (F.octet_length("value") + 1).cast("long").alias("_all"), F.posexplode(parts).alias("_part", "_text"),
    ).select(
        "file_path", "start", "size", F.when(F.col("_part") == 0, F.col("_all")).otherwise(0).alias("bytes"),
        F.col("_text").cast("binary").alias("line"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, split = None, _Split()
        for batch in batches:
            if not batch.num_rows:
                continue
            paths_, starts = batch.column("file_path").dictionary_encode(), batch.column("start").to_numpy()
            codes = paths_.indices.to_numpy()
            edges = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                own = (paths_.dictionary[codes[a]].as_py(), int(starts[a]))
                if own != key:
                    key, split = own, _Split()
                yield _batch(*own, part.column("size")[0].as_py(), part.column("line"), part.column("bytes"), split, quoted)

    return lines.mapInArrow(run, _LINE.replace("line string", "line binary"))


def _packed_lines(spark: SparkSession, paths, glob: str | None, quoted: bool) -> DataFrame:
    """Lines of compressed files, and for each a row without a line that says whether its end was reached."""
    files = _reader(spark, "binaryFile", glob).load(paths).where(F.col("_metadata.file_name").rlike(PACKED))
    files = files.select(F.col("_metadata.file_path").alias("file_path"), "length", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, size = batch.column("file_path")[i].as_py(), batch.column("length")[i].as_py()
                split, done = _Split(), False
                for lines in _lines_of(memoryview(batch.column("content")[i].as_buffer()), path):
                    if lines is None:
                        done = True
                        continue
                    ends = [x.removesuffix(b"\r") for x in lines]
                    flat = pa.array([y for x in ends for y in x.split(b"\r")], pa.binary())
                    yield _batch(path, 0, size, flat, pa.array(np.zeros(len(flat), np.int64)), split, quoted)
                none = pa.nulls(1, pa.list_(pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([0], pa.int64()), pa.array([size], pa.int64()), pa.array([split.place], pa.int64()),
                     pa.array([0], pa.int64()), pa.nulls(1, pa.binary()), none, none, pa.nulls(1, pa.list_(pa.int64())), pa.array([done])],
                    names=["file_path", "start", "size", "place", "bytes", "line", "begins", "ends", "records", "done"],
                )

    return files.mapInArrow(run, _LINE.replace("line string", "line binary"))


@dataclass(frozen=True)
class Records:
    """What a scan found: its lines as written, and one row for each split and for each file.

    files: file_path, n_lines, n_records, whole, reason (null where the file can be used).
    """

    lines: DataFrame
    splits: DataFrame
    files: DataFrame

    def placed(self) -> DataFrame:
        """Lines of usable files with record_no, line_no, and whether a record begins and ends with them."""
        chosen = [F.get(c, F.col("_inside")).alias(c) for c in ("begins", "ends", "records")]
        usable = self.splits.where("usable").select("file_path", "start", "_inside", "_records", "_lines")
        rows = self.lines.where("line IS NOT NULL").join(usable, ["file_path", "start"])
        return rows.select("file_path", "place", "line", "_records", "_lines", *chosen).select(
            "file_path", (F.col("_lines") + F.col("place")).alias("line_no"),
            (F.col("_records") + F.col("records") - 1).alias("record_no"), "line", "begins", "ends",
        )

    def records(self) -> DataFrame:
        """(file_path, row_no, record): records with their 0-based number in the file. Blank lines are none."""
        rows = self.placed().where("NOT (line = '' AND ends)")
        alone = rows.where("begins AND ends").select("file_path", F.col("record_no").alias("row_no"), F.col("line").alias("record"))
        parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
        spans = rows.where("NOT (begins AND ends)").groupBy("file_path", F.col("record_no").alias("row_no")).agg(parts.alias("_parts"))
        return alone.unionByName(spans.select("file_path", "row_no", F.array_join(F.col("_parts.line"), "\n").alias("record")))


def read_records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, quoted: bool = True) -> Records:
    """Scans files once. Without quoted, every line is a record."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    both = _plain_lines(spark, paths, glob, quoted).unionByName(_packed_lines(spark, paths, glob, quoted))
    text = F.col("line").cast("string")
    first = (F.col("start") == 0) & (F.col("place") == 0)
    lines = written(both.withColumn("line", F.when(first, F.regexp_replace(text, "^﻿", "")).otherwise(text)))

    last = F.struct("ends", "records")
    splits = lines.groupBy("file_path", "start").agg(
        F.first("size").alias("size"), F.sum("bytes").alias("bytes"), F.bool_or("done").alias("done"),
        F.count("line").alias("n"), F.max_by(last, F.when(F.col("line").isNotNull(), F.col("place"))).alias("last"),
    )
    before = Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # The split as a function: the state at its end for both at its beginning.
    end_out, end_in = (F.when(F.get("last.ends", F.lit(s)), 0).otherwise(1) for s in (0, 1))
    splits = splits.withColumns({"_out": F.coalesce(end_out, F.lit(0)), "_in": F.when(F.col("last").isNull(), 1).otherwise(end_in)})
    splits = splits.withColumn("_turns", F.when((F.col("_out") == 1) & (F.col("_in") == 0), 1).otherwise(0))
    splits = splits.withColumn("_turned", F.coalesce(F.sum("_turns").over(before), F.lit(0)))
    fixed = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("state"), F.col("_turned").alias("turned")))
    splits = splits.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(before))
    state = F.coalesce("_fixed.state", F.lit(0)) + F.col("_turned") - F.coalesce("_fixed.turned", F.lit(0))
    splits = splits.withColumn("_inside", F.pmod(state, F.lit(2)))
    own = F.coalesce(F.get("last.records", F.col("_inside")), F.lit(0))
    splits = splits.withColumns({
        "_own": own,
        "_records": F.coalesce(F.sum(own).over(before), F.lit(0)),
        "_lines": F.coalesce(F.sum("n").over(before), F.lit(0)),
    })
    # The last line may lack its end, and a mark at the beginning (3 bytes) isn't part of a line.
    more = F.sum("bytes") - F.max("size")
    packed = F.col("file_path").rlike(PACKED)
    files = splits.groupBy("file_path").agg(
        F.sum("n").alias("n_lines"), F.sum("_own").alias("n_records"),
        F.when(F.bool_or(packed), F.bool_or("done")).otherwise(more.isin(-3, -2, 0, 1)).alias("whole"),
        F.max_by(F.when(F.col("_inside") == 0, F.col("_out")).otherwise(F.col("_in")), "start").alias("_open"),
    )
    reason = F.when(~F.col("whole"), F.lit("incomplete")).when(F.col("_open") == 1, F.lit("incomplete: open quote"))
    files = written(files.select("file_path", "n_lines", "n_records", "whole", reason.alias("reason")))
    usable = files.select("file_path", F.col("reason").isNull().alias("usable"))
    splits = splits.select("file_path", "start", "_inside", "_records", "_lines").join(usable, "file_path")
    return Records(lines, written(splits), files)
