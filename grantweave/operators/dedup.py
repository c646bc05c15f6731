"""Row identity, merging of repeated publications, and keep-one-per-key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.text import company_key, record_id


def add_identity(df: DataFrame, mode: str = "literal") -> DataFrame:
    """Adds ``record_id`` (source, file, row) and ``beneficiary_key``."""
    return df.withColumns(
        {
            "record_id": record_id(F.col("source"), F.col("source_file"), F.col("source_row")),
            "beneficiary_key": company_key(F.col("beneficiary_name"), mode),
        }
    )


def latest_first(text: Column) -> Column:
    """A sort key that puts later texts first when sorted ascending.

    Flips the digits of the bytes' hex form; the end mark keeps a prefix after
    the longer texts it begins.
    """
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def _slot(columns: Sequence[str | Column]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS))


def _dealing(df: DataFrame, columns: Sequence[str | Column], rows_per_task: int) -> tuple[int | None, list[int]]:
    """Tasks among which rows are dealt, none if one would do, and the slots that are too large for that."""
    counts = dict(map(tuple, df.groupBy(_slot(columns).alias("slot")).count().collect()))
    total = sum(counts.values())
    if total <= rows_per_task:
        return None, []
    conf = df.sparkSession.conf
    tasks = max(-(-total // rows_per_task), int(conf.get("spark.sql.shuffle.partitions")))
    direct = int(conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    tasks = min(tasks, max(direct, -(-total // (MORE_ROWS * rows_per_task))))
    return tasks, sorted(s for s, n in counts.items() if n > rows_per_task)


#: Rows that a task merges when rows are dealt by key, and the slots in which rows are counted before.
ROWS_PER_TASK = 250_000
#: How many times as many it may get before there are more tasks than Spark writes to straight away: with more,
#: a map task holds and sorts its rows first, and spills what doesn't fit.
MORE_ROWS = 5
SLOTS = 65_536


def merge_duplicates(
    df: DataFrame,
    key: Sequence[str | Column],
    sequence: Sequence[str],
    latest: str = "fetched_at",
    fill: Sequence[str] = tuple(fv.MERGED_FIELDS),
    wanted: Sequence[str] | None = None,
    deal_by: Sequence[str | Column] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per key: the latest by ``latest`` (undated first), its gaps in
    ``fill`` closed with the first known value in input order (``sequence``).
    ``wanted`` names the columns to return, all if not given; no others are shuffled.

    Both are plain aggregates, so each map task sends at most one row per key
    and a key that holds a third of the input costs no more than any other.

    ``deal_by`` names parts of the key that are cheap to read. Rows are then counted by slots of their hash;
    those of slots with at most ``rows_per_task`` rows are shuffled as they are and merged by the task they
    reach, as keys with few rows gain nothing from partial aggregates, which repeat each row's place for every
    fill. Larger slots, which may hold one large key, are merged by partial aggregates as without ``deal_by``.
    ``prepare`` adds columns that are read off a row, parts of the key too; rows are dealt without them and
    without the order, so only what these are made of is shuffled.
    """
    prepare = prepare or (lambda rows: rows)
    known = prepare(df).columns
    columns = known if wanted is None else [c for c in known if c in wanted]
    # A key that is a column comes out as it went in, so filters on it reach the scan.
    plain = {k: f"_key_{i}" for i, k in enumerate(key) if isinstance(k, str)}
    fill = [c for c in fill if c in columns and c not in plain]
    keys = [F.col(k) if isinstance(k, str) else k for k in key]
    # Order and row are made once below the aggregate; a place travels inside the order.
    rest = [c for c in columns if c not in plain and c not in sequence]
    order = F.struct(
        F.col(latest).isNotNull().alias("dated"), latest_first(F.col(latest)).alias("late"), F.struct(*sequence).alias("place")
    )
    place = F.col("_order.place")

    def given(c: str) -> Column:
        return F.col(f"_order.place.{c}" if c in sequence else f"_rest_{c}")

    row = [c for c in columns if c not in plain]
    chosen = [F.min_by(F.struct(*[given(c).alias(c) for c in row]), F.col("_order")).alias("_row")] if row else []
    first_known = [F.min_by(given(c), F.when(given(c).isNotNull(), place)).alias(f"_fill_{c}") for c in fill]
    names = [f"_key_{i}" for i in range(len(keys))]

    def aggregated(part: DataFrame, tasks: int | None = None) -> DataFrame:
        # A hash of parts of the key: rows grouped by it too stay where they are, and are sorted by a number first.
        dealt = ["_deal"] if tasks else []
        if tasks:
            part = part.withColumn("_deal", F.hash(*deal_by)).repartition(tasks, "_deal")
        rows = prepare(part).select(
            *dealt, *[k.alias(n) for k, n in zip(keys, names, strict=True)], order.alias("_order"), *[F.col(c).alias(f"_rest_{c}") for c in rest]
        )
        grouped = rows.groupBy(*dealt, *names)
        merged = grouped.agg(*chosen, *first_known) if row else grouped.agg(F.lit(0).alias("_row"))
        return merged.drop(*dealt)

    tasks, large = _dealing(df, deal_by, rows_per_task) if deal_by else (None, [])
    if large:
        slot = _slot(deal_by)
        merged = aggregated(df.where(~slot.isin(large)), tasks).unionByName(aggregated(df.where(slot.isin(large))))
    else:
        merged = aggregated(df, tasks)
    return merged.select(
        *[
            F.col(plain[c]).alias(c)
            if c in plain
            else F.coalesce(F.col(f"_row.{c}"), F.col(f"_fill_{c}")).alias(c)
            if c in fill
            else F.col(f"_row.{c}").alias(c)
            for c in columns
        ]
    )


SEQUENCE = ("source", "is_manual", "source_file", "source_row", "record_id")


def deduplicate(
    df: DataFrame, blanks_are_missing: bool = False, wanted: Sequence[str] | None = None, sequence: Sequence[str] = SEQUENCE,
    rows_per_task: int = ROWS_PER_TASK, identity: str | None = None,
) -> DataFrame:
    """One row per (program, code, beneficiary) of a registry with identity,
    with all columns or those ``wanted``. Rows without one get it in the mode
    ``identity``, where they are merged, so it isn't shuffled.

    Without a code the title stands in, then the row's own id. By default a
    blank code is a code; ``blanks_are_missing`` treats blank text as missing.
    """

    def text(name: str) -> Column:
        return F.nullif(F.trim(F.col(name)), F.lit("")) if blanks_are_missing else F.col(name)

    if blanks_are_missing:
        texts = [c for c in fv.MERGED_FIELDS if dict(df.dtypes).get(c) == "string"]
        df = df.withColumns({c: text(c) for c in texts})
    added = "is_manual" not in df.columns
    if added:
        by_hand = F.coalesce(F.col("source_url").startswith("manual:"), F.lit(False))
        df = df.withColumn("is_manual", by_hand)
    own = record_id(F.col("source"), F.col("source_file"), F.col("source_row")) if identity else F.col("record_id")
    code = F.coalesce(text("project_code"), text("project_title"), own)
    merged = merge_duplicates(
        df, ["program", code, "beneficiary_key"], sequence, wanted=wanted, deal_by=["program", code], rows_per_task=rows_per_task,
        prepare=(lambda rows: add_identity(rows, identity)) if identity else None,
    )
    return merged.drop("is_manual") if added else merged


def project_key(df: DataFrame) -> Column:
    """A key that survives re-publication, unlike the row's id."""
    parts = [
        F.coalesce(F.col(c), F.lit("")) for c in ("program", "project_code", "beneficiary_key")
    ]
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def keep_top(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. Spark cuts each key to ``n`` rows before
    the shuffle too, so a hot key stays small."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
