"""All answers to one selection from one pass: options, buckets and KPIs of every facet.

Each row becomes one entry for each facet value that it has, and one for the whole. An entry of a facet
counts if all *other* filters hold, so a facet's options show what choosing them would give. One grouping
by facet and value (grouping sets, with lists unnested) then holds every answer; it is as small
as the facets' values and the beneficiaries, and is written once for all that ask it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave.operators.analytics import ProjectFilter
from grantweave.sources.staging import written

SCALARS = {"program": "program", "label": "software_label", "status": "status"}
LISTS = {"county": "counties", "region": "regions"}
#: Not facets, but grouped along: distinct beneficiaries, and the whole.
BENEFICIARY, WHOLE = "beneficiary", "all"


def _tests(where: ProjectFilter) -> tuple[dict[str, Column], ProjectFilter]:
    """Tests by facet, and the filter without the facets."""
    chosen = {f: getattr(where, f) for f in [*SCALARS, *LISTS] if getattr(where, f)}
    tests = {f: F.coalesce(F.col(c) == chosen[f], F.lit(False)) for f, c in SCALARS.items() if f in chosen}
    tests |= {f: F.coalesce(F.array_contains(c, chosen[f]), F.lit(False)) for f, c in LISTS.items() if f in chosen}
    rest = {k: v for k, v in vars(where).items() if k not in chosen}
    return tests, ProjectFilter(**rest)


def facet_counts(projects: DataFrame, where: ProjectFilter | None = None) -> DataFrame:
    """(facet, option, n, eligible, payments, software) of a selection, written.

    Null options are kept: categories show them, option lists don't.
    """
    tests, rest = _tests(where or ProjectFilter())

    def holds(but: str | None = None) -> Column:
        return reduce(Column.__and__, [t for f, t in tests.items() if f != but], F.lit(True))

    def entry(facet: str, option: Column) -> Column:
        return F.struct(F.lit(facet).alias("facet"), option.cast("string").alias("option"))

    def elements(facet: str, column: str) -> Column:
        return F.transform(F.array_distinct(column), lambda x: entry(facet, x))

    none = F.array().cast("array<struct<facet:string,option:string>>")
    whole = F.array(entry(WHOLE, F.lit(None)), entry(BENEFICIARY, F.col("beneficiary_key")))
    entries = [F.when(holds(), whole).otherwise(none)]
    entries += [F.when(holds(f), F.array(entry(f, F.col(c)))).otherwise(none) for f, c in SCALARS.items()]
    entries += [
        F.when(holds(f) & F.col(c).isNotNull(), elements(f, c)).otherwise(none) for f, c in LISTS.items()
    ]
    amounts = ["total_eligible_amount", "payments_amount", "is_software"]
    rows = rest.apply(projects).select(F.explode(F.flatten(F.array(*entries))).alias("e"), *amounts)
    return written(
        rows.groupBy("e.facet", "e.option").agg(
            F.count(F.lit(1)).alias("n"), F.sum("total_eligible_amount").alias("eligible"),
            F.sum("payments_amount").alias("payments"), F.count_if("is_software").alias("software"),
        )
    )


def options(counts: DataFrame, facet: str) -> DataFrame:
    """Sorted options of a facet, with the rows that choosing one gives."""
    return counts.where((F.col("facet") == facet) & (F.col("option") != "")).select("option", "n").orderBy("option")


def buckets(counts: DataFrame, facet: str, top: int = 12) -> DataFrame:
    """Largest eligible sums by category, in millions with one decimal; null reads —."""
    own = counts.where(F.col("facet") == facet).orderBy(F.desc_nulls_last("eligible"), F.asc_nulls_last("option")).limit(top)
    return own.select(
        F.coalesce("option", F.lit("—")).alias("name"), F.round(F.coalesce("eligible", F.lit(0.0)) / 1e6, 1).alias("value")
    )


def kpis(counts: DataFrame) -> DataFrame:
    """One row: rows, eligible and paid sums, distinct beneficiaries (null counts), software share."""
    whole = F.col("facet") == WHOLE

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(whole, F.col(name))), F.lit(0))

    return counts.where(F.col("facet").isin(WHOLE, BENEFICIARY)).agg(
        of("n").alias("rows"), of("eligible").cast("double").alias("eligible"), of("payments").cast("double").alias("payments"),
        F.count_if(F.col("facet") == BENEFICIARY).alias("beneficiaries"),
        F.coalesce(F.try_divide(of("software"), of("n")), F.lit(0.0)).alias("software_share"),
    )
