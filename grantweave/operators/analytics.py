"""Roll-ups, KPIs, top lists, facets, pages and fact rows of the registry."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.parse import typed_threshold


def _sum0(column: Column) -> Column:
    """A sum that is 0, not null, over nothing."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def _distinct_with_null(column: str) -> list[Column]:
    return [F.countDistinct(column).alias("_known"), F.max(F.col(column).isNull()).alias("_gap")]


def _fold_distinct(df: DataFrame, name: str) -> DataFrame:
    """Distinct values, null counted as one."""
    gap = F.coalesce(F.col("_gap"), F.lit(False)).cast("bigint")
    return df.withColumn(name, F.col("_known") + gap).drop("_known", "_gap")


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns side by side, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])


# -------------------------------------------------------------- aggregations


def beneficiary_rollup(projects: DataFrame) -> DataFrame:
    """Per beneficiary key: a name and code, projects, eligible and published EU
    sums, derived EU sum, software projects."""
    return projects.groupBy("beneficiary_key").agg(
        F.min("beneficiary_name").alias("beneficiary_name"),
        F.min("beneficiary_cui").alias("beneficiary_cui"),
        F.count(F.lit(1)).alias("proiecte"),
        F.sum("total_eligible_amount").alias("eligibil_total"),
        F.sum("eu_amount").alias("finantare_ue"),
        F.sum("eu_amount_derived").alias("finantare_ue_dedusa"),
        F.count_if(F.col("is_software")).alias("proiecte_software"),
    )


def registry_stats(projects: DataFrame) -> DataFrame:
    """One row: rows, distinct beneficiaries (null counts), first 12 programs by
    name, software projects, eligible total."""
    programs = projects.select("program").where("program IS NOT NULL").distinct()
    first = programs.orderBy("program").limit(12).agg(
        F.array_join(F.array_sort(F.collect_list("program")), ", ").alias("programs")
    )
    totals = projects.agg(
        F.count(F.lit(1)).alias("rows"),
        *_distinct_with_null("beneficiary_key"),
        F.count_if("is_software").alias("software"),
        _sum0(F.col("total_eligible_amount")).alias("eligible_total"),
    )
    return one_row(_fold_distinct(totals, "beneficiaries"), first)


def label_counts(df: DataFrame, label: str = "software_label", top: int | None = None) -> DataFrame:
    """Rows per label, most first."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(label))
    return counts if top is None else counts.limit(top)


def top_buckets(df: DataFrame, key: str, value: str, top: int = 12) -> DataFrame:
    """Largest sums per category, in millions with one decimal; null reads —."""
    total = F.sum(value)
    return (
        df.groupBy(key)
        .agg(total.alias("_total"))
        .orderBy(F.desc_nulls_last("_total"), F.asc_nulls_last(key))
        .limit(top)
        .select(
            F.coalesce(F.col(key).cast("string"), F.lit("—")).alias("name"),
            F.round(F.coalesce("_total", F.lit(0.0)) / 1e6, 1).alias("value"),
        )
    )


def project_kpis(projects: DataFrame) -> DataFrame:
    """One row: rows, eligible and paid sums, distinct beneficiaries, software share."""
    totals = projects.agg(
        F.count(F.lit(1)).alias("rows"),
        _sum0(F.col("total_eligible_amount")).alias("eligible"),
        _sum0(F.col("payments_amount")).alias("payments"),
        *_distinct_with_null("beneficiary_key"),
        F.coalesce(F.avg(F.col("is_software").cast("int")), F.lit(0.0)).alias("software_share"),
    )
    return _fold_distinct(totals, "beneficiaries")


def call_kpis(calls: DataFrame) -> DataFrame:
    """One row: calls, budget in euro, software calls."""
    return calls.agg(
        F.count(F.lit(1)).alias("calls"),
        _sum0(F.when(F.col("budget_currency") == "EUR", F.col("budget_amount"))).alias("budget_eur"),
        F.count_if("is_software").alias("software"),
    )


def build_totals(projects: DataFrame, calls: DataFrame) -> DataFrame:
    """One row: projects, software projects, calls, active calls."""
    left = projects.agg(F.count(F.lit(1)).alias("projects"), F.count_if("is_software").alias("software"))
    right = calls.agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("status") == fv.CALL_ACTIVE).alias("calls_active"),
    )
    return one_row(left, right)


def source_totals(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """Per source: files, bytes, extracted rows."""
    files = manifest.groupBy("source").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )
    counted = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    return files.join(counted, "source", "left").fillna(0, ["rows"])


# -------------------------------------------------------------------- facets


def facet_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, without null and empty ones."""
    return (
        df.select(F.col(column).cast("string").alias("option"))
        .where(F.col("option") != "")
        .distinct()
        .orderBy("option")
    )


def facet_options_array(df: DataFrame, column: str) -> DataFrame:
    """The same over the elements of a list column."""
    return facet_options(df.select(F.explode(column).alias(column)), column)


# Facets with a closed list of options, whatever the rows hold.
CLOSED_OPTIONS: dict[str, list[str]] = {
    "county": [fv.NATIONAL, *sorted(fv.COUNTIES)],
    "region": sorted({region for _, region in fv.COUNTIES.values()}),
    "status": fv.STATUSES,
}


@dataclass(frozen=True)
class ProjectFilter:
    """What a reader of the project registry may narrow down by."""

    search: str = ""
    program: str | None = None
    county: str | None = None
    region: str | None = None
    label: str | None = None
    status: str | None = None
    only_software: bool = False
    min_amount: str = ""
    quote_search: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        conditions = [
            F.col("is_software") if self.only_software else None,
            F.col("program") == self.program if self.program else None,
            F.array_contains("counties", self.county) if self.county else None,
            F.array_contains("regions", self.region) if self.region else None,
            F.col("software_label") == self.label if self.label else None,
            F.col("status") == self.status if self.status else None,
        ]
        needle = self.search.strip()
        if needle:
            conditions.append(
                text_matches(F.col("beneficiary_name"), needle, self.quote_search)
                | text_matches(F.coalesce("project_title", F.lit("")), needle, self.quote_search)
                | F.coalesce("beneficiary_cui", F.lit("")).contains(needle)
            )
        if self.min_amount.strip():
            conditions.append(at_least(F.col("total_eligible_amount"), self.min_amount))
        for condition in conditions:
            df = df if condition is None else df.where(condition)
        return df


@dataclass(frozen=True)
class CallFilter:
    """The same for calls; active ones by default."""

    search: str = ""
    status: str | None = fv.CALL_ACTIVE
    domain: str | None = None
    beneficiary: str | None = None
    only_software: bool = False
    min_budget: str = ""
    quote_search: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        conditions = [
            F.col("status") == self.status if self.status else None,
            F.col("is_software") if self.only_software else None,
            F.array_contains("domains", self.domain) if self.domain else None,
            F.array_contains("beneficiaries", self.beneficiary) if self.beneficiary else None,
        ]
        if self.min_budget.strip():
            conditions.append(at_least(F.col("budget_amount"), self.min_budget))
        if self.search.strip():
            conditions.append(text_matches(F.col("title"), self.search.strip(), self.quote_search))
        for condition in conditions:
            df = df if condition is None else df.where(condition)
        return df


def text_matches(text: Column, needle: str, quote: bool = False) -> Column:
    """Case-insensitive pattern search; ``quote`` searches the text as written."""
    wanted = r"\Q" + needle.replace(r"\E", r"\E\\E\Q") + r"\E" if quote else needle
    return text.rlike("(?iU)" + wanted)


def at_least(amount: Column, typed: str) -> Column:
    """Amount (null counts as 0) not below a typed threshold."""
    return F.coalesce(amount, F.lit(0.0)) >= F.lit(typed_threshold(typed))


# ------------------------------------------------------------ sorts and pages

PROJECT_SORTS = ("total_eligible_amount", "payments_amount", "software_score", "start_date")


def page_of_projects(
    projects: DataFrame, page: int = 0, sort: str = PROJECT_SORTS[0], size: int = fv.PAGE_SIZE,
    tie: str = "record_id",
) -> DataFrame:
    """One page, largest first, nulls last."""
    return projects.orderBy(F.desc_nulls_last(sort), F.asc(tie)).offset(page * size).limit(size)


def page_after(
    df: DataFrame, last: tuple | None = None, sort: str = PROJECT_SORTS[0], size: int = fv.PAGE_SIZE, tie: str = "record_id"
) -> DataFrame:
    """The page after a row, given by its (sort value, tie), largest first, nulls last; the first page without one.

    Earlier pages are filtered away, by a condition that reaches the scan, and not sorted again.
    """
    if last is not None:
        value, key = last
        own, name = F.col(sort), F.col(tie)
        after = own.isNull() & (name > key) if value is None else (own < value) | own.isNull() | ((own == value) & (name > key))
        if value is not None:
            # The same once more in a form that Parquet's statistics can judge.
            after = ((own <= value) | own.isNull()) & after
        df = df.where(after)
    return df.orderBy(F.desc_nulls_last(sort), F.asc(tie)).limit(size)


def page_of_calls(
    calls: DataFrame, page: int = 0, size: int = fv.PAGE_SIZE, closes: str = "closes_at",
    tie: Sequence[str] = ("call_id", "source"),
) -> DataFrame:
    """One page, nearest deadline first, no deadline last."""
    return calls.orderBy(F.asc_nulls_last(closes), *tie).offset(page * size).limit(size)


def search_projects(
    projects: DataFrame, where: ProjectFilter | None = None, page: int = 0, sort: str = PROJECT_SORTS[0]
) -> dict[str, DataFrame]:
    """All answers to one set of facets: the page, the number of pages, KPIs, and
    the largest programs and labels. Best asked of the published table, where the
    plain facets and each answer's columns reach the scan."""
    found = (where or ProjectFilter()).apply(projects)
    return {
        "page": page_of_projects(found, page, sort),
        "pages": page_count(found),
        "kpis": project_kpis(found),
        "programs": top_buckets(found, "program", "total_eligible_amount"),
        "labels": label_counts(found),
    }


def search_calls(calls: DataFrame, where: CallFilter | None = None, page: int = 0) -> dict[str, DataFrame]:
    """The same for calls: the page, the number of pages, KPIs."""
    found = (where or CallFilter()).apply(calls)
    return {"page": page_of_calls(found, page), "pages": page_count(found), "kpis": call_kpis(found)}


def page_count(df: DataFrame, size: int = fv.PAGE_SIZE) -> DataFrame:
    pages = F.ceil(F.count(F.lit(1)) / size)
    return df.agg(F.greatest(F.lit(1), pages).cast("bigint").alias("pages"))


def point_lookup(df: DataFrame, value: str | Column, key: str = "record_id") -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def closing_soon(
    calls: DataFrame, active: bool = False, software: bool = False, top: int = 40
) -> DataFrame:
    """Calls by deadline, optionally only active or only software ones."""
    if active:
        calls = calls.where(F.col("status") == fv.CALL_ACTIVE)
    if software:
        calls = calls.where("is_software")
    return calls.orderBy(F.asc_nulls_last("closes_at"), "call_id", "source").limit(top)


# ----------------------------------------------------------------- fact rows


# section -> (label, field), in display order: FIXED VALUES.
FACTS: dict[str, list[tuple[str, str]]] = {
    "date": [
        ("Program", "program"),
        ("Perioadă de programare", "programming_period"),
        ("Cod proiect", "project_code"),
        ("Beneficiar", "beneficiary_name"),
        ("CUI beneficiar", "beneficiary_cui"),
        ("Tip beneficiar", "beneficiary_type"),
        ("Județe", "counties"),
        ("Regiuni", "regions"),
        ("Localitate", "locality"),
        ("Dată de început", "start_date"),
        ("Dată de sfârșit", "end_date"),
        ("Stadiu", "project_status"),
        ("Valoare eligibilă", "total_eligible_amount"),
        ("Valoare totală", "total_project_amount"),
        ("Plăți efectuate", "payments_amount"),
        ("Rată de cofinanțare UE", "cofinancing_rate"),
        ("Obiectiv specific", "specific_objective"),
        ("Cod de intervenție", "intervention_code"),
    ],
    "clasificare": [
        ("Etichetă", "software_label"),
        ("Scor", "software_score"),
        ("Motivul scorului", "software_evidence"),
    ],
    "proveniență": [
        ("Sursă", "source"),
        ("Set de date", "source_dataset"),
        ("Fișier", "source_file"),
        ("Rând în fișier", "source_row"),
        ("Amprentă SHA-256", "source_sha256"),
        ("Descărcat la", "fetched_at"),
    ],
}


def fact_rows(
    df: DataFrame, key: str = "record_id", facts: dict[str, Sequence[tuple[str, str]]] | None = None
) -> DataFrame:
    """Each record as (section, label, value) rows; lists joined, empty reads —."""
    types = dict(df.dtypes)

    def shown(name: str) -> Column:
        column = F.col(name)
        text = F.array_join(column, ", ") if types[name].startswith("array") else column.cast("string")
        return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("—"))

    rows = [
        F.struct(F.lit(section).alias("section"), F.lit(label).alias("label"), shown(name).alias("value"))
        for section, pairs in (facts or FACTS).items()
        for label, name in pairs
        if name in types
    ]
    return df.select(key, F.posexplode(F.array(*rows)).alias("place", "fact")).select(
        key, "place", "fact.section", "fact.label", "fact.value"
    )
