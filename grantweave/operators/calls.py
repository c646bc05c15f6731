"""Calls: joins of list items with their pages and taxonomies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions import html
from grantweave.functions.places import call_status


def page_details(pages: DataFrame, slug: str = "slug", page: str = "html") -> DataFrame:
    """One row per page with the fields of a call page."""
    text = pages.withColumn("_text", html.plain_text(F.col(page)))
    fields = html.call_page(F.col("_text"), F.col(page))
    return text.select(slug, *[c.alias(f"page_{name}") for name, c in fields.items()])


def taxonomy_names(
    items: DataFrame, terms: DataFrame, key: str, taxonomies: dict[str, str] | None = None
) -> DataFrame:
    """The key and the names of ``with_names``."""
    fields = (taxonomies or fv.TAXONOMIES).values()
    return with_names(items, terms, taxonomies).select(key, *fields)


def with_names(items: DataFrame, terms: DataFrame, taxonomies: dict[str, str] | None = None) -> DataFrame:
    """Per item and taxonomy the names of its term ids, in order; unknown and
    blank names drop out. ``terms`` has (taxonomy, id, name).

    The terms are closed lists, so they travel as one map; no row is shuffled.
    """
    taxonomies = taxonomies or fv.TAXONOMIES
    term = F.concat_ws(":", "taxonomy", "id")
    known = terms.where(F.col("name") != "").groupBy(term.alias("term")).agg(F.min("name").alias("name"))
    # One row even without terms.
    names = known.agg(F.map_from_entries(F.collect_list(F.struct("term", "name")))).scalar()

    def named(taxonomy: str) -> Column:
        ids = F.coalesce(F.col(taxonomy), F.array().cast("array<bigint>"))
        found = F.transform(
            ids, lambda i: F.try_element_at("_names", F.concat(F.lit(f"{taxonomy}:"), i.cast("string")))
        )
        return F.array_compact(found)

    return items.withColumn("_names", names).withColumns(
        {field: named(name) for name, field in taxonomies.items()}
    ).drop("_names")


def page_list_fallback(listed: Column, on_page: Column) -> Column:
    """The item's own list, or the page's where that is empty; never null."""
    empty = F.array().cast("array<string>")
    return F.when(F.size(F.coalesce(listed, empty)) > 0, listed).otherwise(
        F.coalesce(on_page, listed, empty)
    )


def call_rows(
    items: DataFrame, terms: DataFrame, details: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Call items with names and page fields. ``items`` hold one row per call id."""
    as_of = F.current_date() if as_of is None else as_of
    joined = with_names(items, terms).join(details, "slug", "left")
    url = F.concat(F.lit(f"{fv.CALL_SITE}/apel/"), F.coalesce("slug", F.lit("None")), F.lit("/"))
    continuous = F.coalesce(F.col("page_continuous"), F.lit(False))
    empty = F.array().cast("array<string>")

    def with_fallback(field: str) -> Column:
        column = f"page_{field}"
        on_page = F.col(column) if column in joined.columns else F.lit(None).cast("array<string>")
        return page_list_fallback(F.col(field), on_page)

    return joined.select(
        F.col("id").cast("string").alias("call_id"),
        html.title_text(F.col("title.rendered")).alias("title"),
        url.alias("url"),
        F.col("link").alias("external_url"),
        F.coalesce("page_programs", empty).alias("programs"),
        F.col("page_specific_objective").alias("specific_objective"),
        F.col("page_call_type").alias("call_type"),
        call_status(F.col("page_opens_at"), F.col("page_closes_at"), continuous, as_of).alias("status"),
        F.col("page_opens_at").alias("opens_at"),
        F.col("page_closes_at").alias("closes_at"),
        continuous.alias("continuous"),
        F.col("page_budget_amount").alias("budget_amount"),
        F.col("page_budget_currency").alias("budget_currency"),
        *[with_fallback(field).alias(field) for field in fv.TAXONOMIES.values()],
        F.coalesce("page_documents", empty).alias("documents"),
        F.col("date").alias("published_at"),
        F.col("modified").alias("modified_at"),
        "source",
        url.alias("source_url"),
        "fetched_at",
    )
