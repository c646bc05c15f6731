"""Closed lists from free text: counties, regions, project and call status."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.text import let, literal_map, one_of, plain_letters, slug


@dataclass(frozen=True)
class PlaceDictionary:
    """Names, codes and spellings of places and the regions they belong to."""

    counties: dict[str, tuple[str, str]] = field(default_factory=lambda: fv.COUNTIES)
    spellings: dict[str, str] = field(default_factory=lambda: fv.COUNTY_SPELLINGS)
    regions: dict[str, str] = field(default_factory=lambda: fv.REGION_PATTERNS)
    national: str = fv.NATIONAL
    national_markers: tuple[str, ...] = tuple(fv.NATIONAL_MARKERS)


def _plain(name: str) -> str:
    form = unicodedata.normalize("NFKD", name)
    return "".join(c for c in form if not unicodedata.combining(c)).lower()


def _spelled(places: PlaceDictionary) -> list[tuple[str, str]]:
    """Names and spellings with their counties, with single spaces for hyphens."""
    known = [*((c, c) for c in places.counties), *((s, c) for s, c in places.spellings.items() if c in places.counties)]
    return [(" ".join(re.split("[ -]", _plain(name))), county) for name, county in known]


def isolated_codes(original: Column) -> Column:
    """Two-letter codes: isolated capitals of the original text."""
    return F.regexp_extract_all(original, F.lit("(?<![A-Za-z])([A-Z]{2})(?![A-Za-z])"), 1)


def named_counties(plain: Column, codes: Column, places: PlaceDictionary) -> Column:
    """Sorted counties a text names in full, by another spelling, or by code.

    One pattern finds the longest name at each word; names that it begins with occur there too.
    """
    if not places.counties:
        return F.array().cast("array<string>")
    spelled = _spelled(places)
    by_name = {t: sorted({c for s, c in spelled if f"{t} ".startswith(f"{s} ")}) for t, _ in spelled}
    by_code = {k: [c for c, (code, _) in places.counties.items() if code == k] for k, _ in places.counties.values()}
    pattern = f"(?<![a-z])(?=({one_of(by_name).replace(' ', '[ -]')})(?![a-z]))"
    names = F.transform(F.regexp_extract_all(plain, F.lit(pattern), F.lit(1)), lambda n: F.translate(n, "-", " "))
    found = F.transform(F.array_distinct(names), lambda n: F.element_at(literal_map(by_name), n))
    coded = F.transform(codes, lambda c: F.element_at(literal_map(by_code), c))
    return F.array_sort(F.array_distinct(F.flatten(F.array_compact(F.concat(found, coded)))))


def or_national(named: Column, plain: Column, places: PlaceDictionary) -> Column:
    """The named counties; with none and a marker of the whole country, the one
    national entry."""
    national = F.lit(False)
    for marker in places.national_markers:
        national = national | plain.contains(marker)
    return F.when((F.size(named) == 0) & national, F.array(F.lit(places.national))).otherwise(named)


def regions_of(counties: Column, places: PlaceDictionary) -> Column:
    """Sorted regions the counties belong to; unknown names are ignored."""
    if not places.counties:
        return F.array().cast("array<string>")
    region = literal_map({county: region for county, (_, region) in places.counties.items()})
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(counties, lambda c: F.element_at(region, c)))))


def regions_in(plain: Column, places: PlaceDictionary) -> Column:
    """Sorted regions named directly in a text without diacritics."""
    found = [
        F.when(plain.rlike(pattern), F.lit(region)) for region, pattern in places.regions.items()
    ]
    return F.array_sort(F.array_compact(F.array(*found)))


def with_places(
    df: DataFrame,
    columns: tuple[str, ...] = ("county", "region", "locality"),
    places: PlaceDictionary | None = None,
) -> DataFrame:
    """Adds ``counties`` and ``regions``; regions are read from the text only
    where no county gives one."""
    places = places or PlaceDictionary()
    present = [F.nullif(F.col(c), F.lit("")) for c in columns if c in df.columns]
    if not present:
        return df

    def of_text(text: Column) -> Column:
        return let(F.lower(plain_letters(text)), lambda plain: let(
            named_counties(plain, isolated_codes(text), places), lambda named: of_names(named, plain)
        ))

    def of_names(named: Column, plain: Column) -> Column:
        owned = regions_of(named, places)
        regions = F.when(F.size(named) > 0, owned).otherwise(regions_in(plain, places))
        return F.struct(or_national(named, plain, places).alias("counties"), regions.alias("regions"))

    return (
        df.withColumn("_places", let(F.concat_ws(" ", *present), of_text))
        .withColumn("counties", F.col("_places.counties"))
        .withColumn("regions", F.col("_places.regions"))
        .drop("_places")
    )


def status_of(key: Column, rules: list[tuple[str, str]] | None = None, unknown: str = fv.STATUS_UNKNOWN) -> Column:
    """First rule whose fragment is in the slug ``key``."""
    chain = F.when(key == "", F.lit(unknown))
    for fragment, status in fv.STATUS_RULES if rules is None else rules:
        chain = chain.when(key.contains(fragment), F.lit(status))
    return chain.otherwise(F.lit(unknown))


def with_status(
    df: DataFrame,
    column: str = "project_status",
    rules: list[tuple[str, str]] | None = None,
    unknown: str = fv.STATUS_UNKNOWN,
) -> DataFrame:
    """Adds ``status`` from a raw status column, which stays as published."""
    found = let(slug(F.col(column)), lambda key: status_of(key, rules, unknown))
    return df.withColumn("status", found)


def call_status(opens: Column, closes: Column, continuous: Column, as_of: Column) -> Column:
    """Closed, upcoming or active by the two dates; without them, only an open-ended call is active."""
    return (
        F.when(closes < as_of, F.lit(fv.CALL_CLOSED))
        .when(opens > as_of, F.lit(fv.CALL_UPCOMING))
        .when(closes >= as_of, F.lit(fv.CALL_ACTIVE))
        .when(continuous & (opens.isNull() | (opens <= as_of)), F.lit(fv.CALL_ACTIVE))
        .otherwise(F.lit(fv.CALL_UNKNOWN))
    )


def days_left(closes: Column, as_of: Column) -> Column:
    """Days to the deadline; null when there is none or it has passed."""
    left = F.date_diff(closes, as_of)
    return F.when(left >= 0, left)
