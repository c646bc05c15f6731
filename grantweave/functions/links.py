"""Links from a record to outside pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantweave import fixed_values as fv


def _percent_encoded(text: Column) -> Column:
    """Percent-encoding that keeps ``/`` and ``~`` and writes a space as ``%20``."""
    encoded = F.url_encode(text)
    for written, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(written), F.lit(wanted))
    return encoded


def project_link(source: Column, code: Column) -> Column:
    """The project's own page, which only one source has."""
    return F.when(
        (source == fv.PROJECT_PAGE_SOURCE) & (F.coalesce(code, F.lit("")) != ""),
        F.concat(F.lit(fv.PROJECT_PAGE), code),
    )


def search_link(*terms: Column) -> Column:
    """A search for the given terms, cut at 120 characters before encoding."""
    words = F.concat_ws(" ", *[F.nullif(t, F.lit("")) for t in terms])
    head, tail = fv.PROJECT_SEARCH.split("{query}")
    return F.concat(F.lit(head), _percent_encoded(F.substring(words, 1, 120)), F.lit(tail))


def fiscal_link(code: Column) -> Column:
    """The fiscal record of a beneficiary, where a code is known."""
    return F.when(code != "", F.concat(F.lit(fv.FISCAL_PAGE), _percent_encoded(code)))
