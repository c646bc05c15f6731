"""Text to number, date and coordinate, tolerant: what does not parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.text import SPACE, let, strip_space

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def money(value: Column) -> Column:
    """``1.234.567,89 lei`` and ``1,234,567.89`` to a double.

    With both separators the last one is the decimal mark; a lone comma is a
    decimal mark; several dots alone are not a number.
    """
    return let(F.regexp_replace(value.cast("string"), r"[^0-9,.\-]", ""), _money)


def _money(text: Column) -> Column:
    comma, dot = F.instr(text, ","), F.instr(text, ".")
    last_comma = F.instr(F.reverse(text), ",")
    last_dot = F.instr(F.reverse(text), ".")
    number = (
        F.when((comma > 0) & (dot > 0) & (last_comma < last_dot), F.translate(text, ",.", "."))
        .when((comma > 0) & (dot > 0), F.translate(text, ",", ""))
        .otherwise(F.translate(text, ",", "."))
    )
    return _double(number)


def _date_as(text: Column, pattern: str, order: str) -> Column:
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, order).try_cast("date"))


def _short_year(text: Column) -> Column:
    pattern = r"^(\d{1,2})\.(\d{1,2})\.(\d{2})$"
    century = F.when(F.regexp_extract(text, pattern, 3) < "69", F.lit("20")).otherwise(F.lit("19"))
    return F.when(
        text.rlike(pattern),
        F.concat(century, F.regexp_replace(text, pattern, "$3-$2-$1")).try_cast("date"),
    )


_DMY_DOT = (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", "$3-$2-$1")
_DMY_SLASH = (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1")
_YMD_DASH = (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$2-$3")
_DMY_DASH = (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1")
_MDY_SLASH = (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2")
_YMD_SLASH = (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3")


def date(value: Column) -> Column:
    """Seven written formats on the first word, else a spreadsheet day number.

    Two-digit years below 69 are 20xx. Day numbers count from 1899-12-30 and
    must lie between 1 and 200000.
    """
    return let(strip_space(value.cast("string")), lambda text: _date(text, F.substring_index(text, " ", 1)))


def _date(text: Column, word: Column) -> Column:
    serial = _double(F.translate(text, ",", "."))
    days = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).try_cast("int"))
    return F.coalesce(
        _date_as(word, *_DMY_DOT),
        _date_as(word, *_DMY_SLASH),
        _date_as(word, *_YMD_DASH),
        _date_as(word, *_DMY_DASH),
        _date_as(word, *_MDY_SLASH),
        _short_year(word),
        _date_as(word, *_YMD_SLASH),
        F.when((serial > 1) & (serial < 200_000), days),
    )


def iso_date(value: Column) -> Column:
    """Date in the first ten characters, ``2024-03-01`` or ``20240301``."""
    head = F.substring(value, 1, 10)
    return F.coalesce(
        _date_as(head, r"^(\d{4})-(\d{2})-(\d{2})$", "$1-$2-$3"),
        _date_as(head, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    )


_LONG_DATE = r"(\d{1,2})\s+([a-zăîâșț]+)\s+(\d{4})"


def long_date(value: Column) -> Column:
    """``31 decembrie 2026 23:59``, ``31.12.2026``, ``31/12/2026`` or ISO."""
    return let(F.lower(strip_space(value)), _written_date)


def _written_date(text: Column) -> Column:
    month = F.regexp_extract(text, _LONG_DATE, 2)
    number = F.lit(None).cast("string")
    for name, index in fv.MONTHS.items():
        number = F.when(month == name, F.lit(str(index))).otherwise(number)
    written = F.concat_ws(
        "-", F.regexp_extract(text, _LONG_DATE, 3), number, F.regexp_extract(text, _LONG_DATE, 1)
    ).try_cast("date")
    head = F.substring(text, 1, 10)
    numeric = F.coalesce(
        _date_as(head, *_DMY_DOT), _date_as(head, *_DMY_SLASH), _date_as(head, *_YMD_DASH)
    )
    return F.when(month.isin(list(fv.MONTHS)), written).otherwise(numeric)


def call_amount(value: Column) -> Column:
    """``33.435.294 EUR`` to ``struct(amount, currency)``.

    Dots are thousands here, with or without a comma; a comma alone is not a
    number.
    """
    upper = F.upper(value)
    currency = (
        F.when(upper.contains("EUR"), F.lit("EUR"))
        .when(upper.contains("RON") | upper.contains("LEI"), F.lit("RON"))
    )
    digits = F.regexp_replace(value, "[^0-9,.]", "")
    number = F.when(
        digits.contains(",") & digits.contains("."), F.translate(digits, ",.", ".")
    ).otherwise(F.translate(digits, ".", ""))
    return F.struct(_double(number).alias("amount"), currency.alias("currency"))


def comma_decimal(value: Column) -> Column:
    """A number whose decimal mark may be a comma."""
    return _double(strip_space(F.translate(value.cast("string"), ",", ".")))


def lat_long(value: Column) -> Column:
    """``45.1,25.3`` to ``struct(latitude, longitude)``; both or neither."""
    latitude = _double(strip_space(F.substring_index(value, ",", 1)))
    longitude = _double(strip_space(F.regexp_extract(value, r"(?s)^[^,]*,(.*)$", 1)))
    both = latitude.isNotNull() & longitude.isNotNull()
    return F.struct(
        F.when(both, latitude).alias("latitude"), F.when(both, longitude).alias("longitude")
    )


def first_value(item: Column, field: str) -> Column:
    """A JSON field that may be a scalar or a list: the scalar, or the first
    element (null for an empty list)."""
    value = F.try_variant_get(item, f"$.{field}", "variant")
    return F.when(
        F.schema_of_variant(value).startswith("ARRAY"),
        F.try_variant_get(item, f"$.{field}[0]", "string"),
    ).otherwise(F.try_variant_get(item, f"$.{field}", "string"))


def clean_markup(value: Column) -> Column:
    """Text without tags and hard spaces, squeezed; blank becomes null."""
    text = F.replace(F.regexp_replace(value, "<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" "))
    return F.nullif(F.trim(F.regexp_replace(text, SPACE + "+", " ")), F.lit(""))


def typed_threshold(text: str) -> float:
    """A minimum amount as typed by a user (``1.000.000,50``); junk counts as 0."""
    try:
        return float(text.replace(".", "").replace(",", "."))
    except ValueError:
        return 0.0
