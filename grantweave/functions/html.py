"""Fields out of raw web pages, as column expressions over the whole page."""

from __future__ import annotations

import html
import html.entities
import json
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.parse import call_amount, long_date
from grantweave.functions.text import SPACE, let, strip_space

_ENTITY = r"^(#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;?)"


@lru_cache(maxsize=1)
def _entity_tables() -> tuple[str, str, list[int]]:
    """Named entities by first letter, odd numeric ones, lengths of bare names."""
    names: dict[str, dict[str, str]] = {}
    for name, value in html.entities.html5.items():
        names.setdefault(name[0], {})[name] = value
    odd = {
        str(code): html.unescape(f"&#{code};")
        for code in [*range(0, 160), *range(0xFDD0, 0xFDF0)]
        if html.unescape(f"&#{code};") != chr(code)
    }
    for plane in range(0x11):
        for code in (plane * 0x10000 + 0xFFFE, plane * 0x10000 + 0xFFFF):
            odd[str(code)] = ""
    bare = sorted({len(n) for n in html.entities.html5 if not n.endswith(";")}, reverse=True)
    return json.dumps(names), json.dumps(odd), bare


def unescape(text: Column) -> Column:
    """Character references decoded once, as browsers do (``&amp;lt;`` -> ``&lt;``).

    Works on the pieces between ampersands, only for rows that have one.
    """
    names_json, odd_json, bare = _entity_tables()
    names = F.from_json(F.lit(names_json), "map<string,map<string,string>>")
    odd = F.from_json(F.lit(odd_json), "map<string,string>")

    def numeric(token: Column) -> Column:
        digits = F.regexp_extract(token, "^#[xX]?0*([0-9a-fA-F]*)", 1)
        is_hex = F.substring(token, 2, 1).isin("x", "X")
        # Ten digits are past the last character in either base.
        code = F.when(F.length(digits) > 9, F.lit("9999999999")).when(digits == "", F.lit("0"))
        code = code.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)
        whole = code.try_cast("bigint")
        bad = whole.isNull() | (whole > 0x10FFFF) | whole.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(whole), 8, "0")), "UTF-32")
        return F.when(bad, F.lit("\ufffd")).otherwise(
            F.coalesce(F.try_element_at(odd, whole.cast("string")), char)
        )

    def named(token: Column, piece: Column) -> Column:
        # The whole token, else the longest name known without a semicolon.
        def longest(table: Column) -> Column:
            tries = [token, *[F.substring(token, 1, size) for size in bare]]
            known = F.filter(F.array(*tries), lambda t: F.map_contains_key(table, t))
            return let(
                F.get(known, F.lit(0)),
                lambda t: F.when(t.isNull(), F.concat(F.lit("&"), piece)).otherwise(
                    _after_token(F.try_element_at(table, t), t, piece)
                ),
            )

        letter = F.try_element_at(names, F.substring(token, 1, 1))
        return F.coalesce(let(letter, longest), F.concat(F.lit("&"), piece))

    def decoded(piece: Column, index: Column) -> Column:
        token = F.regexp_extract(piece, _ENTITY, 1)
        return (
            F.when(index == 0, piece)
            .when(piece.startswith("amp;"), F.concat(F.lit("&"), F.substring(piece, 5, 2147483647)))
            .when(token == "", F.concat(F.lit("&"), piece))
            .when(token.startswith("#"), _after_token(numeric(token), token, piece))
            .otherwise(named(token, piece))
        )

    return F.when(
        text.contains("&"), F.array_join(F.transform(F.split(text, "&"), decoded), "")
    ).otherwise(text)


def _after_token(value: Column, token: Column, piece: Column) -> Column:
    """``value`` followed by what is left of ``piece`` after ``token``."""
    return F.concat(value, F.substring(piece, F.length(token) + 1, F.length(piece)))


def plain_text(page: Column) -> Column:
    """A page as text with ``|`` where elements begin and end."""
    text = F.regexp_replace(page, r"(?s)<script.*?</script>", " ")
    text = F.regexp_replace(text, r"(?s)<style.*?</style>", " ")
    text = F.regexp_replace(text, "<[^>]+>", "|")
    text = unescape(F.regexp_replace(text, r"[ \t\xa0]+", " "))
    # A run of bars and spaces with at least one bar becomes one bar. The
    # look-behind and possessive loops keep this linear on long runs.
    return F.regexp_replace(text, rf"(?<!{SPACE}){SPACE}*+\|[|{SPACE[1:]}*+", "|")


def _after_label(text: Column, label: str, width: int) -> Column:
    return F.substring(text, F.instr(text, label) + F.lit(len(label)), F.lit(width))


def value_after(text: Column, label: str, width: int = 260) -> Column:
    """First non-empty piece within ``width`` characters after a label, else null."""
    piece = F.regexp_extract(_after_label(text, label, width), rf"^[|{SPACE[1:]}*+([^|]+)", 1)
    return F.when(F.instr(text, label) > 0, F.nullif(strip_space(piece), F.lit("")))


def list_after(
    text: Column, label: str, stops: list[str], noise: list[str] | None = None, width: int = 1200,
    most: int = 20,
) -> Column:
    """Items listed after a label, up to the next section: distinct in reading
    order, longer than two characters, the first ``most`` of them."""
    tail = _after_label(text, label, width)
    for stop in stops:
        # A stop marker at the very start does not cut.
        tail = F.when(F.instr(tail, stop) > 1, F.substring_index(tail, stop, 1)).otherwise(tail)
    items = F.transform(
        F.split(tail, "[|,]"), lambda x: F.regexp_replace(x, "^[ .:;]+|[ .:;]+$", "")
    )
    dropped = fv.PAGE_LIST_NOISE if noise is None else noise
    kept = F.filter(items, lambda x: (F.length(x) > 2) & ~F.lower(x).isin(dropped))
    listed = F.slice(F.array_distinct(kept), 1, most)
    return F.when(F.instr(text, label) > 0, listed).otherwise(
        F.array().cast("array<string>")
    )


def links(page: Column, pattern: str = fv.PAGE_PDF_LINK, limit: int = 10) -> Column:
    """Sorted distinct link targets, the first ten."""
    found = F.regexp_extract_all(page, F.lit(pattern), 1)
    return F.slice(F.array_sort(F.array_distinct(found)), 1, limit)


def title_text(markup: Column) -> Column:
    """A title without tags, decoded, trimmed; null becomes ''."""
    text = strip_space(unescape(F.regexp_replace(markup, "<[^>]+>", "")))
    return F.coalesce(text, F.lit(""))


def call_page(text: Column, page: Column) -> dict[str, Column]:
    """The eleven fields of a call page from its plain text and raw markup."""
    budget = call_amount(value_after(text, fv.PAGE_BUDGET))
    call_type = value_after(text, fv.PAGE_CALL_TYPE, 200)
    program = value_after(text, fv.PAGE_PROGRAMS, 300)
    return {
        "specific_objective": value_after(text, fv.PAGE_OBJECTIVE, 400),
        "call_type": call_type,
        "budget_amount": budget["amount"],
        "budget_currency": budget["currency"],
        "opens_at": long_date(value_after(text, fv.PAGE_OPENS)),
        "closes_at": long_date(value_after(text, fv.PAGE_CLOSES)),
        "continuous": F.coalesce(
            F.lower(call_type).contains(fv.PAGE_NO_DEADLINE), F.lit(False)
        ),
        "programs": F.array_compact(F.array(program)),
        "beneficiaries": list_after(text, fv.PAGE_BENEFICIARIES, fv.PAGE_BENEFICIARIES_END),
        "domains": list_after(text, fv.PAGE_DOMAINS, fv.PAGE_DOMAINS_END),
        "documents": links(page),
    }
