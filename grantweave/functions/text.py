"""Text keys: plain letters, slugs, company keys, fiscal codes, record ids."""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantweave import fixed_values as fv

# Everything Python calls white space, for Java patterns.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_HANGUL = range(0xAC00, 0xD7A4)
_SURROGATES = range(0xD800, 0xE000)


#: Letters and marks below these are common: Latin with its extensions, and combining marks.
_COMMON_LETTERS, _COMMON_MARKS = "\u0250", "\u0370"


@lru_cache(maxsize=1)
def _plain_letter_tables() -> tuple[str, str, dict[str, str]]:
    """Characters with a one-letter plain form, those forms, and the longer forms.

    Hangul syllables stay composed: they have no Latin form, so no key changes.
    """
    letters, marks, plain, longer = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if code in _SURROGATES or code in _HANGUL:
            continue
        char = chr(code)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        form = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if form == char:
            continue
        if len(form) == 1:
            letters.append(char)
            plain.append(form)
        else:
            longer[char] = form
    return "".join(letters + marks), "".join(plain), longer


def _char_class(chars: list[str]) -> str:
    """A Java character class over ``chars`` written as code point ranges."""
    codes = sorted(ord(c) for c in chars)
    spans: list[list[int]] = []
    for code in codes:
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def one_of(texts: Iterable[str]) -> str:
    """A pattern for any of some literal texts, the longest that fits first; texts are told apart by their first characters."""
    groups: dict[str, list[str]] = {}
    for t in sorted(set(texts), key=lambda t: (-len(t), t)):
        groups.setdefault(t[:1], []).append(t)

    def quoted(t: str) -> str:
        return re.sub(r"([^A-Za-z0-9 ])", r"\\\1", t)

    def some_of(group: list[str]) -> str:
        shared = os.path.commonprefix(group)
        return quoted(shared) + (f"(?:{one_of(t[len(shared):] for t in group)})" if len(group) > 1 else "")

    # The empty text fits everywhere, so it comes last.
    return "|".join(some_of(groups[c]) for c in sorted(groups, key=lambda c: (not c, c)))


def literal_map(values: Mapping[str, str | list]) -> Column:
    """A closed list as a constant: what belongs to each text."""
    given = [F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v) for v in values.values()]
    return F.create_map(*[c for k, v in zip(values, given, strict=True) for c in (F.lit(k), v)])


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def plain_letters(text: Column) -> Column:
    """Text without diacritics (compatibility decomposition, marks dropped).

    ASCII rows pass through untouched; the rest goes through a ``translate`` of common letters, where others are
    left through one of all (Spark compares its whole table for each row) and, only where a ligature or the like
    is left, a per-character lookup.
    """
    source, target, longer = _plain_letter_tables()
    common = {c: t for c, t in zip(source, target) if c < _COMMON_LETTERS}
    marks = "".join(c for c in source[len(target):] if c < _COMMON_MARKS)
    # The look-ahead rejects ASCII before the long class is tried.
    rare = r"(?=[^\x00-\x7f])" + _char_class(list(longer))
    forms = F.from_json(F.lit(json.dumps(longer)), "map<string,string>")

    def expanded(line: Column) -> Column:
        pieces = F.split(line, f"(?={rare})|(?<={_char_class(list(longer))})")
        return F.array_join(
            F.transform(
                pieces,
                lambda p: F.when(F.length(p) == 1, F.coalesce(F.try_element_at(forms, p), p)).otherwise(p),
            ),
            "",
        )

    def uncommon(text: Column) -> Column:
        return let(
            F.translate(text, source, target),
            lambda line: F.when(is_ascii(line) | ~line.rlike(rare), line).otherwise(expanded(line)),
        )

    return F.when(is_ascii(text), text).otherwise(
        let(
            F.translate(text, "".join(common) + marks, "".join(common.values())),
            lambda line: F.when(is_ascii(line), line).otherwise(uncommon(line)),
        )
    )


def slug(text: Column) -> Column:
    """Lower-case plain letters and digits, single spaces; null becomes ''."""
    cleaned = F.regexp_replace(F.lower(plain_letters(text)), "[^a-z0-9]+", " ")
    return F.coalesce(F.trim(cleaned), F.lit(""))


def squeeze(text: Column) -> Column:
    """Single spaces, trimmed; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(text, SPACE + "+", " ")), F.lit(""))


def strip_space(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def company_key(name: Column, mode: str = "literal", legal_forms: list[str] | None = None) -> Column:
    """Matching key of a company name: slug without legal form.

    ``literal`` drops the tokens sc, s and c anywhere and then one-word legal
    forms from the end, so ``S.C. ACME S.R.L.`` gives ``acme r l``.
    ``intended`` also knows spelled-out forms, so the same name gives ``acme``.
    """
    forms = "|".join(fv.LEGAL_FORMS if legal_forms is None else legal_forms)
    noise = "|".join(fv.COMPANY_NOISE_TOKENS)
    key = slug(name)
    if mode == "intended":
        spelled = "|".join(fv.SPELLED_LEGAL_FORMS)
        key = F.regexp_replace(key, f"(?:(?:^| )(?:{spelled}|{forms}))+$", "")
    elif mode != "literal":
        raise ValueError(f"unknown mode {mode!r}")
    key = F.trim(F.regexp_replace(key, f"(?:^| )(?:{noise})(?= |$)", ""))
    return F.trim(F.regexp_replace(key, f"(?:(?:^| )(?:{forms}))+$", ""))


def fiscal_code(value: Column) -> Column:
    """Digits of a fiscal code without prefix and leading zeros, else null."""
    text = strip_space(value.cast("string"))
    digits = F.regexp_extract(F.translate(text, ".,", ""), r"(?iU)\b(?:ro)?\s?(\d{2,10})\b", 1)
    code = F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit(""))
    return F.when(~F.lower(text).isin("", "nan", "none", "-"), code)


def record_id(source: Column, source_file: Column, source_row: Column) -> Column:
    """First 16 hex digits of SHA-1 over ``source|file|row``; null reads ``None``."""
    parts = [F.coalesce(c.cast("string"), F.lit("None")) for c in (source, source_file, source_row)]
    joined = F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2])
    return F.substring(F.sha1(joined), 1, 16)
