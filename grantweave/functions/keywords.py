"""Keyword evidence: which dictionary phrases a text holds, and what they say."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.text import let, literal_map, one_of, slug


#: What is said of a text: ``software_score``, ``software_label``, ``software_evidence``.
PARTS = ("score", "label", "evidence")


@dataclass(frozen=True)
class KeywordDictionary:
    """Phrases with label and weight, phrases with penalty, and code signals."""

    keywords: list[tuple[str, str, float]] = field(default_factory=lambda: fv.KEYWORDS)
    negatives: list[tuple[str, float]] = field(default_factory=lambda: fv.NEGATIVE_KEYWORDS)


def phrase_pattern(phrase: str) -> str:
    """Pattern of a phrase on a slug with a space at either end.

    Long words match by stem with up to four more letters, short ones exactly.
    """
    words = [
        w if len(w) < fv.STEM_MIN_CHARS else f"{w[:-1]}[a-z]{{0,{fv.STEM_MAX_ENDING}}}"
        for w in phrase.split()
    ]
    return " " + " ".join(words) + " "


def _word_form(word: str) -> tuple[str, bool]:
    """What of a dictionary word must be there, and may letters follow?"""
    return (word, False) if len(word) < fv.STEM_MIN_CHARS else (word[:-1], True)


def _same_word(a: tuple[str, bool], b: tuple[str, bool]) -> bool:
    """Can one word of a text fit both of two different forms?"""
    (short, open_), (long, _) = sorted((a, b), key=lambda f: (len(f[0]), not f[1]))
    return a != b and open_ and long.startswith(short) and len(long) - len(short) <= fv.STEM_MAX_ENDING


def _apart(phrases: dict[int, str]) -> list[dict[int, list[tuple[str, bool]]]]:
    """Numbered phrases as forms of their words, in as few groups as found in which a word of a text fits one form only."""
    groups: list[dict[int, list[tuple[str, bool]]]] = []
    for number, phrase in phrases.items():
        forms = [_word_form(w) for w in phrase.split()]
        for group in [*groups, {}]:
            if not any(_same_word(f, o) for f in forms for known in group.values() for o in known):
                break
        if not group:
            groups.append(group)
        group[number] = forms
    return groups


def phrases_in(padded: Column, phrases: list[str], start: int = 1) -> Column:
    """Sorted numbers, from ``start``, of the phrases that the padded slug holds.

    One pattern cuts the endings of known words, so that phrases are fixed texts; another finds the longest phrase
    at each word, and the shorter ones it begins with are there too. Both are constants, nothing is compiled for a row.
    """
    found, mixed = [], {}
    for n, phrase in enumerate(phrases, start):
        forms = [_word_form(w) for w in phrase.split()]
        if any(_same_word(a, b) for a in forms for b in forms):
            mixed[n] = phrase_pattern(phrase)
    if mixed:  # one word of a text fits several words of the phrase
        found.append(F.array_compact(F.array(*[F.when(padded.rlike(p), F.lit(n)) for n, p in mixed.items()])))
    for group in _apart({n: k for n, k in enumerate(phrases, start) if n not in mixed}):
        stems = {f for forms in group.values() for f, may_end in forms if may_end}
        cut = padded
        if stems:
            cut = F.regexp_replace(cut, f" ({one_of(stems)})[a-z]{{1,{fv.STEM_MAX_ENDING}}}(?= )", " $1")
        texts = {n: " ".join(f for f, _ in forms) for n, forms in group.items()}
        begun = {t: [n for n, k in texts.items() if f"{t} ".startswith(f"{k} ")] for t in texts.values()}
        hits = F.array_distinct(F.regexp_extract_all(cut, F.lit(f" (?=({one_of(begun)}) )"), F.lit(1)))
        numbers = literal_map(begun)
        found.append(F.flatten(F.transform(hits, lambda t: F.element_at(numbers, t))))
    if not found:
        return F.array().cast("array<int>")
    return F.array_sort(F.array_distinct(F.concat(*found)))


def activity_bucket(code: Column) -> Column:
    """software, cdi or adiacent by the first four characters of an activity code."""
    key = F.substring(F.trim(code.cast("string")), 1, 4)
    chain = F.lit(None).cast("string")
    for bucket, codes in fv.ACTIVITY_BUCKETS.items():
        chain = F.when(key.isin(codes), F.lit(bucket)).otherwise(chain)
    return chain


def intervention_key(code: Column) -> Column:
    """An intervention code padded to three digits, then cut to three."""
    text = F.trim(code.cast("string"))
    return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(F.substring(text, 1, 3))


def is_digital_intervention(code: Column) -> Column:
    """Is it one of the digital codes? Null and empty codes are not."""
    return F.coalesce((code != "") & intervention_key(code).isin(fv.DIGITAL_INTERVENTIONS), F.lit(False))


def with_keyword_score(
    df: DataFrame,
    title: str,
    body: str,
    activity: str | None = None,
    intervention: str | None = None,
    dictionary: KeywordDictionary | None = None,
    parts: Sequence[str] = PARTS,
) -> DataFrame:
    """Adds ``software_score``, ``software_label`` and ``software_evidence``, or those of them in ``parts``.

    One pass over the text finds the positions of all phrases that hit; score,
    label and evidence are then read off that short array.
    """
    dictionary = dictionary or KeywordDictionary()
    text = F.concat(
        F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(body), F.lit(""))
    )
    # One entry per possible reason: (name, label, weight). The two activity
    # reasons and the intervention come first, as in the score.
    bucket = activity_bucket(F.col(activity)) if activity else F.lit(None).cast("string")
    digital = is_digital_intervention(F.col(intervention)) if intervention else F.lit(False)
    signals = [bucket == "software", bucket == "cdi", digital]
    entries: list[tuple[str, str, float]] = [
        ("", "produs", fv.WEIGHT_ACTIVITY),
        ("", "cdi", fv.WEIGHT_ACTIVITY * fv.RESEARCH_SHARE),
        ("", fv.LABEL_DIGITAL, fv.WEIGHT_INTERVENTION),
    ]
    codes = len(entries)
    entries += dictionary.keywords
    texts = len(entries)
    entries += [(f"-{k}", "", penalty) for k, penalty in dictionary.negatives]
    phrases = [k for k, *_ in [*dictionary.keywords, *dictionary.negatives]]

    names = F.array(*[F.lit(e[0]) for e in entries])
    labels = F.array(*[F.lit(e[1]) for e in entries])
    weights = F.array(*[F.lit(float(e[2])) for e in entries])

    def weight(i: Column) -> Column:
        return F.element_at(weights, i)

    def reason(i: Column) -> Column:
        named = F.element_at(names, i)
        if activity:
            shown = F.col(activity).cast("string")
            named = (
                F.when(i == 1, F.concat(F.lit("CAEN "), shown))
                .when(i == 2, F.concat(F.lit("CAEN "), shown, F.lit(" (C-D)")))
                .otherwise(named)
            )
        if intervention:
            key = intervention_key(F.col(intervention))
            named = F.when(i == 3, F.concat(F.lit("intervenție "), key)).otherwise(named)
        return named

    def score(hits: Column) -> Column:
        coded = F.aggregate(
            F.filter(hits, lambda i: i <= codes), F.lit(0.0), lambda acc, i: acc + weight(i)
        )
        best = F.sort_array(
            F.transform(F.filter(hits, lambda i: (i > codes) & (i <= texts)), weight), asc=False
        )
        read = let(
            best,
            lambda b: F.lit(fv.WEIGHT_TEXT)
            * (
                F.coalesce(F.get(b, F.lit(0)), F.lit(0.0))
                + F.lit(fv.WEIGHT_SECOND_HIT) * F.coalesce(F.get(b, F.lit(1)), F.lit(0.0))
            ),
        )
        total = F.aggregate(
            F.concat(
                F.array(coded + read),
                F.transform(F.filter(hits, lambda i: i > texts), lambda i: -weight(i)),
            ),
            F.lit(0.0),
            lambda acc, w: acc + w,
        )
        return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 3)

    def label(hits: Column) -> Column:
        # Largest weight sum wins; the label that was hit first wins a tie.
        positive = F.filter(hits, lambda i: i <= texts)
        sums = F.transform(
            F.array_distinct(F.transform(positive, lambda i: F.element_at(labels, i))),
            lambda name, rank: F.struct(
                F.aggregate(
                    F.filter(positive, lambda i: F.element_at(labels, i) == name),
                    F.lit(0.0),
                    lambda acc, i: acc + weight(i),
                ).alias("sum"),
                (-rank).alias("rank"),
                name.alias("name"),
            ),
        )
        return F.coalesce(F.array_max(sums)["name"], F.lit(fv.LABEL_UNKNOWN))

    def evidence(hits: Column) -> Column:
        return F.array_join(F.transform(F.slice(hits, 1, fv.EVIDENCE_MAX), reason), "; ")

    def verdict(hits: Column) -> Column:
        some = F.size(hits) > 0
        made = {"score": (score, F.lit(0.0)), "label": (label, F.lit(fv.LABEL_UNKNOWN)), "evidence": (evidence, F.lit(""))}
        return F.struct(*[F.when(some, made[p][0](hits)).otherwise(made[p][1]).alias(p) for p in parts])

    def found(padded: Column) -> Column:
        coded = F.array_compact(F.array(*[F.when(s, F.lit(n)) for n, s in enumerate(signals, start=1)]))
        return F.concat(coded, phrases_in(padded, phrases, codes + 1))

    # The slug and the hits are each bound once, so a later filter on the score
    # that Spark pushes below this step repeats them once, not once per phrase.
    padded = F.concat(F.lit(" "), slug(text), F.lit(" "))
    signal = let(padded, lambda p: let(found(p), verdict))
    return (
        df.withColumn("_signal", signal)
        .withColumns({f"software_{name}": F.col(f"_signal.{name}") for name in parts})
        .drop("_signal")
    )

