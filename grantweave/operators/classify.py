"""Software or not: keyword score, domain tag and meaning signal together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave import fixed_values as fv
from grantweave.functions.keywords import PARTS, KeywordDictionary, with_keyword_score


def _joined(*parts: Column) -> Column:
    return F.concat_ws("; ", *[F.nullif(p, F.lit("")) for p in parts])


def _boost(df: DataFrame, when: Column, points: Column, first: Column | None, last: Column | None) -> DataFrame:
    """Adds points to the score where a condition holds, and says why."""
    label, evidence = F.col("software_label"), F.col("software_evidence")
    reasons = [c for c in (first, evidence, last) if c is not None]
    return df.withColumns(
        {
            "software_score": F.when(
                when, F.round(F.least(F.lit(1.0), F.col("software_score") + points), 3)
            ).otherwise(F.col("software_score")),
            "software_label": F.when(
                when & (label == fv.LABEL_UNKNOWN), F.lit(fv.LABEL_DIGITAL)
            ).otherwise(label),
            "software_evidence": F.when(when, _joined(*reasons)).otherwise(evidence),
        }
    )


def with_domain_boost(
    df: DataFrame, domains: str = "domains", domain: str = fv.DIGITAL_DOMAIN
) -> DataFrame:
    """Raises tagged calls by WEIGHT_DOMAIN, which alone makes no call software."""
    tagged = F.coalesce(F.array_contains(domains, domain), F.lit(False))
    return _boost(df, tagged, F.lit(fv.WEIGHT_DOMAIN), F.lit(f"domeniu: {domain}"), None)


def _two_decimals(score: Column) -> Column:
    """A three-decimal score between 0 and 1 with two decimals. A final 5 goes the
    way of the stored binary number, which lies just below or above it."""
    below = [k for k in range(5, 1000, 10) if float(f"{k / 1000:.2f}") < k / 1000]
    thousandths = F.round(score * 1000).cast("int")
    hundredths = F.floor((thousandths + 5) / 10) - thousandths.isin(below).cast("int")
    return F.format_string("%d.%02d", F.floor(hundredths / 100), hundredths % 100)


def with_meaning(df: DataFrame, meaning: str = "meaning") -> DataFrame:
    """Adds the meaning score (see ``vectors``) where it is above 0."""
    score = F.col(meaning)
    said = F.concat(F.lit("înțeles "), _two_decimals(score))
    return _boost(
        df, F.coalesce(score > 0, F.lit(False)), F.lit(fv.WEIGHT_MEANING) * score, None, said
    )


def _decide(df: DataFrame) -> DataFrame:
    return df.withColumn("is_software", F.col("software_score") >= fv.SOFTWARE_THRESHOLD)


def classify_projects(
    df: DataFrame,
    dictionary: KeywordDictionary | None = None,
    meaning: str | None = None,
    title: str = "project_title",
    body: str = "project_summary",
    parts: Sequence[str] = PARTS,
) -> DataFrame:
    """Score, label, evidence and decision from text and codes of a project, or without a meaning
    those in ``parts``; the decision comes with the score."""
    scored = with_keyword_score(
        df,
        title,
        body,
        activity="caen" if "caen" in df.columns else None,
        intervention="intervention_code" if "intervention_code" in df.columns else None,
        dictionary=dictionary,
        parts=PARTS if meaning else parts,
    )
    if not meaning and "score" not in parts:
        return scored
    return _decide(with_meaning(scored, meaning) if meaning else scored)


def classify_calls(
    df: DataFrame, dictionary: KeywordDictionary | None = None, meaning: str | None = None
) -> DataFrame:
    """Calls, scored by title and objective and raised by their tag."""
    scored = with_keyword_score(df, "title", "specific_objective", dictionary=dictionary)
    boosted = with_domain_boost(scored)
    return _decide(with_meaning(boosted, meaning) if meaning else boosted)
