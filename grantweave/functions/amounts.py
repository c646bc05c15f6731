"""The EU contribution, derived under invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate_as_fraction(rate: Column) -> Column:
    """85 and 0.85 both read 0.85; outside (0, 100] it is not a rate."""
    return F.when(
        (rate > 0) & (rate <= 100), F.when(rate > 1, rate / F.lit(100.0)).otherwise(rate)
    )


def with_eu_amount(
    df: DataFrame,
    eligible: str = "total_eligible_amount",
    published: str = "eu_amount",
    rate: str = "cofinancing_rate",
) -> DataFrame:
    """Adds ``eu_amount_derived`` and ``eu_amount_source`` (publicat / calculat).

    Amounts above the eligible one are discarded, whether published or computed.
    """
    whole, given = F.col(eligible), F.col(published)
    product = F.round(whole * rate_as_fraction(F.col(rate)), 2)
    computed = F.when(product > whole, F.lit(None)).otherwise(product)
    combined = F.coalesce(given, computed)
    return df.withColumns(
        {
            "eu_amount_derived": F.when(combined > whole, F.lit(None)).otherwise(combined),
            "eu_amount_source": F.when(combined > whole, F.lit(None).cast("string"))
            .when(given.isNotNull(), F.lit("publicat"))
            .when(computed.isNotNull(), F.lit("calculat")),
        }
    )
