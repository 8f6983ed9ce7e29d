"""Default channel grouping from ``traffic_source``.

The CASE is ordered and tests medium before source, so ``organic`` traffic whose
source is ``(direct)`` is Organic Search. Two variants exist in the source queries and
are kept apart: the seven-way one (with Email and Social) and the five-way one (where
email and social fall to Other).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source queries) ------------------------------------
ORGANIC_MEDIUM = "organic"
PAID_MEDIUM = "cpc"
REFERRAL_MEDIA = ("referral", "affiliate")
EMAIL_MEDIUM = "email"
SOCIAL_MEDIUM = "social"
DIRECT_SOURCE = "(direct)"
NONE_MEDIUM = "(none)"
ORGANIC_SEARCH = "Organic Search"
PAID_SEARCH = "Paid Search"
REFERRAL = "Referral"
EMAIL = "Email"
SOCIAL = "Social"
DIRECT = "Direct"
OTHER = "Other"
# --------------------------------------------------------------------------------------

CHANNEL7_LABELS = [ORGANIC_SEARCH, PAID_SEARCH, REFERRAL, EMAIL, SOCIAL, DIRECT, OTHER]
CHANNEL5_LABELS = [ORGANIC_SEARCH, PAID_SEARCH, REFERRAL, DIRECT, OTHER]


def _channel(source: Column, medium: Column, with_email_social: bool) -> Column:
    out = (
        F.when(medium == ORGANIC_MEDIUM, F.lit(ORGANIC_SEARCH))
        .when(medium == PAID_MEDIUM, F.lit(PAID_SEARCH))
        .when(medium.isin(*REFERRAL_MEDIA), F.lit(REFERRAL))
    )
    if with_email_social:
        out = out.when(medium == EMAIL_MEDIUM, F.lit(EMAIL)).when(medium == SOCIAL_MEDIUM, F.lit(SOCIAL))
    return out.when((source == DIRECT_SOURCE) | (medium == NONE_MEDIUM), F.lit(DIRECT)).otherwise(F.lit(OTHER))


def channel7(source: str | Column = "traffic_source.source", medium: str | Column = "traffic_source.medium") -> Column:
    """Organic Search, Paid Search, Referral, Email, Social, Direct, Other."""
    return _channel(F.col(source) if isinstance(source, str) else source,
                    F.col(medium) if isinstance(medium, str) else medium, True)


def channel5(source: str | Column = "traffic_source.source", medium: str | Column = "traffic_source.medium") -> Column:
    """Organic Search, Paid Search, Referral, Direct, Other (email/social are Other)."""
    return _channel(F.col(source) if isinstance(source, str) else source,
                    F.col(medium) if isinstance(medium, str) else medium, False)
