"""The deepest funnel stage a user reached."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source query; the dash is U+2014) ------------------
STAGE_CONVERTED = "5 — Converted"
STAGE_CHECKOUT = "4 — Dropped at checkout"
STAGE_CART = "3 — Dropped after cart"
STAGE_BROWSE = "2 — Dropped after browse"
STAGE_BOUNCED = "1 — Bounced"
# --------------------------------------------------------------------------------------


def funnel_stage(
    purchases: str = "purchases",
    checkouts_started: str = "checkouts_started",
    cart_adds: str = "cart_adds",
    item_views: str = "item_views",
) -> Column:
    """Label from per-user event counts; the deepest non-zero step wins."""
    return (
        F.when(F.col(purchases) > 0, F.lit(STAGE_CONVERTED))
        .when(F.col(checkouts_started) > 0, F.lit(STAGE_CHECKOUT))
        .when(F.col(cart_adds) > 0, F.lit(STAGE_CART))
        .when(F.col(item_views) > 0, F.lit(STAGE_BROWSE))
        .otherwise(F.lit(STAGE_BOUNCED))
    )
