"""Order arithmetic: unit prices, expected totals, pricing and scoring rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TOTAL_TOLERANCE = 0.01
FREE_SHIPPING_ABOVE = 80
MINIMUM_TOTAL = 1
BASE_RETURN_SCORE = 0.18
RISKY_CATEGORY_TERM = 0.15
MOBILE_TERM = 0.03
SMALL_TOTAL_TERM = 0.08
SMALL_TOTAL_BELOW = 30
EMAIL_TERM = 0.02


def price_per_item(basket: Column, n_items: Column) -> Column:
    """Batch unit price: basket over items, NULL for a non-positive count."""
    return F.when(n_items > 0, basket / n_items)


def price_per_item_stream(total: Column, n_items: Column) -> Column:
    """Stream unit price: total over items, counting a missing or zero count as one."""
    return total / F.greatest(F.coalesce(n_items, F.lit(0)), F.lit(1))


def expected_total(basket: Column, shipping: Column, discount: Column) -> Column:
    return basket + shipping - discount


def total_delta(total: Column, basket: Column, shipping: Column, discount: Column) -> Column:
    return total - expected_total(basket, shipping, discount)


def is_inconsistent(delta: Column, tolerance: float = TOTAL_TOLERANCE) -> Column:
    return F.abs(delta) > F.lit(tolerance)


def repaired_total(total: Column, basket: Column, shipping: Column, discount: Column) -> Column:
    """The given total, or the expected one where it is missing."""
    return F.coalesce(total, expected_total(basket, shipping, discount))


def shipping_rule(basket: Column, fee: Column) -> Column:
    """Free shipping above the fixed basket value."""
    return F.when(basket > FREE_SHIPPING_ABOVE, F.lit(0.0)).otherwise(fee)


def total_rule(basket: Column, shipping: Column, discount: Column) -> Column:
    """Order total in cents: never below the minimum, rounded half up on decimals."""
    exact = [c.cast("decimal(14,4)") for c in (basket, shipping, discount)]
    floor = F.lit(MINIMUM_TOTAL).cast("decimal(14,4)")
    total = F.greatest(exact[0] + exact[1] - exact[2], floor)
    return F.round(total, 2).cast("double")


@dataclass(frozen=True)
class ScoreLabels:
    """Category values the rule score reacts to."""

    category: str = "fashion"
    device: str = "mobile"
    channel: str = "email"


def rule_return_score(
    category: Column,
    device: Column,
    total: Column,
    channel: Column,
    labels: ScoreLabels = ScoreLabels(),
) -> Column:
    """Additive return score; a missing value adds nothing."""

    def term(condition: Column, weight: float) -> Column:
        return F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))

    return (
        F.lit(BASE_RETURN_SCORE)
        + term(category == labels.category, RISKY_CATEGORY_TERM)
        + term(device == labels.device, MOBILE_TERM)
        + term(total < SMALL_TOTAL_BELOW, SMALL_TOTAL_TERM)
        - term(channel == labels.channel, EMAIL_TERM)
    )
