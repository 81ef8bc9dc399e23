"""The claims risk score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start, points per claim, (amount above, points), upper bound.
BASE_SCORE = 30
POINTS_PER_CLAIM = 10
AMOUNT_TIERS = ((50000, 40), (10000, 20))
MAX_SCORE = 100


def risk_score(
    claims: Column,
    amount: Column,
    base: float = BASE_SCORE,
    per_claim: float = POINTS_PER_CLAIM,
    tiers: Sequence[tuple[float, float]] = AMOUNT_TIERS,
    cap: float = MAX_SCORE,
) -> Column:
    """Score from a claim count and a claimed total; no claims gives ``base``.

    Of the tiers whose floor the amount exceeds, the highest floor's points
    count.
    """
    ascending = sorted(tiers)
    amount_points = reduce(
        lambda lower, tier: F.when(amount > F.lit(tier[0]), F.lit(float(tier[1]))).otherwise(lower),
        ascending,
        F.lit(0.0),
    )
    claim_points = F.coalesce(claims, F.lit(0)) * F.lit(float(per_claim))
    return F.least(F.lit(float(cap)), F.lit(float(base)) + claim_points + amount_points)
