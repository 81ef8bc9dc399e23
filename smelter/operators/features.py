"""Gold features: per customer, per policy, per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import ref
from smelter.functions.scoring import risk_score
from smelter.operators.history import current_rows
from smelter.operators.joins import left_join_features
from smelter.session import Run

ACTIVE = "ACTIVE"


def stamp(df: DataFrame, run: Run | None, name: str = "feature_timestamp") -> DataFrame:
    """Add the run's time; without a run the query's own start."""
    return df.withColumn(name, run.ts_column if run else F.current_timestamp())


def _measures(column: str, of: str, *kinds: str) -> list[Column]:
    functions = {"total": F.sum, "avg": F.avg, "max": F.max, "min": F.min}
    return [functions[k](ref(column)).alias(f"{k}_{of}") for k in kinds]


def claims_features(
    claims: DataFrame, by: str = "customer_id", claim: str = "claim_id", amount: str = "claim_amount"
) -> DataFrame:
    """Count, sum, average and maximum of claims per customer.

    All rows count, current or not; claims without a customer form one group.
    """
    return claims.groupBy(ref(by)).agg(
        F.count(ref(claim)).alias("total_claims"),
        *_measures(amount, "claim_amount", "total", "avg", "max"),
    )


def policy_features(
    policies: DataFrame,
    by: str = "customer_id",
    policy: str = "policy_id",
    premium: str = "premium",
    status: str = "status",
    active: str = ACTIVE,
) -> DataFrame:
    """Policies, active policies, average and total premium per customer."""
    return policies.groupBy(ref(by)).agg(
        F.count(ref(policy)).alias("total_policies"),
        F.count_if(ref(status) == active).alias("active_policies"),
        *_measures(premium, "premium", "avg", "total"),
    )


def customer_features(customers: DataFrame, per_customer: DataFrame, on: str = "customer_id") -> DataFrame:
    """Customers with their policy features, 0 where they have none.

    Both sides are unique by customer, so no key is frequent: a plain join, and
    adaptive execution broadcasts a side that turns out small.
    """
    features = [c for c in per_customer.columns if c != on]
    return customers.join(per_customer, on, "left").fillna(0, subset=features)


def risk_features(
    policies: DataFrame,
    claims_per_key: DataFrame,
    on: str = "customer_id",
    rows_per_piece: int | None = None,
    **score,
) -> DataFrame:
    """Policies with claims features (NULL where none) and ``overall_risk_score``.

    ``score`` takes the parameters of :func:`smelter.functions.risk_score`.
    One customer may own many policies; see :func:`left_join_features` for how the join
    splits them, for which ``claims_per_key`` should be a stored table.
    """
    total = risk_score(F.col("total_claims"), F.col("total_claim_amount"), **score)
    joined = left_join_features(policies, claims_per_key, on, rows_per_piece)
    return joined.withColumn("overall_risk_score", total)


def monthly_summary(
    claims: DataFrame, date: str = "claim_date", claim: str = "claim_id", amount: str = "claim_amount"
) -> DataFrame:
    """Current claims per month, oldest month first; empty months do not appear.

    ``claim_count`` repeats ``total_claims``.
    """
    count = F.count(ref(claim))
    return (
        current_rows(claims)
        .groupBy(F.date_trunc("month", ref(date)).alias("claim_year_month"))
        .agg(
            count.alias("total_claims"),
            *_measures(amount, "claim_amount", "total", "avg", "max", "min"),
            count.alias("claim_count"),
        )
        .select(
            "claim_year_month",
            F.year("claim_year_month").alias("claim_year"),
            F.month("claim_year_month").alias("claim_month"),
            "total_claims",
            "total_claim_amount",
            "avg_claim_amount",
            "max_claim_amount",
            "min_claim_amount",
            "claim_count",
        )
        .orderBy("claim_year_month")
    )


def preview(summary: DataFrame, order_by: str = "claim_year_month", rows: int = 5) -> DataFrame:
    """The first rows in order, for a look at the result."""
    return summary.orderBy(ref(order_by)).limit(rows)
