"""One row per account: the input of the churn models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.functions import days_between, floor_at_zero, or_unknown
from renewlens.functions.columns import day
from renewlens.operators.ranking import latest_per_key
from renewlens.operators.split import stratified_split
from renewlens.plans.health import AsOf
from renewlens.schemas import TEST_FRACTION


def account_features(health: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Label and features of each account, from its latest subscription.

    Latest is by renewal date, then smallest subscription key. The remaining
    columns only settle ties between duplicated account rows, so the pick never
    depends on row order. A missing contract start counts as tenure 0, since the
    models take no missing numbers; ``missing_tenure`` counts such accounts.
    """
    order = [
        F.col("renewal_date").desc_nulls_last(),
        *(
            F.col(c)
            for c in (
                "subscription_id",
                "contract_start_date",
                "plan_type",
                "industry",
                "country",
                "status",
                "monthly_recurring_revenue",
            )
        ),
    ]
    needed = health.select(
        "account_id",
        "subscription_id",
        "status",
        "is_churned",
        "plan_type",
        "industry",
        "country",
        "contract_start_date",
        "renewal_date",
        "monthly_recurring_revenue",
        "usage_event_count_90d",
        "total_session_minutes_90d",
        "total_pages_viewed_90d",
    )
    return latest_per_key(needed, ["account_id"], order).select(
        "account_id",
        F.col("is_churned").cast("int").alias("is_churned"),
        or_unknown("plan_type").alias("plan_type"),
        or_unknown("industry").alias("industry"),
        or_unknown("country").alias("country"),
        F.coalesce(days_between(day(as_of), "contract_start_date"), F.lit(0)).alias("tenure_days"),
        floor_at_zero("monthly_recurring_revenue").alias("monthly_recurring_revenue"),
        F.col("usage_event_count_90d").alias("total_events_90d"),
        "total_session_minutes_90d",
        "total_pages_viewed_90d",
    )


def missing_tenure(health: DataFrame) -> DataFrame:
    """How many accounts have a row without contract start: one number."""
    missing = F.when(F.col("contract_start_date").isNull(), F.col("account_id"))
    return health.agg(F.count_distinct(missing).alias("accounts_without_start"))


def with_split(features: DataFrame) -> DataFrame:
    """Flag the hold-out fifth of each label."""
    return stratified_split(features, "is_churned", "account_id", TEST_FRACTION)


def split_rates(split: DataFrame) -> DataFrame:
    """Rows and churn rate of both parts."""
    return split.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg("is_churned").alias("churn_rate")
    )
