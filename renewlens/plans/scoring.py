"""Score the accounts that are still here and rank them by risk."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.functions import exact_sum, risk_band, rounded_score
from renewlens.plans.training import LABEL, SCORE, scored
from renewlens.schemas import RISK_LABELS

RISK_COLUMNS = (
    "account_id",
    "plan_type",
    "tenure_days",
    "monthly_recurring_revenue",
    "total_events_90d",
    "total_session_minutes_90d",
    "churn_risk",
    "risk_band",
)
HIGH = RISK_LABELS[-1]


def risk_list(features: DataFrame, score: Column) -> DataFrame:
    """Rounded score and band of the accounts with label 0; banded after rounding."""
    current = features.filter(F.col(LABEL) == 0)
    return (
        current.withColumn("churn_risk", rounded_score(score))
        .withColumn("risk_band", risk_band("churn_risk"))
        .select(*RISK_COLUMNS)
    )


def score_accounts(features: DataFrame, model: Model) -> DataFrame:
    current = features.filter(F.col(LABEL) == 0)
    return risk_list(scored(model, current), F.col(SCORE))


def fixed_score() -> Column:
    """A logistic score with given coefficients, for checks that need no fitted model."""
    z = (
        F.lit(1.6)
        - F.lit(0.004) * F.col("tenure_days")
        - F.lit(0.01) * F.col("total_events_90d")
        + F.when(F.col("plan_type") == "Starter", F.lit(0.5)).otherwise(F.lit(0.0))
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def ranked(risks: DataFrame) -> DataFrame:
    return risks.orderBy(F.col("churn_risk").desc(), "account_id")


def top_risks(risks: DataFrame, n: int = 10) -> DataFrame:
    return ranked(risks).limit(n)


def band_counts(risks: DataFrame) -> DataFrame:
    """Accounts and revenue per band, most frequent band first."""
    return (
        risks.groupBy("risk_band")
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            exact_sum("monthly_recurring_revenue").alias("mrr"),
        )
        .orderBy(F.col("account_count").desc(), "risk_band")
    )


def revenue_at_risk(risks: DataFrame) -> DataFrame:
    """Accounts and monthly revenue in the High band; zeros when there are none."""
    return risks.filter(F.col("risk_band") == HIGH).agg(
        F.count(F.lit(1)).alias("high_risk_accounts"),
        F.coalesce(exact_sum("monthly_recurring_revenue"), F.lit(0.0)).alias("mrr_at_risk"),
    )
