"""Report frames over the segment table (one row per plan and industry).

The input is already aggregated, so a window over all of it handles a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.functions import (
    exact_sum,
    percent_text,
    plan_rank,
    ratio_or_null,
    ratio_or_zero,
    usd_text,
)
from renewlens.schemas import CHURN_ALERT_THRESHOLD, PLAN_ORDER

TABLE_LABELS = {
    "plan_type": "Plan",
    "industry": "Industry",
    "active_mrr": "Active MRR",
    "total_mrr": "Total MRR",
    "account_count": "Accounts",
    "active_accounts": "Active accounts",
    "churned_account_count": "Churned accounts",
    "churn_rate": "Churn rate",
    "avg_mrr_per_active": "Avg MRR / active",
}


def segment_metrics(gold: DataFrame) -> DataFrame:
    """Add active accounts (all minus churned), churn rate and revenue per active account."""
    return gold.withColumn(
        "active_accounts", F.col("account_count") - F.col("churned_account_count")
    ).withColumns(
        {
            "churn_rate": ratio_or_null("churned_account_count", "account_count"),
            "avg_mrr_per_active": ratio_or_null("active_mrr", "active_accounts"),
        }
    )


def facets(
    segments: DataFrame,
    plans: Sequence[str] | None = None,
    industries: Sequence[str] | None = None,
) -> DataFrame:
    """Rows matching both selections; a selection may be empty and match nothing.

    Without a plan selection the known plans are taken, or all plans when none
    of the known ones occurs.
    """
    if plans is not None:
        chosen = segments.filter(F.col("plan_type").isin(list(plans)))
    else:
        known = F.coalesce(F.col("plan_type").isin(list(PLAN_ORDER)), F.lit(False))
        chosen = (
            segments.withColumn("_known", known)
            .withColumn("_any", F.max("_known").over(Window.partitionBy()))
            .filter(F.col("_known") | ~F.col("_any"))
            .drop("_known", "_any")
        )
    if industries is not None:
        chosen = chosen.filter(F.col("industry").isin(list(industries)))
    return chosen


def kpis(segments: DataFrame) -> DataFrame:
    """Overall figures: ratios of sums, 0 where there is nothing to divide by."""
    zero = F.lit(0)

    def total(name: str):
        return F.coalesce(F.sum(name), zero)

    sums = segments.agg(
        F.coalesce(exact_sum("active_mrr"), F.lit(0.0)).alias("total_active_mrr"),
        total("active_accounts").alias("total_active_accounts"),
        total("account_count").alias("total_accounts"),
        total("churned_account_count").alias("total_churned"),
    )
    return sums.withColumns(
        {
            "overall_churn_rate": ratio_or_zero("total_churned", "total_accounts"),
            "avg_mrr_per_active": ratio_or_zero("total_active_mrr", "total_active_accounts"),
        }
    )


def kpi_texts(segments: DataFrame) -> DataFrame:
    k = kpis(segments)
    return k.select(
        usd_text("total_active_mrr").alias("total_active_mrr"),
        F.format_number("total_active_accounts", 0).alias("active_accounts"),
        percent_text("overall_churn_rate").alias("overall_churn_rate"),
        usd_text("avg_mrr_per_active").alias("avg_mrr_per_active"),
    )


def mrr_by_industry(segments: DataFrame) -> DataFrame:
    return segments.select("industry", "plan_type", "active_mrr").orderBy(
        "industry", plan_rank(), "plan_type"
    )


def mrr_share_by_plan(segments: DataFrame) -> DataFrame:
    by_plan = segments.groupBy("plan_type").agg(exact_sum("active_mrr").alias("active_mrr"))
    everything = F.sum(F.col("active_mrr").cast("decimal(18,2)")).over(Window.partitionBy())
    return by_plan.withColumn(
        "mrr_share", ratio_or_null("active_mrr", everything.cast("double"))
    ).orderBy("plan_type")


def churn_matrix(segments: DataFrame, industries: Sequence[str]) -> DataFrame:
    """Mean churn rate: plans as rows in tier order, the given industries as columns."""
    return (
        segments.groupBy("plan_type")
        .pivot("industry", list(industries))
        .agg(F.avg("churn_rate"))
        .orderBy(plan_rank(), "plan_type")
    )


def churn_matrix_texts(segments: DataFrame, industries: Sequence[str]) -> DataFrame:
    matrix = churn_matrix(segments, industries)
    return matrix.withColumns(
        {i: F.coalesce(percent_text(F.col(f"`{i}`")), F.lit("")) for i in industries}
    )


def mrr_vs_churn(segments: DataFrame) -> DataFrame:
    return segments.select(
        "plan_type", "industry", "churn_rate", "avg_mrr_per_active", "account_count"
    )


def segment_table(segments: DataFrame) -> DataFrame:
    return (
        segments.select(*TABLE_LABELS)
        .orderBy("plan_type", "industry")
        .withColumnsRenamed(TABLE_LABELS)
    )


def segment_table_texts(segments: DataFrame) -> DataFrame:
    table = segment_table(segments)
    texts = {c: usd_text(F.col(f"`{c}`")) for c in ("Active MRR", "Total MRR", "Avg MRR / active")}
    texts |= {
        c: F.format_number(F.col(f"`{c}`"), 0)
        for c in ("Accounts", "Active accounts", "Churned accounts")
    }
    texts["Churn rate"] = percent_text(F.col("`Churn rate`"))
    return table.withColumns(texts)


def churn_alert(segments: DataFrame, threshold: float = CHURN_ALERT_THRESHOLD) -> DataFrame:
    """One row: overall churn rate and whether it is above the threshold."""
    return kpis(segments).select(
        F.col("overall_churn_rate").alias("churn_rate"),
        F.lit(threshold).alias("threshold"),
        (F.col("overall_churn_rate") > threshold).alias("fired"),
    )
