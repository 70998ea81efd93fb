"""Account health (silver) and segment revenue (gold)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens.functions import exact_sum, exact_total
from renewlens.functions.columns import day, joined_total
from renewlens.operators.skew import Layout, layout_for
from renewlens.schemas import SILVER, USAGE_EVENTS, USAGE_WINDOW_DAYS

AsOf = datetime.date | str | None


def _in_window(as_of: AsOf):
    # Lower bound included, no upper bound: future-dated events count.
    return F.col("event_date") >= F.date_sub(day(as_of), USAGE_WINDOW_DAYS)


def usage_90d(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Events, session minutes and pages per account inside the usage window."""
    return (
        events.filter(_in_window(as_of))
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("usage_event_count_90d"),
            exact_sum("session_duration_minutes").alias("total_session_minutes_90d"),
            F.sum("pages_viewed").alias("total_pages_viewed_90d"),
        )
    )


def daily_usage(events: DataFrame) -> DataFrame:
    """One row per account and day. Minutes stay decimal, so days add up exactly."""
    minutes, special = exact_total("session_duration_minutes")
    return events.groupBy("account_id", "event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        minutes.alias("session_minutes"),
        special.alias("session_special"),
        F.sum("pages_viewed").alias("pages_viewed"),
    )


def write_daily_usage(events: DataFrame, target: str, since: AsOf = None) -> None:
    """Refresh the daily rows from ``since`` on (all days without it).

    Only the days present in the result are replaced, so a refresh touches the
    days that got events and leaves older partitions alone.
    """
    recent = events if since is None else events.filter(F.col("event_date") >= day(since))
    (
        daily_usage(recent)
        # Days differ in size: let the runtime cut large ones and merge small ones.
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(target)
    )


def daily_schema(spark: SparkSession) -> StructType:
    return daily_usage(spark.createDataFrame([], USAGE_EVENTS)).schema


def append_daily_usage(events: DataFrame, folder: str) -> None:
    """The daily rows of one batch of events, under the batch's own folder.

    A day may have rows of many batches, which add up; so a late event costs a row, not
    its day.
    """
    daily = daily_usage(events).hint("rebalance", "event_date")
    daily.write.mode("overwrite").partitionBy("event_date").parquet(folder)


def usage_90d_from_daily(daily: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``usage_90d`` from day rows instead of events."""
    return (
        daily.filter(_in_window(as_of))
        .groupBy("account_id")
        .agg(
            F.sum("event_count").alias("usage_event_count_90d"),
            joined_total(F.sum("session_minutes"), F.sum("session_special")).alias(
                "total_session_minutes_90d"
            ),
            F.sum("pages_viewed").alias("total_pages_viewed_90d"),
        )
    )


def account_health(
    subscriptions: DataFrame,
    accounts: DataFrame,
    usage: DataFrame,
    layout: Layout | None = None,
) -> DataFrame:
    """Subscriptions with their account and its usage; the gates come after.

    One row per pair of subscription and matching account row; nothing is
    deduplicated. Usage is aggregated before the joins. All three sides meet on
    the same columns, so each is shuffled once, and keys that hold much of
    either table are spread (see ``operators.skew``).
    """
    layout = layout or layout_for(subscriptions, accounts, "account_id")
    on = layout.join_columns
    joined = (
        layout.left(subscriptions)
        .join(layout.right(accounts), on)
        .join(layout.everywhere(usage), on, "left")
    )
    zero = F.lit(0)
    return joined.withColumns(
        {
            "is_churned": F.col("status") == "churned",
            "usage_event_count_90d": F.coalesce("usage_event_count_90d", zero),
            "total_session_minutes_90d": F.coalesce("total_session_minutes_90d", F.lit(0.0)),
            "total_pages_viewed_90d": F.coalesce("total_pages_viewed_90d", zero),
        }
    ).select(*SILVER.fieldNames())


def segment_revenue(health: DataFrame) -> DataFrame:
    """Revenue and account counts by plan and industry.

    ``churned_account_count`` counts rows, ``account_count`` different accounts.
    """
    revenue = F.col("monthly_recurring_revenue")
    return health.groupBy("plan_type", "industry").agg(
        exact_sum(F.when(F.col("status") == "active", revenue).otherwise(0)).alias("active_mrr"),
        exact_sum(revenue).alias("total_mrr"),
        F.count_distinct("account_id").alias("account_count"),
        F.count_if("is_churned").alias("churned_account_count"),
    )
