import datetime

import pytest
from pyspark.sql import functions as F

from frames import AS_OF, accounts, days, events, subscriptions
from renewlens import schemas
from renewlens.operators.quality import gate
from renewlens.operators.skew import Layout, layout_for
from renewlens.plans.health import (
    account_health,
    daily_usage,
    segment_revenue,
    usage_90d,
    usage_90d_from_daily,
    write_daily_usage,
)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_window_has_a_lower_bound_only(spark):
    ev = events(spark, *((f"E{d}", "A", d, 1.0, 1) for d in (-91, -90, 0, 1)))
    assert usage_90d(ev, AS_OF).first().usage_event_count_90d == 3


def test_default_day_is_today(spark):
    today = datetime.date.today()
    ev = spark.createDataFrame([("E", "A", "x", today, 1.0, 1)], schemas.USAGE_EVENTS)
    assert usage_90d(ev).first().usage_event_count_90d == 1


def test_account_without_usage_gets_zeros(spark):
    health = account_health(
        subscriptions(spark, ("S", "A", 5.0, "active", 0)),
        accounts(spark, "A"),
        usage_90d(events(spark), AS_OF),
    ).first()
    assert health.usage_event_count_90d == 0
    assert health.total_session_minutes_90d == 0.0
    assert health.total_pages_viewed_90d == 0
    assert health.is_churned is False


def test_orphans_and_null_keys_disappear(spark):
    health = account_health(
        subscriptions(
            spark, ("S1", "gone", 5.0, "active", 0), ("S2", None, 5.0, "active", 0),
            ("S3", "A", 5.0, None, 0),
        ),
        accounts(spark, "A", None),
        usage_90d(events(spark, ("E", "nobody", 0, 1.0, 1), ("E", None, 0, 1.0, 1)), AS_OF),
    ).collect()
    assert [(r.subscription_id, r.is_churned) for r in health] == [("S3", None)]


def _fan_out(spark, layout):
    health = account_health(
        subscriptions(
            spark,
            ("S1", "A", 5.0, "churned", 0), ("S2", "A", 7.0, "churned", 0),
            ("S3", "B", 1.0, "active", 0),
        ),
        accounts(spark, "A", "A", "B"),
        usage_90d(
            events(spark, ("E1", "A", 0, 1.5, 2), ("E2", "A", 0, 2.25, 3), ("E3", "B", 0, 1.0, 1)),
            AS_OF,
        ),
        layout,
    )
    return health


@pytest.mark.parametrize("pieces", [{}, {"A": (3, 1)}, {"A": (1, 4)}, {"A": (3, 5), "B": (2, 2)}])
def test_fan_out_is_kept_whatever_the_layout(spark, pieces):
    health = _fan_out(spark, Layout("account_id", pieces))
    assert health.columns == schemas.SILVER.fieldNames()
    assert _rows(health) == _rows(_fan_out(spark, Layout("account_id", {})))
    assert health.filter("account_id = 'A'").count() == 4
    assert {r.total_session_minutes_90d for r in health.collect()} == {3.75, 1.0}
    gold = segment_revenue(health).first()
    assert (gold.account_count, gold.churned_account_count) == (2, 4)
    assert (gold.active_mrr, gold.total_mrr) == (1.0, 25.0)


def test_skewed_tables_join_like_plain_ones(spark):
    n = 3000
    subs = spark.range(n).select(
        F.concat(F.lit("S"), "id").alias("subscription_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 400))
        .alias("account_id"),
        F.lit(1.0).alias("monthly_recurring_revenue"),
        F.lit("active").alias("status"),
        F.lit(days(0)).alias("renewal_date"),
    )
    acc = accounts(spark, "HOT", *(f"K{i}" for i in range(300)))
    usage = usage_90d(events(spark, ("E", "HOT", 0, 1.0, 1), ("E", "K7", 0, 2.0, 1)), AS_OF)
    layout = layout_for(subs, acc, "account_id", parts=8, small=0, min_rows=100)
    assert set(layout.pieces) == {"HOT"}
    spread = account_health(subs, acc, usage, layout)
    plain = account_health(subs, acc, usage, Layout("account_id", {}))
    assert _rows(spread) == _rows(plain)


def test_days_add_up_to_the_direct_sum(spark, tmp_path):
    ev = events(
        spark,
        *((f"E{i}", f"A{i % 3}", -(i % 100), 0.1 * (i % 7), i % 5) for i in range(300)),
    )
    target = str(tmp_path / "daily")
    write_daily_usage(ev, target)
    daily = spark.read.parquet(target)
    assert _rows(usage_90d_from_daily(daily, AS_OF)) == _rows(usage_90d(ev, AS_OF))
    # Late events of two days: only the days from there on are written again.
    more = ev.unionByName(events(spark, ("L1", "A0", -1, 4.0, 1), ("L2", "A9", 0, 4.0, 1)))
    write_daily_usage(more, target, since=days(-1))
    assert _rows(usage_90d_from_daily(spark.read.parquet(target), AS_OF)) == _rows(
        usage_90d(more, AS_OF)
    )
    assert daily_usage(more).count() == spark.read.parquet(target).count()


def test_warned_revenue_counts_and_null_is_skipped(spark):
    health = account_health(
        subscriptions(
            spark, ("S1", "A", -1.0, "active", 0), ("S2", "A", None, "active", 0),
            ("S3", "A", 10.0, "trial", 0), ("S4", "A", 99.0, "paused", 0),
        ),
        accounts(spark, "A"),
        usage_90d(events(spark), AS_OF),
    )
    gold = segment_revenue(gate(health, schemas.SILVER_RULES)).first()
    assert (gold.active_mrr, gold.total_mrr) == (-1.0, 9.0)
