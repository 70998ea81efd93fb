"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from frames import AS_OF
from renewlens import catalog, schemas
from renewlens.operators.skew import Layout
from renewlens.plans.features import account_features
from renewlens.plans.health import account_health, segment_revenue, usage_90d

FOLDER = "/root/testdata/sf0.001"
RELATIONAL = [
    "silver_account_health", "gold_mrr_by_plan_industry", "usage_90d", "account_features",
    "train_test_split", "roc_auc", "roc_auc_by_plan", "shuffled_pairs", "kpis", "churn_matrix",
    "mrr_share_by_plan", "segment_table_texts", "arrival_keys", "arrival_event_keys",
    "injected_violations", "dq_bronze_counts", "top10_risk",
]


def _plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to be broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def bronze(spark, tmp_path):
    """Stored bronze tables, as a refresh reads them."""
    frames = {
        "accounts": (catalog.bronze_accounts(spark, FOLDER), ()),
        "subscriptions": (catalog.bronze_subscriptions(spark, FOLDER), ()),
        "usage_events": (catalog.bronze_usage_events(spark, FOLDER), ("event_date",)),
    }
    for name, (df, partition_by) in frames.items():
        df.write.partitionBy(*partition_by).parquet(str(tmp_path / name))
    return {
        name: spark.read.schema(schema).parquet(str(tmp_path / name))
        for name, schema in (
            ("accounts", schemas.ACCOUNTS),
            ("subscriptions", schemas.SUBSCRIPTIONS),
            ("usage_events", schemas.USAGE_EVENTS),
        )
    }


def _health(bronze, pieces=None):
    return account_health(
        bronze["subscriptions"],
        bronze["accounts"],
        usage_90d(bronze["usage_events"], AS_OF),
        Layout("account_id", pieces or {}),
    )


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_joins_and_no_python_rows(spark, no_broadcast, name):
    plan = _plan(catalog.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in plan


def test_silver_shuffles_every_side_once(no_broadcast, bronze):
    plan = _plan(_health(bronze))
    assert plan.count("Exchange") == 3
    assert plan.count("SortMergeJoin") == 2


def test_spread_keys_cost_one_more_shuffle_of_the_usage_rows(no_broadcast, bronze):
    plan = _plan(_health(bronze, {"ACC-000000001": (4, 2)}))
    assert plan.count("Exchange hashpartitioning(account_id, _line, _column") == 3
    assert plan.count("Exchange hashpartitioning(account_id, 8)") == 1


def test_gold_reads_only_what_it_sums(no_broadcast, bronze):
    plan = _plan(segment_revenue(_health(bronze)))
    assert "usage_events" not in plan and "session_duration_minutes" not in plan
    assert "company_name" not in plan and "renewal_date" not in plan
    assert "partial_sum" in plan


def test_usage_window_prunes_days(bronze):
    plan = _plan(usage_90d(bronze["usage_events"], AS_OF))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date\), \(event_date >= 2024-01-15\)", plan)
    assert "partial_count(1)" in plan
    assert "feature_name" not in plan


def test_window_filter_reaches_the_source_scan(spark):
    df = catalog.usage_90d(spark, FOLDER)
    plan = _plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-15" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in plan


def test_features_from_stored_silver_limit_before_the_shuffle(spark, bronze, tmp_path):
    path = str(tmp_path / "silver")
    _health(bronze).write.parquet(path)
    plan = _plan(account_features(spark.read.parquet(path), AS_OF))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert "company_name" not in plan


def test_hot_account_is_collapsed_before_the_shuffle(spark, tmp_path):
    """A third of all events on one account: each task sends one row for it."""
    path = str(tmp_path / "events")
    spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("A"), F.col("id") % 50))
        .alias("account_id"),
        F.lit(AS_OF).alias("event_date"),
        F.lit(1.0).alias("session_duration_minutes"),
        F.lit(1).alias("pages_viewed"),
    ).write.parquet(path)
    usage = usage_90d(spark.read.parquet(path), AS_OF)
    rows = {r.account_id: r.usage_event_count_90d for r in usage.collect()}
    assert rows["HOT"] == 10000
    plan = usage._jdf.queryExecution().executedPlan()
    assert "partial_count(1)" in plan.toString()
