"""The scheduled jobs end to end over catalog tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from frames import AS_OF, accounts, days, events, subscriptions
from renewlens import schemas
from renewlens.operators import violations
from renewlens.operators.quality import ExpectationFailed
from renewlens.plans import churn
from renewlens.plans import refresh as job
from renewlens.plans.training import TrainingSettings
from renewlens.sources.tables import append_table


@pytest.fixture
def config(spark, tmp_path):
    name = uuid.uuid4().hex[:8]
    for schema in (f"src_{name}", f"out_{name}"):
        spark.sql(f"CREATE SCHEMA {schema}")
    return job.RefreshConfig(
        f"src_{name}", f"out_{name}", str(tmp_path / "out"), AS_OF, keep_versions=2
    )


def _sources(spark, config, tag, status="active"):
    append_table(accounts(spark, f"{tag}1", f"{tag}2", None), config.source("accounts"))
    append_table(
        subscriptions(
            spark,
            (f"S{tag}1", f"{tag}1", 10.0, status, 0),
            (f"S{tag}2", f"{tag}2", -5.0, "churned", 0),
            (f"S{tag}3", f"{tag}2", 5.0, "paused", 0),
            (None, f"{tag}1", 5.0, "active", 0),
        ),
        config.source("subscriptions"),
    )
    append_table(
        events(spark, (f"E{tag}", f"{tag}1", -1, 2.5, 3), (None, f"{tag}1", -1, 1.0, 1)),
        config.source("usage_events"),
    )


def test_refresh_takes_appended_rows_through_all_layers(spark, config, tmp_path):
    _sources(spark, config, "A")
    metrics = job.refresh(spark, config)
    assert metrics["bronze_accounts"] == {"total_rows": 3, "valid_account_id": 1}
    assert metrics["bronze_usage_events"] == {"total_rows": 2, "valid_event_id": 1}
    assert metrics["silver_account_health"] == {
        "total_rows": 3, "account_id_present": 0, "valid_status": 1, "non_negative_mrr": 1
    }
    gold = spark.table(config.table(job.SNAPSHOT_TABLE)).first()
    assert (gold.active_mrr, gold.total_mrr) == (10.0, 5.0)
    assert (gold.account_count, gold.churned_account_count) == (2, 1)

    _sources(spark, config, "B")
    metrics = job.refresh(spark, config)
    assert metrics["bronze_accounts"]["total_rows"] == 3
    assert metrics["silver_account_health"]["total_rows"] == 6
    gold = spark.table(config.table(job.SNAPSHOT_TABLE)).first()
    assert (gold.active_mrr, gold.account_count) == (20.0, 4)
    log = spark.table(config.table(job.QUALITY_LOG))
    assert log.select("run_id").distinct().count() == 2
    assert log.filter("metric = 'valid_status'").agg(F.sum("row_count")).first()[0] == 3
    silver = spark.table(config.table(job.SILVER_TABLE))
    assert silver.schema["account_id"].metadata["comment"]
    assert {r.usage_event_count_90d for r in silver.collect()} == {0, 1}
    assert spark.table(config.table("bronze_usage_events")).count() == 2
    versions = list((tmp_path / "out" / job.SILVER_TABLE).iterdir())
    assert len(versions) == 2
    # Nothing new: bronze counts are zero, the layers above stay the same.
    idle = job.refresh(spark, config)
    assert idle["bronze_accounts"] == {"total_rows": 0, "valid_account_id": 0}
    assert idle["silver_account_health"] == metrics["silver_account_health"]
    # Old versions go, published ones stay readable.
    assert len(list((tmp_path / "out" / job.SILVER_TABLE).iterdir())) == 2
    assert spark.table(config.table(job.SILVER_TABLE)).count() == 4


def test_broken_rule_stops_the_refresh(spark, config, monkeypatch):
    _sources(spark, config, "C")
    job.refresh(spark, config)
    silver = config.table(job.SILVER_TABLE)
    before = spark.table(silver).collect()
    rule = schemas.Expectation("no_trials", "status <> 'trial'", schemas.FAIL)
    monkeypatch.setattr(schemas, "SILVER_RULES", (*schemas.SILVER_RULES, rule))
    _sources(spark, config, "D", status="trial")
    with pytest.raises(ExpectationFailed):
        job.refresh(spark, config)
    assert spark.table(silver).collect() == before


def _arrive(spark, config, n):
    """n accounts with one subscription each and 3 n events, with violations planted."""
    key = F.col("id")
    plans = F.element_at(F.array(*(F.lit(p) for p in schemas.PLAN_ORDER)), (key % 3 + 1).cast("int"))
    batch = spark.range(n).select(
        F.concat(F.lit("Company "), key).alias("company_name"),
        F.when(key % 2 == 0, "Retail").otherwise("Fintech").alias("industry"),
        plans.alias("plan_type"),
        F.lit("Germany").alias("country"),
        F.date_sub(F.lit(AS_OF), (key % 300).cast("int")).alias("contract_start_date"),
    )
    arriving = spark.range(3 * n).select(
        F.concat(F.lit("ACC-"), F.lpad((key % n).cast("string"), 5, "0")).alias("account_id"),
        F.lit("Search").alias("feature_name"),
        F.lit(days(-1)).alias("event_date"),
        F.lit(1.5).alias("session_duration_minutes"),
        F.lit(2).alias("pages_viewed"),
    )

    def children(accounts_frame):
        made = accounts_frame.withColumns(
            {
                "monthly_recurring_revenue": F.lit(10.0),
                "status": F.when(F.pmod(F.xxhash64("account_id"), F.lit(10)) < 3, "churned")
                .otherwise("active"),
                "renewal_date": F.lit(days(5)),
            }
        )
        return violations.inject(made, "account_id", violations.SUBSCRIPTION_VIOLATIONS)

    def nulls(df):
        return violations.inject(df, "company_name", (violations.null_key("account_id"),))

    return job.append_batch(spark, config.source_schema, batch, arriving, children, nulls)


def _empty_sources(spark, config):
    for table in job.BRONZE_TABLES:
        append_table(spark.createDataFrame([], table.schema), config.source(table.name))


def test_batches_arrive_are_refreshed_trained_and_scored(spark, config):
    _empty_sources(spark, config)
    assert _arrive(spark, config, 400) == 0
    assert _arrive(spark, config, 400) == 400
    stored = spark.table(config.source("accounts"))
    assert stored.count() == 800
    assert stored.agg(F.count_distinct("account_idx")).first()[0] == 800
    dropped = stored.filter("account_id IS NULL").count()
    assert 10 < dropped < 80
    subs = spark.table(config.source("subscriptions"))
    assert subs.count() == 800 - dropped
    paused = subs.filter("subscription_id IS NOT NULL AND status = 'paused'").count()
    assert spark.table(config.source("usage_events")).agg(
        F.count_distinct("event_id")
    ).first()[0] == 2400

    metrics = job.refresh(spark, config)
    assert metrics["bronze_accounts"] == {"total_rows": 800, "valid_account_id": dropped}
    assert metrics["silver_account_health"]["valid_status"] == paused
    assert metrics["silver_account_health"]["non_negative_mrr"] > 0

    job.refresh_features(spark, config)
    features = spark.table(config.table(job.FEATURE_TABLE))
    assert features.count() == features.select("account_id").distinct().count()
    version = churn.train_job(spark, config, TrainingSettings(trees=2, depth=2))
    assert version == 1
    scores = churn.score_job(spark, config, version)
    assert scores.count() == features.filter("is_churned = 0").count()
    for name in ("churn_model_metrics", "churn_feature_importance", "churn_training_status"):
        assert spark.table(config.table(name)).count() in (1, 2, 8)
