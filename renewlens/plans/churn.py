"""The model jobs over stored tables: train and score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from renewlens import schemas
from renewlens.plans import scoring, training
from renewlens.plans.refresh import FEATURE_TABLE, RefreshConfig
from renewlens.sources.tables import overwrite_table, prune_versions


def model_root(config: RefreshConfig) -> str:
    return config.folder("_models")


def replace(spark: SparkSession, config: RefreshConfig, name: str, rows: DataFrame) -> None:
    """A result table as a new version; the old one is served until it is complete."""
    overwrite_table(rows, config.table(name), config.target_root)
    prune_versions(spark, config.table(name), config.target_root, config.keep_versions)


def train_job(
    spark: SparkSession,
    config: RefreshConfig,
    settings: training.TrainingSettings = training.TrainingSettings(),
) -> int:
    """Train on the feature table, write the result tables, return the new model version."""
    features = spark.table(config.table(FEATURE_TABLE))
    result = training.train(features, model_root(config), settings)
    for name, rows in (
        ("churn_model_metrics", result.metrics),
        ("churn_feature_importance", result.importance),
        ("churn_training_status", result.status),
    ):
        replace(spark, config, name, rows)
    return result.status.first().version


def score_job(spark: SparkSession, config: RefreshConfig, version: int) -> DataFrame:
    """Score the current accounts with a registered version and store the risk list."""
    model = training.load_model(model_root(config), schemas.REGISTERED_MODEL, version)
    risks = scoring.score_accounts(spark.table(config.table(FEATURE_TABLE)), model)
    replace(spark, config, "account_churn_scores", scoring.ranked(risks))
    return spark.table(config.table("account_churn_scores"))
