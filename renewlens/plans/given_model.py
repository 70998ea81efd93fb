"""The job's encoders as rows, and a model of known coefficients in its stages.

A fitted model cannot be recomputed elsewhere; one with given coefficients can. It runs
through the same encoders, scoring, ranking and permutations as the trained ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.plans.training import SCALED_VECTOR
from renewlens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

# Log odds by encoded feature; what is not named has 0. The scaled numbers are in
# deviations from the mean of the training rows.
INTERCEPT = 0.2
COEFFICIENTS = {
    "plan_type=Starter": 0.5,
    "plan_type=Enterprise": -0.75,
    "industry=BUILDING": 0.25,
    "country=GERMANY": -0.4,
    "tenure_days": -0.6,
    "monthly_recurring_revenue": 0.1,
    "total_events_90d": -0.8,
    "total_session_minutes_90d": -0.3,
    "total_pages_viewed_90d": 0.15,
}


def encoded_names(encoding: PipelineModel) -> list[str]:
    """What each place of the scaled vector stands for: categories, then numbers.

    As long as there are categories, which the models hold on the driver anyway.
    """
    labels = encoding.stages[0].labelsArray
    hot = [f"{c}={v}" for c, values in zip(CATEGORICAL_FEATURES, labels) for v in values]
    return [*hot, *NUMERIC_FEATURES]


def encoded_rows(features: DataFrame, encoding: PipelineModel, key: str = "account_id") -> DataFrame:
    """(key, feature, value): the categories each row has, and its scaled numbers."""
    names = F.array(*(F.lit(n) for n in encoded_names(encoding)))
    vectors = encoding.transform(features).select(key, vector_to_array(SCALED_VECTOR).alias("v"))
    pairs = vectors.select(key, F.inline(F.arrays_zip(names.alias("feature"), F.col("v").alias("value"))))
    wanted = F.col("feature").isin(*NUMERIC_FEATURES) | (F.col("value") != 0)
    return pairs.toDF(key, "feature", "value").filter(wanted)


def given_model(
    spark: SparkSession,
    encoding: PipelineModel,
    coefficients: Mapping[str, float] = COEFFICIENTS,
    intercept: float = INTERCEPT,
) -> PipelineModel:
    """A logistic model of these coefficients behind fitted encoders."""
    weights = Vectors.dense([coefficients.get(n, 0.0) for n in encoded_names(encoding)])
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "given_coefficients", _py2java(spark.sparkContext, weights), float(intercept)
    )
    model = LogisticRegressionModel(java)
    model.setFeaturesCol(SCALED_VECTOR)
    return PipelineModel(stages=[*encoding.stages, model])
