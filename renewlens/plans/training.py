"""Train, compare, register and explain churn models with ``pyspark.ml``.

Two choices follow from Spark's own definitions: its standard scaler divides by
the sample deviation, and its boosted trees grow to a depth, not to a number of
leaves. The regularisation of the logistic model is written for a mean loss.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renewlens.operators.evaluation import champion, confusion_metrics, roc_auc
from renewlens.operators.ranking import dense_index
from renewlens.plans.features import with_split
from renewlens.schemas import (
    BASELINE_MODEL,
    BOOSTED_MODEL,
    CATEGORICAL_FEATURES,
    FEATURES,
    IMPORTANCE_REPEATS,
    NUMERIC_FEATURES,
    REGISTERED_MODEL,
    SPLIT_SEED,
)
from renewlens.session import staged
from renewlens.sources.tables import claim

LABEL, SCORE = "is_churned", "_score"
SCALED_VECTOR, VECTOR = "_scaled_vector", "_vector"
# Rows that are worth a task of a pass, and the most in a file where cores run out.
TASK_ROWS, FILE_ROWS = 10_000, 250_000


@dataclass(frozen=True)
class TrainingSettings:
    max_iterations: int = 1000
    trees: int = 100
    depth: int = 5
    bins: int = 255
    step: float = 0.1
    rows_per_leaf: int = 20
    seed: int = SPLIT_SEED


@dataclass
class TrainingResult:
    metrics: DataFrame
    importance: DataFrame
    status: DataFrame
    winner: PipelineModel = field(repr=False)


def encoders() -> Pipeline:
    """One-hot categories (unseen ones become all zeros) and numbers in one vector, once
    with scaled numbers and once with plain ones."""
    indexed = [f"_{c}_index" for c in CATEGORICAL_FEATURES]
    hot = [f"_{c}_hot" for c in CATEGORICAL_FEATURES]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed, handleInvalid="keep"
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
            VectorAssembler(inputCols=list(NUMERIC_FEATURES), outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
            VectorAssembler(inputCols=[*hot, "_scaled"], outputCol=SCALED_VECTOR),
            VectorAssembler(inputCols=[*hot, "_numbers"], outputCol=VECTOR),
        ]
    )


def baseline_model(n_train: int, settings: TrainingSettings) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=SCALED_VECTOR,
        labelCol=LABEL,
        maxIter=settings.max_iterations,
        regParam=1.0 / max(n_train, 1),
        elasticNetParam=0.0,
        standardization=False,
    )


def boosted_model(settings: TrainingSettings) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=VECTOR,
        labelCol=LABEL,
        maxIter=settings.trees,
        maxDepth=settings.depth,
        maxBins=settings.bins,
        stepSize=settings.step,
        minInstancesPerNode=settings.rows_per_leaf,
        seed=settings.seed,
    )


def churn_probability() -> Column:
    return vector_to_array("probability")[1]


def scored(model: Model, df: DataFrame) -> DataFrame:
    """``df`` plus the unrounded churn probability."""
    kept = df.columns
    return model.transform(df).select(*kept, churn_probability().alias(SCORE))


def model_metrics(scores: DataFrame) -> dict[str, float]:
    """AUC and threshold metrics of scored rows; one row reaches the driver."""
    rates = confusion_metrics(scores, LABEL, SCORE)
    auc = roc_auc(scores, LABEL, SCORE).select("auc").scalar()
    return rates.select(auc.alias("auc"), "accuracy", "precision", "recall", "f1").first().asDict()


def shuffled_pairs(rows: DataFrame, key: str, repeats: int, seed: int) -> DataFrame:
    """Pair every row with a donor row by a random permutation per repeat.

    Returns (repeat, key, donor_key). Positions come from digests, so no group
    is ordered in one task, and each row gives and receives exactly once.
    """
    keys = rows.select(F.col(key).alias("_key"))
    targets = dense_index(
        keys.withColumn("_digest", F.md5("_key")), "_digest", "_at", ties=["_key"]
    )
    repeat = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat")
    tagged = keys.select("_key", repeat)
    salted = F.md5(F.concat_ws(":", F.lit(seed), "repeat", "_key"))
    donors = dense_index(
        tagged.withColumn("_digest", salted), "_digest", "_at", ["repeat"], ties=["_key"]
    )
    given = donors.select("repeat", "_at", F.col("_key").alias("donor_key"))
    return targets.join(given, "_at").select("repeat", F.col("_key").alias(key), "donor_key")


def permutation_importance(
    model: Model,
    test: DataFrame,
    features: Sequence[str] = FEATURES,
    repeats: int = IMPORTANCE_REPEATS,
    seed: int = SPLIT_SEED,
    key: str = "account_id",
) -> DataFrame:
    """Mean drop of the AUC when one feature is shuffled, largest first.

    One job: a permutation is drawn per repeat and shared by the features, each
    paired row is copied once per feature with that feature taken from the
    donor, and all copies go through the model together.
    """
    own = test.select(key, LABEL, *features)
    donor = test.select(
        F.col(key).alias("donor_key"), *(F.col(c).alias(f"_donor_{c}") for c in features)
    )
    paired = shuffled_pairs(test, key, repeats, seed).join(own, key).join(donor, "donor_key")
    # The unshuffled rows ride along in repeat 0 as the base line.
    names = F.array(*(F.lit(c) for c in features))
    with_base = F.when(F.col("repeat") == 0, F.concat(names, F.array(F.lit("")))).otherwise(names)
    copies = paired.withColumn("feature", F.explode(with_base)).select(
        "feature",
        "repeat",
        LABEL,
        *(
            F.when(F.col("feature") == c, F.col(f"_donor_{c}")).otherwise(F.col(c)).alias(c)
            for c in features
        ),
    )
    # Written, so that the two passes of the AUC do not score everything twice.
    scores = staged(
        scored(model, copies).select("feature", "repeat", LABEL, SCORE), "shuffled-scores"
    )
    areas = roc_auc(scores, LABEL, SCORE, ["feature", "repeat"])
    # 8 x 5 + 1 rows from here on.
    means = areas.groupBy("feature").agg(F.avg("auc").alias("_auc"))
    base = F.max(F.when(F.col("feature") == "", F.col("_auc"))).over(Window.partitionBy())
    return (
        means.withColumn("_base", base)
        .filter(F.col("feature") != "")
        .select("feature", F.bround(F.col("_base") - F.col("_auc"), 4).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )


# --- model store: <root>/<name>/v<N> ------------------------------------------


def _store(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def model_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    files, folder = _store(spark, f"{root.rstrip('/')}/{name}")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())


def register_model(spark: SparkSession, model: PipelineModel, root: str, name: str) -> int:
    """Save under the next version, which is claimed first.

    Of registrations at the same time each gets a version of its own; no existing one
    is ever replaced. A registration that dies leaves its version out.
    """
    folder = f"{root.rstrip('/')}/{name}"
    version = max(model_versions(spark, root, name), default=0) + 1
    while not claim(spark, f"{folder}/_claims/v{version}"):
        version += 1
    model.write().save(f"{folder}/v{version}")
    return version


def load_model(root: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}/v{version}")


def logged(model: PipelineModel, root: str, run_id: str) -> PipelineModel:
    """Keep a run's model and go on with the stored form.

    A freshly fitted model drags its training summary, and with it the session,
    into every task; the stored one has its parameters only.
    """
    path = f"{root.rstrip('/')}/_runs/{run_id}"
    model.write().save(path)
    return PipelineModel.load(path)


# --- the training job ---------------------------------------------------------


def spread(rows: DataFrame, n: int, key: str = "account_id") -> DataFrame:
    """The ``n`` rows over as many partitions as a fit can use.

    Each tree takes a pass a level. Written as the shuffle before leaves them, so few
    bytes lie in one file or some, and every pass runs in as many tasks.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    most = max(2 * cores, math.ceil(n / FILE_ROWS))
    return rows.repartition(max(1, min(n // TASK_ROWS, most)), key)


def train(
    features: DataFrame,
    model_root: str,
    settings: TrainingSettings = TrainingSettings(),
    registered_name: str = REGISTERED_MODEL,
    with_importance: bool = True,
) -> TrainingResult:
    """Fit both models, keep the one with the larger AUC, register and explain it.

    The split is written once, and so are the training rows as encoded for both
    models: every pass of the iterative fits reads vectors from storage. Fitted
    parameters and metric rows are all that reaches the driver.
    """
    spark = features.sparkSession
    split = staged(with_split(features), "split")
    train_rows = split.filter(~F.col("is_test")).drop("is_test")
    test_rows = split.filter("is_test").drop("is_test")
    sizes = {r.is_test: r["count"] for r in split.groupBy("is_test").count().collect()}
    n_train, n_test = sizes.get(False, 0), sizes.get(True, 0)

    candidates = {
        BASELINE_MODEL: baseline_model(n_train, settings),
        BOOSTED_MODEL: boosted_model(settings),
    }
    fitted: dict[str, PipelineModel] = {}
    measured: dict[str, dict[str, float]] = {}
    runs: dict[str, str] = {}
    encoding = encoders().fit(train_rows)
    encoded = staged(
        encoding.transform(spread(train_rows, n_train)).select(LABEL, SCALED_VECTOR, VECTOR),
        "encoded",
    )
    for name, estimator in candidates.items():
        runs[name] = uuid.uuid4().hex
        model = PipelineModel(stages=[*encoding.stages, estimator.fit(encoded)])
        fitted[name] = logged(model, model_root, runs[name])
        measured[name] = model_metrics(staged(scored(fitted[name], test_rows), "scores"))
    areas = spark.createDataFrame(
        [(k, name, measured[name]["auc"]) for k, name in enumerate(candidates)],
        "position int, model string, auc double",
    )
    best = champion(areas).first().model

    version = register_model(spark, fitted[best], model_root, registered_name)
    columns = ("auc", "accuracy", "precision", "recall", "f1")
    metrics = spark.createDataFrame(
        [
            (name, runs[name], *(round(m[c], 4) if m[c] is not None else None for c in columns))
            for name, m in measured.items()
        ],
        "model string, run_id string, " + ", ".join(f"{c} double" for c in columns),
    )
    best_auc = measured[best]["auc"]
    status = spark.createDataFrame(
        [(best, round(best_auc, 4) if best_auc is not None else None, registered_name, version,
          n_train, n_test)],
        "best_model string, best_auc double, registered_model string, version int, "
        "n_train bigint, n_test bigint",
    )
    importance = (
        permutation_importance(fitted[best], test_rows, seed=settings.seed)
        if with_importance
        else spark.createDataFrame([], "feature string, importance double")
    )
    return TrainingResult(metrics, importance, status, fitted[best])
