import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from renewlens import catalog, schemas
from renewlens.plans import scoring, training
from renewlens.session import fresh_path

SETTINGS = training.TrainingSettings(trees=5, depth=3)


@pytest.fixture(scope="module")
def features(spark):
    """Label driven by pages viewed; the other columns are noise."""
    n = F.col("id")
    pages = F.pmod(F.xxhash64(n, F.lit("pages")), F.lit(100))
    noise = F.pmod(F.xxhash64(n, F.lit("noise")), F.lit(10))
    frame = spark.range(1200).select(
        F.concat(F.lit("ACC-"), F.lpad(n.cast("string"), 6, "0")).alias("account_id"),
        (pages + noise < 50).cast("int").alias("is_churned"),
        F.element_at(F.array(*(F.lit(p) for p in schemas.PLAN_ORDER)), (n % 3 + 1).cast("int"))
        .alias("plan_type"),
        F.concat(F.lit("I"), n % 4).alias("industry"),
        F.concat(F.lit("C"), n % 5).alias("country"),
        (n % 700).cast("int").alias("tenure_days"),
        (n % 97).cast("double").alias("monthly_recurring_revenue"),
        (n % 13).alias("total_events_90d"),
        (n % 11).cast("double").alias("total_session_minutes_90d"),
        pages.alias("total_pages_viewed_90d"),
    )
    path = fresh_path(spark, "test-features")
    frame.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def trained(spark, features):
    root = fresh_path(spark, "test-models")
    return root, training.train(features, root, SETTINGS)


def test_models_find_the_planted_signal(trained):
    rows = {r.model: r for r in trained[1].metrics.collect()}
    assert set(rows) == {schemas.BASELINE_MODEL, schemas.BOOSTED_MODEL}
    assert all(r.auc > 0.95 for r in rows.values())
    assert all(0 <= r[c] <= 1 for r in rows.values() for c in ("accuracy", "precision", "recall", "f1"))
    assert len({r.run_id for r in rows.values()}) == 2


def test_queries_train_with_the_settings_of_the_job():
    assert catalog.SETTINGS == training.TrainingSettings()
    assert catalog.SETTINGS.trees == 100


def test_encoders_are_fitted_once(trained):
    root, result = trained
    stores = [training.PipelineModel.load(f"{root}/_runs/{r.run_id}") for r in result.metrics.collect()]
    first, second = ([s.uid for s in m.stages[:-1]] for m in stores)
    assert first == second


def test_status_row(trained):
    root, result = trained
    status = result.status.first()
    best = max(result.metrics.collect(), key=lambda r: r.auc)
    assert status.best_auc == best.auc
    assert (status.registered_model, status.version) == (schemas.REGISTERED_MODEL, 1)
    assert status.n_train + status.n_test == 1200
    assert status.n_test == pytest.approx(240, abs=1)


def test_importance_ranks_the_planted_feature_first(trained):
    rows = trained[1].importance.collect()
    assert {r.feature for r in rows} == set(schemas.FEATURES)
    assert rows[0].feature == "total_pages_viewed_90d"
    assert rows[0].importance > 0.3
    assert all(abs(r.importance) < 0.05 for r in rows[1:])
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_each_row_gives_and_receives_once_per_repeat(features):
    pairs = training.shuffled_pairs(features, "account_id", 3, 42)
    counts = pairs.groupBy("repeat").agg(
        F.count("*").alias("n"), F.count_distinct("account_id").alias("to"),
        F.count_distinct("donor_key").alias("from"),
        F.count_if(F.col("account_id") == F.col("donor_key")).alias("same"),
    ).collect()
    assert {(r.n, r.to, r["from"]) for r in counts} == {(1200, 1200, 1200)}
    assert all(r.same < 20 for r in counts)
    # The repeats are different permutations.
    both = pairs.groupBy("account_id").agg(F.count_distinct("donor_key").alias("d"))
    assert both.filter("d = 3").count() > 1150


def test_versions_are_kept_and_reload_equally(spark, features, trained):
    root, result = trained
    name = "versions"
    assert training.model_versions(spark, root, name) == []
    assert training.register_model(spark, result.winner, root, name) == 1
    assert training.register_model(spark, result.winner, root, name) == 2
    assert training.model_versions(spark, root, name) == [1, 2]
    again = training.load_model(root, name, 2)
    left = training.scored(result.winner, features).select("account_id", training.SCORE)
    right = training.scored(again, features).select("account_id", training.SCORE)
    assert left.exceptAll(right).count() == 0


def test_unseen_category_becomes_zeros(features, trained):
    model = trained[1].winner
    odd = features.limit(1).withColumn("industry", F.lit("never seen"))
    hot = model.transform(odd).select(vector_to_array("_industry_hot").alias("v")).first().v
    assert hot == [0.0] * 4
    seen = model.transform(features.limit(50)).select(vector_to_array("_industry_hot").alias("v"))
    assert all(sum(r.v) == 1.0 for r in seen.collect())


def test_scores_cover_current_accounts_only(features, trained):
    risks = scoring.score_accounts(features, trained[1].winner)
    assert risks.columns == list(scoring.RISK_COLUMNS)
    assert risks.count() == features.filter("is_churned = 0").count()
    assert risks.filter("churn_risk <> bround(churn_risk, 4)").count() == 0
    assert risks.filter("risk_band IS NULL").count() == 0


def test_ranking_counts_and_revenue(spark):
    rows = [("A", 0.9, "High", 10.0), ("C", 0.9, "High", 5.0), ("B", 0.2, "Low", 1.0),
            ("D", 0.2, "Low", 1.0), ("E", 0.1, "Low", None)]
    df = spark.createDataFrame(
        rows, "account_id string, churn_risk double, risk_band string, "
        "monthly_recurring_revenue double"
    )
    assert [r.account_id for r in scoring.ranked(df).collect()] == ["A", "C", "B", "D", "E"]
    assert [r.account_id for r in scoring.top_risks(df, 2).collect()] == ["A", "C"]
    assert [(r.risk_band, r.account_count, r.mrr) for r in scoring.band_counts(df).collect()] == [
        ("Low", 3, 2.0), ("High", 2, 15.0)
    ]
    assert tuple(scoring.revenue_at_risk(df).first()) == (2, 15.0)
    assert tuple(scoring.revenue_at_risk(df.filter("risk_band = 'Low'")).first()) == (0, 0.0)
    plan = scoring.top_risks(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_every_pass_over_many_rows_runs_in_several_tasks(spark, features, monkeypatch):
    kept = {}

    def keep(df, name, write=training.staged):
        # As few bytes as these lie in one file on larger tables, too.
        kept[name] = write(df.coalesce(1) if name == "split" else df, name)
        return kept[name]

    monkeypatch.setattr(training, "staged", keep)
    key = F.concat("account_id", F.lit("-"), F.col("copy").cast("string"))
    many = features.crossJoin(spark.range(34).withColumnRenamed("id", "copy"))
    many = many.withColumn("account_id", key).drop("copy")
    root = fresh_path(spark, "test-models")
    settings = training.TrainingSettings(max_iterations=2, trees=1, depth=1)
    status = training.train(many, root, settings, with_importance=False).status.first()
    parts = kept["encoded"].rdd.glom().map(len).collect()
    assert sum(parts) == status.n_train > 32_000
    assert len([n for n in parts if n]) >= 2
    assert max(parts) < 0.7 * sum(parts)


def test_few_rows_stay_in_one_task(spark):
    rows = spark.range(100).withColumn("account_id", F.col("id").cast("string"))
    for n in (0, 1, 100):
        assert training.spread(rows, n).rdd.getNumPartitions() == 1
