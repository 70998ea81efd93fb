import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from renewlens.operators import evaluation
from renewlens.operators.evaluation import champion, confusion_metrics, roc_auc


def _pairwise(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 1), st.one_of(st.sampled_from([0.1, 0.5]), st.floats(0, 1))),
        max_size=60,
    )
)
def test_auc_is_the_share_of_ordered_pairs(spark, rows):
    df = spark.createDataFrame(rows, "y int, s double")
    got = roc_auc(df, "y", "s").first().auc
    want = _pairwise(rows)
    assert got == want if want is None else got == pytest.approx(want, abs=1e-12)


def test_auc_over_many_slices_and_groups(spark):
    df = spark.range(6000).select(
        (F.col("id") % 2).alias("g"),
        (F.rand(1) < 0.4).cast("int").alias("y"),
        F.round(F.rand(2), 3).alias("s"),
    ).cache()
    rows = df.collect()
    got = {r.g: r.auc for r in roc_auc(df, "y", "s", ["g"]).collect()}
    for g in (0, 1):
        assert got[g] == pytest.approx(_pairwise([(r.y, r.s) for r in rows if r.g == g]), abs=1e-12)
    df.unpersist()


def test_auc_equals_the_library_evaluator(spark):
    df = spark.range(5000).select(
        (F.rand(3) < 0.3).cast("double").alias("y"), F.rand(4).alias("s")
    ).cache()
    library = BinaryClassificationEvaluator(
        rawPredictionCol="s", labelCol="y", numBins=0
    ).evaluate(df)
    assert roc_auc(df, "y", "s").first().auc == pytest.approx(library, abs=1e-12)
    df.unpersist()


def test_one_hot_score_does_not_fill_one_slice(spark):
    """Scores crowded into a sliver still fall into many slices."""
    df = spark.range(20000).select(
        (F.rand(5) < 0.5).cast("int").alias("y"), (F.lit(0.3) + F.rand(6) / 1e6).alias("s")
    )
    plan = roc_auc(df, "y", "s")
    assert plan.first().n_positive + plan.first().n_negative == 20000
    assert evaluation.SLICES > 100


def test_confusion_at_the_threshold(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.49), (0, 0.5), (0, 0.1)], "y int, s double")
    r = confusion_metrics(df, "y", "s").first()
    assert (r.tp, r.fn, r.fp, r.tn) == (1, 1, 1, 1)
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.5, 0.5, 0.5)


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1)], "y int, s double")
    r = confusion_metrics(df, "y", "s").first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (1.0, 0.0, 0.0, 0.0)


def test_first_model_wins_a_tie(spark):
    rows = [(0, "a", 0.7), (1, "b", 0.7), (2, "c", 0.6), (3, "d", None)]
    df = spark.createDataFrame(rows, "position int, model string, auc double")
    assert champion(df).first().model == "a"
    assert champion(df.filter("position > 1")).first().model == "c"
