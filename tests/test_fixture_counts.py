"""Known row counts of the mapped test tables at the next larger scale."""

import pytest
from pyspark.sql import functions as F

from renewlens import catalog

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "name, rows",
    [
        ("bronze_accounts", 1421),
        ("bronze_subscriptions", 14211),
        ("bronze_usage_events", 9411),
        ("usage_90d", 150),
        ("silver_account_health", 12262),
        ("gold_mrr_by_plan_industry", 15),
        ("account_features", 1419),
    ],
)
def test_row_counts(spark, name, rows):
    assert catalog.queries()[name](spark, FOLDER).count() == rows


def test_silver_violations(spark):
    rows = catalog.dq_silver_counts(spark, FOLDER).collect()
    assert {r.constraint_name: r.violations for r in rows} == {
        "account_id_present": 0,
        "valid_status": 1211,
        "non_negative_mrr": 1037,
    }
    assert {r.total_rows for r in rows} == {13473}


def test_split_sizes(spark):
    split = catalog.train_test_split(spark, FOLDER).filter("is_test")
    assert split.agg(F.count("*"), F.sum("is_churned")).first()[:] == (284, 97)


def test_every_segment_has_more_churned_rows_than_accounts(spark):
    gold = catalog.gold_mrr_by_plan_industry(spark, FOLDER)
    assert gold.filter("churned_account_count > account_count").count() == 15


def test_fixed_score_figures(spark):
    counts = catalog.confusion_metrics(spark, FOLDER).first()
    assert (counts.tp, counts.fp, counts.fn, counts.tn) == (318, 625, 167, 309)
    assert catalog.roc_auc(spark, FOLDER).first().auc == pytest.approx(0.485741, abs=1e-6)
    bands = {r.risk_band: r.account_count for r in catalog.risk_band_counts(spark, FOLDER).collect()}
    assert bands == {"High": 332, "Medium": 412, "Low": 190}
