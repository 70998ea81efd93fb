import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from renewlens import schemas
from renewlens.operators.quality import (
    DROP,
    FAIL,
    Expectation,
    ExpectationFailed,
    gate,
    raise_on_failure,
    violation_counts,
)
from renewlens.sources.tables import publish

STATUS = Expectation("valid_status", "status IN ('active','churned','trial')", DROP)
REVENUE = Expectation("non_negative", "mrr >= 0")


def _frame(spark, rows):
    return spark.createDataFrame(rows, "status string, mrr double")


def test_drop_removes_false_and_null(spark):
    df = _frame(spark, [("active", 1.0), ("churned", 1.0), ("trial", 1.0), ("paused", 1.0), (None, 1.0)])
    kept = {r.status for r in gate(df, [STATUS]).collect()}
    assert kept == {"active", "churned", "trial"}


def test_warn_keeps_rows_and_counts_null(spark):
    df = _frame(spark, [("active", -1.0), ("active", 0.0), ("active", 10.0), ("active", None)])
    assert gate(df, [REVENUE]).count() == 4
    assert violation_counts(df, "t", [REVENUE]).first().violations == 2


def test_rules_are_counted_before_rows_are_dropped(spark):
    df = _frame(spark, [("paused", -1.0), ("active", -1.0), ("paused", 1.0)])
    seen = Observation()
    kept = gate(df, [STATUS, REVENUE], seen).collect()
    assert len(kept) == 1
    assert seen.get == {"total_rows": 3, "valid_status": 2, "non_negative": 2}


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Expectation("x", "TRUE", "IGNORE")


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["active", "paused", None]),
            st.one_of(st.none(), st.floats(-5, 5)),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_kept_plus_dropped_is_everything(spark, rows):
    df = _frame(spark, rows)
    kept = gate(df, [STATUS])
    dropped = violation_counts(df, "t", [STATUS]).first().violations
    assert kept.count() + dropped == len(rows)
    assert gate(kept, [STATUS]).count() == kept.count()


def _silver_row(spark, key):
    values = {f.name: None for f in schemas.SILVER} | {"account_id": key, "status": "active"}
    return spark.createDataFrame([values], schemas.SILVER)


def test_failed_update_leaves_the_published_table_alone(spark, tmp_path):
    def update(df):
        return publish(df, "fail_case", str(tmp_path), schemas.SILVER, schemas.SILVER_RULES)

    update(_silver_row(spark, "ACC-1"))
    with pytest.raises(ExpectationFailed) as failure:
        update(_silver_row(spark, None))
    assert failure.value.violations == {"account_id_present": 1}
    assert [r.account_id for r in spark.table("fail_case").collect()] == ["ACC-1"]
    update(_silver_row(spark, "ACC-2"))
    assert [r.account_id for r in spark.table("fail_case").collect()] == ["ACC-2"]


def test_gold_count_rule_fails(spark, tmp_path):
    empty = spark.createDataFrame([("Growth", "Retail", 1.0, 1.0, 0, 0)], schemas.GOLD)
    with pytest.raises(ExpectationFailed):
        publish(empty, "gold_fail", str(tmp_path), schemas.GOLD, schemas.GOLD_RULES)
    assert not spark.catalog.tableExists("gold_fail")


def test_published_table_carries_types_and_comments(spark, tmp_path):
    row = spark.createDataFrame([("Growth", "Retail", 1.0, 1.0, 1, 0)], schemas.GOLD)
    publish(row, "gold_doc", str(tmp_path), schemas.GOLD, schemas.GOLD_RULES, "it's gold")
    read = spark.table("gold_doc").schema
    assert [(f.name, f.dataType) for f in read] == [(f.name, f.dataType) for f in schemas.GOLD]
    assert [f.metadata["comment"] for f in read] == [f.metadata["comment"] for f in schemas.GOLD]


def test_only_fail_rules_raise():
    raise_on_failure("t", [STATUS, REVENUE], {"valid_status": 3, "non_negative": 1})
    rule = Expectation("must", "TRUE", FAIL)
    raise_on_failure("t", [rule], {})
    with pytest.raises(ExpectationFailed):
        raise_on_failure("t", [rule], {"must": 1})


def test_gate_without_counts_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    _frame(spark, [("active", 1.0)]).write.parquet(path)
    plain = gate(spark.read.parquet(path), [STATUS]).select("mrr").where(F.col("mrr") > 0)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "In(status, [active,churned,trial])" in plan
