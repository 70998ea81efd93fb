from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import AS_OF, days
from renewlens import schemas
from renewlens.operators.ranking import dense_index, latest_per_key, number_rows
from renewlens.operators.split import stratified_split
from renewlens.plans.features import account_features, with_split
from renewlens.session import shared_folder


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_positions_follow_the_digest(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("d"))
    got = [r.n for r in dense_index(df, "d", "n").orderBy("d").collect()]
    assert got == list(range(500))


def test_positions_restart_in_every_group(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("d")
    )
    numbered = dense_index(df, "d", "n", ["g"]).groupBy("g").agg(
        F.min("n"), F.max("n"), F.count_distinct("n")
    )
    assert {tuple(r)[1:] for r in numbered.collect()} == {(0, 99, 100)}


def test_rows_without_any_key_are_numbered(spark):
    copies = spark.range(0, 1000, 1, 7).select(F.lit("same").alias("x"))
    got = sorted(r.n for r in number_rows(copies, "n").collect())
    assert got == list(range(1000))


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    latest = latest_per_key(df, ["k"], [F.col("id").desc()])
    assert {(r.k, r.id) for r in latest.collect()} == {(0, 998), (1, 999)}
    plan = _plan(latest)
    assert plan.index("Partial") > plan.index("Exchange")


def test_checkpoint_folder_is_taken_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    else:
        assert shared_folder(spark).startswith("/tmp")


def _silver(spark, *rows):
    """Rows of (account, subscription, revenue, renewal offset, industry)."""
    return spark.createDataFrame(
        [
            {f.name: None for f in schemas.SILVER}
            | {
                "account_id": a,
                "subscription_id": s,
                "monthly_recurring_revenue": m,
                "renewal_date": None if d is None else days(d),
                "industry": i,
                "contract_start_date": days(-30),
                "status": "active",
                "is_churned": False,
            }
            for a, s, m, d, i in rows
        ],
        schemas.SILVER,
    )


def test_features_take_the_latest_subscription(spark):
    df = _silver(
        spark,
        ("A", "S2", -5.0, 3, "Retail"),
        ("A", "S1", 9.0, 1, "Retail"),
        ("A", "S9", 9.0, None, "Retail"),
        ("B", "S4", 4.0, 2, None),
        ("B", "S3", None, 2, None),
    )
    rows = {r.account_id: r for r in account_features(df, AS_OF).collect()}
    assert rows["A"].monthly_recurring_revenue == 0.0
    assert rows["A"].tenure_days == 30
    assert rows["B"].monthly_recurring_revenue == 0.0
    assert rows["B"].industry == rows["B"].country == "Unknown"
    assert rows["A"].is_churned == 0


def test_one_feature_row_per_account(spark):
    df = _silver(spark, *(("A", "S", 1.0, 0, f"I{i}") for i in range(20)))
    assert account_features(df, AS_OF).count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.lists(st.integers(0, 60), min_size=1, max_size=3), fraction=st.floats(0, 1))
def test_split_equals_ranking_every_label(spark, sizes, fraction):
    import hashlib

    rows = [(label, f"K{label}-{i}") for label, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "y int, k string")
    got = {(r.y, r.k) for r in stratified_split(df, "y", "k", fraction).filter("is_test").collect()}
    want = set()
    for label, n in enumerate(sizes):
        keys = sorted((hashlib.md5(k.encode()).hexdigest(), k) for y, k in rows if y == label)
        quota = int(fraction * n + 0.5)
        want |= {(label, k) for _, k in keys[:quota]}
    assert got == want


def test_split_moves_no_wide_rows(spark, tmp_path):
    path = str(tmp_path / "features")
    rows = [(f"A{i}", i % 2, "x" * 10) for i in range(200)]
    spark.createDataFrame(rows, "account_id string, is_churned int, wide string").write.parquet(path)
    split = with_split(spark.read.parquet(path))
    plan = _plan(split)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert split.filter("is_test").count() == 40
    assert exchanges and not any("wide" in line for line in exchanges)
    assert plan.count("wide") and plan.count("FileScan parquet [account_id#") == 3
