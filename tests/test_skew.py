from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from renewlens import catalog
from renewlens.operators.skew import (
    LINE,
    Layout,
    balanced_inner_join,
    heavy_keys,
    input_bytes,
    is_plain_scan,
    layout_for,
)


def _skewed(spark, n=9000):
    key = F.when(F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") % 2000).cast("string"))
    return spark.range(n).select(key.alias("k"), "id")


def test_a_third_of_the_rows_is_heavy(spark):
    found = heavy_keys(_skewed(spark), "k", parts=30, small=0, min_rows=100)
    assert set(found) == {"HOT"} and found["HOT"] >= 10


def test_even_keys_and_nulls_are_not_heavy(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 2 == 0, (F.col("id") % 1000).cast("string")).alias("k")
    )
    assert heavy_keys(df, "k", parts=30, small=0, min_rows=100) == {}


def test_empty_frame(spark):
    assert heavy_keys(spark.createDataFrame([], "k string"), "k", small=0, min_rows=100) == {}


def test_small_files_are_not_searched(spark, tmp_path):
    path = str(tmp_path / "t")
    _skewed(spark).write.parquet(path)
    read = spark.read.parquet(path)
    assert 0 < input_bytes(read) < 1_000_000
    assert heavy_keys(read, "k") == {}
    assert set(heavy_keys(read, "k", small=0, min_rows=100)) == {"HOT"}


def test_heavy_rows_are_spread_over_tasks(spark):
    left, right = _skewed(spark), spark.createDataFrame([("HOT", 1), ("2", 2)], "k string, v int")
    layout = layout_for(left, right, "k", parts=16, small=0, min_rows=100)
    placed = layout.left(left).filter("k = 'HOT'").groupBy("_line").count().collect()
    assert len(placed) >= 5
    assert max(r["count"] for r in placed) < 1000


def test_cells_do_not_depend_on_row_order_after_a_shuffle(spark, tmp_path):
    _skewed(spark, 600).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert is_plain_scan(scan.filter("id > 1"))
    layout = Layout("k", {"HOT": (5, 1)})
    frames = [scan.repartition(n, *by) for n, by in ((4, ("id",)), (7, ("k", "id")))]
    assert not any(is_plain_scan(f) for f in frames)
    first, second = (layout.left(f).select("k", "id", "_line") for f in frames)
    assert first.exceptAll(second).count() == 0
    assert first.select("_line").distinct().count() == 5
    # Exact copies in a stored table are told apart.
    spark.range(600).select(F.lit("HOT").alias("k")).write.parquet(str(tmp_path / "copies"))
    copies = layout.left(spark.read.parquet(str(tmp_path / "copies")))
    assert copies.select("_line").distinct().count() == 5


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(st.sampled_from("abc"), max_size=12),
    right=st.lists(st.sampled_from("abd"), max_size=12),
    pieces=st.dictionaries(
        st.sampled_from("abcd"), st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=3
    ),
)
def test_any_layout_gives_the_plain_join(spark, left, right, pieces):
    ldf = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k string, l int")
    rdf = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "k string, r int")
    got = balanced_inner_join(ldf, rdf, "k", Layout("k", pieces))
    assert got.columns == ["k", "l", "r"]
    want = Counter((k, i, j) for i, k in enumerate(left) for j, m in enumerate(right) if k == m)
    assert Counter((r.k, r.l, r.r) for r in got.collect()) == want


@pytest.mark.parametrize("pieces", [{}, {"HOT": (6, 1)}])
def test_join_keeps_integer_keys(spark, pieces):
    left = spark.range(20).select((F.col("id") % 2).alias("k"), "id")
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k bigint, v string")
    layout = Layout("k", {0: v for v in pieces.values()})
    assert balanced_inner_join(left, right, "k", layout).count() == 20


def test_silver_spreads_a_heavy_account(spark):
    found = catalog.silver_one_heavy_account(spark, "/root/testdata/sf0.001")
    assert LINE in found._jdf.queryExecution().optimizedPlan().toString()
    rows = found.groupBy("account_id").count().orderBy(F.desc("count")).first()
    assert rows.account_id == "ACC-000000001" and rows["count"] > found.count() / 5
