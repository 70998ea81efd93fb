from pyspark.sql import functions as F

from frames import accounts, events, subscriptions
from renewlens import schemas
from renewlens.sources.tables import append_table, freshness, overwrite_table, snapshot_table
from renewlens.streaming.bronze import append_new, read_appended


def _add(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def test_each_run_takes_new_rows_only(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "bronze", "offsets"))

    def run():
        stream = read_appended(spark, source, schemas.SUBSCRIPTIONS)
        return append_new(stream, target, checkpoint, schemas.BRONZE_SUBSCRIPTIONS_RULES)

    _add(subscriptions(spark, ("S1", "A", 1.0, "active", 0), (None, "A", 1.0, "active", 0)), source)
    assert run() == {"total_rows": 2, "valid_subscription_id": 1}
    assert spark.read.parquet(target).count() == 1
    assert run() == {"total_rows": 0, "valid_subscription_id": 0}
    assert spark.read.parquet(target).count() == 1
    _add(subscriptions(spark, ("S2", "A", 1.0, "active", 0), ("S3", "B", 1.0, "trial", 0)), source)
    assert run() == {"total_rows": 2, "valid_subscription_id": 0}
    assert {r.subscription_id for r in spark.read.parquet(target).collect()} == {"S1", "S2", "S3"}


def test_many_small_batches_are_all_counted(spark, tmp_path):
    source = str(tmp_path / "source")
    for i in range(6):
        _add(accounts(spark, f"A{i}", None), source)
    counts = append_new(
        read_appended(spark, source, schemas.ACCOUNTS, max_files=1),
        str(tmp_path / "bronze"),
        str(tmp_path / "offsets"),
        schemas.BRONZE_ACCOUNTS_RULES,
    )
    assert counts == {"total_rows": 12, "valid_account_id": 6}


def test_partitioned_sink_writes_few_files_per_day(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "bronze")
    rows = [(f"E{i}", "A", -(i % 4), 1.0, 1) for i in range(400)]
    events(spark, *rows).repartition(8).write.parquet(source)
    append_new(
        read_appended(spark, source, schemas.USAGE_EVENTS),
        target,
        str(tmp_path / "offsets"),
        schemas.BRONZE_USAGE_EVENTS_RULES,
        partition_by=("event_date",),
        files_per_partition=2,
    )
    read = spark.read.parquet(target)
    assert read.count() == 400
    files = read.select("event_date", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("event_date").count().agg(F.max("count")).first()[0] <= 2


def test_batch_sinks(spark):
    append_table(spark.range(3), "sink_case")
    append_table(spark.range(2), "sink_case")
    assert spark.table("sink_case").count() == 5
    overwrite_table(spark.range(1).select(F.lit("x").alias("other")), "sink_case")
    assert spark.table("sink_case").columns == ["other"]
    snapshot_table(spark, "sink_case", "sink_copy")
    snapshot_table(spark, "sink_case", "sink_copy")
    assert spark.table("sink_copy").count() == 1


def test_freshness_is_the_last_file_or_now(spark, tmp_path):
    path = str(tmp_path / "t")
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    spark.range(5).write.parquet(path)
    first = freshness(spark, path).first().refreshed_at
    assert abs((first - now).total_seconds()) < 60
    spark.range(5).write.mode("append").parquet(path)
    assert freshness(spark, path).first().refreshed_at >= first
    empty = tmp_path / "empty"
    empty.mkdir()
    assert freshness(spark, str(empty)).first().refreshed_at >= now
