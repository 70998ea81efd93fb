"""Runs that die, tables that belong together, late events and served tables."""

import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from frames import AS_OF, accounts, days, events, subscriptions
from renewlens import schemas
from renewlens.operators.quality import ExpectationFailed
from renewlens.plans import refresh as job
from renewlens.plans import training
from renewlens.plans.health import usage_90d, usage_90d_from_daily
from renewlens.sources import tables
from renewlens.streaming import bronze, ledger


class Died(RuntimeError):
    pass


@pytest.fixture
def config(spark, tmp_path):
    name = uuid.uuid4().hex[:8]
    for schema in (f"src_{name}", f"out_{name}"):
        spark.sql(f"CREATE SCHEMA {schema}")
    return job.RefreshConfig(
        f"src_{name}", f"out_{name}", str(tmp_path / "out"), AS_OF, keep_versions=2
    )


def _sources(spark, config, tag, day=-1):
    tables.append_table(accounts(spark, f"{tag}1", None), config.source("accounts"))
    tables.append_table(
        subscriptions(spark, (f"S{tag}", f"{tag}1", 10.0, "active", 0)),
        config.source("subscriptions"),
    )
    rows = [(f"E{tag}", "A1", day, 2.5, 3), (None, "A1", day, 1.0, 1)]
    tables.append_table(events(spark, *rows), config.source("usage_events"))


def _logged(spark, config, table, metric):
    log = spark.table(config.table(job.QUALITY_LOG))
    chosen = log.filter((F.col("table_name") == table) & (F.col("metric") == metric))
    return chosen.agg(F.sum("row_count")).first()[0]


@pytest.mark.parametrize("where", ["before the entry", "after the entry"])
def test_a_run_that_dies_is_counted_once(spark, config, tmp_path, monkeypatch, where):
    """Killed in its second micro-batch: the next run's log has every row once."""
    for tag in "ABCD":
        _sources(spark, config, tag)
    whole, calls = ledger.complete, []
    monkeypatch.setattr(
        job, "read_appended_table", lambda s, t: bronze.read_appended_table(s, t, max_files=1)
    )

    def dying(spark_, target, query, batch, counts):
        if "accounts" in target:
            calls.append(batch)
            if len(calls) == 2 and where == "before the entry":
                raise Died
        whole(spark_, target, query, batch, counts)
        if "accounts" in target and len(calls) == 2:
            raise Died

    monkeypatch.setattr(ledger, "complete", dying)
    with pytest.raises(Exception, match="Died"):
        job.refresh(spark, config)
    known = 1 if where == "before the entry" else 2
    folder = config.folder("bronze_accounts")
    table = job.BRONZE_TABLES[0]
    files = len(ledger.entries(spark, folder).collect())
    assert files == known
    # Rows of a batch without an entry are not seen.
    total = ledger.logged_counts(spark, folder).filter("metric = 'total_rows'")
    seen = total.agg(F.sum("row_count")).first()[0]
    assert job.read_bronze(spark, config, table).count() == seen - _violations(spark, folder)

    monkeypatch.setattr(ledger, "complete", whole)
    metrics = job.refresh(spark, config)
    assert metrics["bronze_accounts"] == {"total_rows": 8, "valid_account_id": 4}
    assert job.read_bronze(spark, config, table).count() == 4
    assert spark.table(config.table("bronze_accounts")).count() == 4
    job.refresh(spark, config)
    assert _logged(spark, config, "bronze_accounts", "total_rows") == 8
    assert _logged(spark, config, "bronze_accounts", "valid_account_id") == 4


def _violations(spark, folder):
    counts = ledger.logged_counts(spark, folder).filter("metric = 'valid_account_id'")
    return counts.agg(F.sum("row_count")).first()[0]


def test_gold_that_breaks_a_rule_leaves_silver(spark, config, tmp_path, monkeypatch):
    _sources(spark, config, "A")
    job.refresh(spark, config)
    silver, gold = config.table(job.SILVER_TABLE), config.table(job.GOLD_TABLE)
    before = spark.table(silver).collect(), spark.table(gold).collect()
    never = schemas.Expectation("never", "1 = 0", schemas.FAIL)
    _sources(spark, config, "B")
    with monkeypatch.context() as m:
        m.setattr(schemas, "GOLD_RULES", (*schemas.GOLD_RULES, never))
        with pytest.raises(ExpectationFailed):
            job.refresh(spark, config)
    assert (spark.table(silver).collect(), spark.table(gold).collect()) == before
    assert len(os.listdir(tmp_path / "out" / job.SILVER_TABLE)) == 1
    assert _logged(spark, config, job.GOLD_TABLE, "never") == 1
    job.refresh(spark, config)
    assert spark.table(silver).count() == 2


def test_a_publication_that_died_is_finished(spark, tmp_path, monkeypatch):
    a, b = (f"pair_{uuid.uuid4().hex[:8]}_{x}" for x in "ab")
    root = str(tmp_path)

    def pair(n):
        df = spark.createDataFrame([(i,) for i in range(n)], "id long")
        return [
            tables.Publication(a, lambda _: df, df.schema),
            tables.Publication(b, lambda staged: staged[a], df.schema),
        ]

    tables.publish_all(spark, pair(2), root)
    point = tables.point_view

    def dying(spark_, table, *rest):
        if table == b:
            raise Died
        point(spark_, table, *rest)

    monkeypatch.setattr(tables, "point_view", dying)
    with pytest.raises(Died):
        tables.publish_all(spark, pair(3), root)
    monkeypatch.setattr(tables, "point_view", point)
    assert (spark.table(a).count(), spark.table(b).count()) == (3, 2)
    tables.finish_publications(spark, root)
    assert (spark.table(a).count(), spark.table(b).count()) == (3, 3)
    assert tables.list_names(spark, f"{root}/{tables.PENDING}") == []


def test_late_events_are_in_the_window(spark, config):
    _sources(spark, config, "A", day=-1)
    job.refresh(spark, config)
    _sources(spark, config, "B", day=-40)  # late, of a day that nobody has touched
    _sources(spark, config, "C", day=-1)
    _sources(spark, config, "D", day=-91)  # too old
    job.refresh(spark, config)
    direct = usage_90d(job.read_bronze(spark, config, job.BRONZE_TABLES[2]), AS_OF)
    rolled = usage_90d_from_daily(job.read_daily_usage(spark, config), AS_OF)
    assert rolled.collect() == direct.collect()
    assert rolled.first().usage_event_count_90d == 3
    by_day = job.read_daily_usage(spark, config).groupBy("event_date").count()
    assert {r.event_date: r["count"] for r in by_day.collect()} == {
        days(-1): 2, days(-40): 1, days(-91): 1
    }


def test_readers_never_miss_a_table_that_is_replaced(spark, tmp_path):
    name, root = f"served_{uuid.uuid4().hex[:8]}", str(tmp_path)
    tables.overwrite_table(spark.range(5), name, root)
    failures, counts, done = [], set(), threading.Event()

    def read():
        while not done.is_set():
            try:
                counts.add(spark.table(name).count())
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(6, 14):
        tables.overwrite_table(spark.range(n), name, root)
    done.set()
    reader.join()
    assert not failures and counts <= set(range(5, 14)) and len(counts) > 1
    tables.prune_versions(spark, name, root, 2)
    assert len(os.listdir(tmp_path / name)) == 2 and spark.table(name).count() == 13


def test_an_incomplete_batch_does_not_move_the_time(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3).write.parquet(source)
    stream = bronze.read_appended(spark, source, spark.range(1).schema)
    bronze.append_new(stream, target, str(tmp_path / "at"))
    first = ledger.committed_freshness(ledger.entries(spark, target)).first()[0]
    query = ledger.entries(spark, target).first()[ledger.QUERY]
    assert query and query != "None"
    spark.range(9).write.parquet(ledger.batch_folder(target, query, 7))
    assert ledger.committed_freshness(ledger.entries(spark, target)).first()[0] == first
    assert ledger.committed_rows(spark, target, spark.range(1).schema).count() == 3
    ledger.complete(spark, target, query, 7, {"total_rows": 9})
    assert ledger.committed_freshness(ledger.entries(spark, target)).first()[0] > first
    assert ledger.committed_rows(spark, target, spark.range(1).schema).count() == 12
    nothing = ledger.entries(spark, str(tmp_path / "none"))
    assert ledger.committed_freshness(nothing).first()[0] is not None


def test_large_days_are_cut_by_size_and_small_ones_not(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    number = F.col("id")
    spark.range(120_000).select(
        F.md5(number.cast("string")).alias("event_id"),
        F.lit("A").alias("account_id"),
        F.lit("Search").alias("feature_name"),
        # Nearly all rows on one day, a few on twenty others.
        F.date_add(F.lit(AS_OF), F.when(number % 2000 == 0, number % 20).otherwise(-1).cast("int"))
        .alias("event_date"),
        F.lit(1.0).alias("session_duration_minutes"),
        F.lit(1).alias("pages_viewed"),
    ).repartition(8).write.parquet(source)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "512k")
    try:
        bronze.append_new(
            bronze.read_appended(spark, source, schemas.USAGE_EVENTS),
            target,
            str(tmp_path / "at"),
            schemas.BRONZE_USAGE_EVENTS_RULES,
            partition_by=("event_date",),
        )
    finally:
        spark.conf.set(setting, before)
    read = spark.read.parquet(target)
    files = read.select("event_date", F.input_file_name().alias("f")).distinct()
    by_day = {r.event_date: r["count"] for r in files.groupBy("event_date").count().collect()}
    assert ledger.committed_rows(spark, target, schemas.USAGE_EVENTS).count() == 120_000
    assert by_day.pop(days(-1)) > 4
    assert by_day and max(by_day.values()) <= 2


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    """One large and many small files: the large one alone, the small ones together."""
    source, target = tmp_path / "in", str(tmp_path / "out")
    spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("k")).coalesce(1).write.parquet(
        str(source)
    )
    for n in range(6):
        one = spark.range(n, n + 1).select(F.col("id").cast("string").alias("k"))
        one.coalesce(1).write.mode("append").parquet(str(source))
    stream = bronze.read_appended(
        spark, str(source), spark.range(1).select(F.lit("").alias("k")).schema, max_bytes=1 << 20
    )
    counts = bronze.append_new(stream, target, str(tmp_path / "at"))
    assert counts["total_rows"] == 200_006
    rows = ledger.logged_counts(spark, target).filter("metric = 'total_rows'").collect()
    sizes = sorted(r.row_count for r in rows)
    assert len(sizes) == 2 and sizes[0] <= 6 and sizes[1] >= 200_000


def test_registrations_at_once_get_versions_of_their_own(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    class Saved:
        def write(self):
            return self

        def save(self, path):
            os.makedirs(path)

    # Both see the same versions before either is saved.
    barrier = threading.Barrier(2)
    listed = training.model_versions

    def slow(*args):
        found = listed(*args)
        barrier.wait()
        return found

    monkeypatch.setattr(training, "model_versions", slow)
    found = []
    threads = [
        threading.Thread(target=lambda: found.append(training.register_model(spark, Saved(), root, "m")))
        for _ in range(2)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(found) == [1, 2]
    assert listed(spark, root, "m") == [1, 2]
