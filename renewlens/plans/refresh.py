"""The scheduled job: append a batch, refresh bronze, silver, gold and the snapshot."""

from __future__ import annotations

import datetime
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens import schemas
from renewlens.operators import arrival
from renewlens.operators.quality import Expectation
from renewlens.plans.features import account_features
from renewlens.plans.health import (
    account_health,
    append_daily_usage,
    daily_schema,
    segment_revenue,
    usage_90d_from_daily,
)
from renewlens.sources.tables import (
    Publication,
    append_table,
    conform,
    finish_publications,
    has_files,
    point_view,
    prune_versions,
    publish,
    publish_all,
    quality_log,
    snapshot_table,
)
from renewlens.streaming import ledger
from renewlens.streaming.bronze import append_new, read_appended_table

SILVER_TABLE = "silver_account_health"
GOLD_TABLE = "gold_mrr_by_plan_industry"
SNAPSHOT_TABLE = "app_gold_mrr_by_plan_industry"
FEATURE_TABLE = "account_features"
QUALITY_LOG = "data_quality_log"
DAILY_USAGE = "daily_usage"


@dataclass(frozen=True)
class RefreshConfig:
    """Where a refresh reads and writes. Source and target are separate settings."""

    source_schema: str
    target_schema: str
    target_root: str
    as_of: datetime.date | None = None
    keep_versions: int = 3

    def source(self, name: str) -> str:
        return f"{self.source_schema}.{name}"

    def table(self, name: str) -> str:
        return f"{self.target_schema}.{name}"

    def folder(self, name: str) -> str:
        return f"{self.target_root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class BronzeTable:
    name: str
    schema: StructType
    rules: tuple[Expectation, ...]
    partition_by: tuple[str, ...] = ()

    @property
    def target(self) -> str:
        return f"bronze_{self.name}"


BRONZE_TABLES = (
    BronzeTable("accounts", schemas.ACCOUNTS, schemas.BRONZE_ACCOUNTS_RULES),
    BronzeTable("subscriptions", schemas.SUBSCRIPTIONS, schemas.BRONZE_SUBSCRIPTIONS_RULES),
    # By day, so that the usage window reads its own days only.
    BronzeTable(
        "usage_events",
        schemas.USAGE_EVENTS,
        schemas.BRONZE_USAGE_EVENTS_RULES,
        ("event_date",),
    ),
)


def append_batch(
    spark: SparkSession,
    source_schema: str,
    accounts: DataFrame,
    events: DataFrame,
    subscriptions_of: Callable[[DataFrame], DataFrame],
    change_accounts: Callable[[DataFrame], DataFrame] = lambda df: df,
    change_events: Callable[[DataFrame], DataFrame] = lambda df: df,
    account_key: Column | None = None,
    event_key: Column | None = None,
) -> int:
    """Append arrived rows to the source tables under continuing keys.

    ``accounts`` and ``events`` come without their own keys. The subscriptions
    are made by ``subscriptions_of`` from the accounts of this batch that are
    valid as stored, that is after ``change_accounts``; ``change_events`` may spoil keyed
    events, as arriving data does. Returns the first
    account number of the batch, which is all that reaches the driver.
    """
    account_table, subscription_table, event_table = (
        f"{source_schema}.{t.name}" for t in BRONZE_TABLES
    )
    stored = spark.table(account_table)
    first = arrival.next_account_index(stored).first().first_free
    keyed = change_accounts(arrival.key_accounts(accounts, stored, account_key))
    append_table(conform(keyed, schemas.ACCOUNTS), account_table)
    children = arrival.key_subscriptions(spark.table(account_table), first)
    append_table(conform(subscriptions_of(children), schemas.SUBSCRIPTIONS), subscription_table)
    arrived = change_events(arrival.key_events(events, spark.table(event_table), event_key))
    append_table(conform(arrived, schemas.USAGE_EVENTS), event_table)
    return first


def ingest(spark: SparkSession, config: RefreshConfig, table: BronzeTable) -> None:
    """Append the new source rows to a bronze folder and show it as a table.

    Usage events are also added up by account and day, batch by batch: a late event
    makes one more row of its day, and no day is read again.
    """
    folder = config.folder(table.target)
    daily = config.folder(DAILY_USAGE)

    def roll_up(rows: DataFrame, query: str, batch: int) -> None:
        append_daily_usage(rows, ledger.batch_folder(daily, query, batch))

    append_new(
        read_appended_table(spark, config.source(table.name)),
        folder,
        config.folder(f"_checkpoints/{table.target}"),
        table.rules,
        transform=lambda df: conform(df, table.schema),
        partition_by=table.partition_by,
        along=roll_up if table.name == "usage_events" else None,
    )
    if has_files(spark, folder):
        ledger.point_committed_view(spark, config.table(table.target), folder, table.schema)
    else:
        # A view over no files has no schema: until rows arrive it shows an empty table.
        empty = config.folder(f"_empty/{table.target}")
        spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(empty)
        point_view(spark, config.table(table.target), empty, table.schema)


def pending_counts(
    spark: SparkSession, config: RefreshConfig, table: BronzeTable
) -> dict[str, dict[str, int]]:
    """Counts by batch of complete batches that the quality log does not know yet.

    Those of a run that died before it wrote its log are among them.
    """
    counts = ledger.logged_counts(spark, config.folder(table.target))
    log = config.table(QUALITY_LOG)
    if spark.catalog.tableExists(log):
        known = spark.table(log).filter(F.col("table_name") == table.target)
        counts = counts.join(known.select("batch").distinct(), "batch", "anti")
    found: dict[str, dict[str, int]] = {}
    # A handful of numbers per micro-batch since the last log.
    for row in counts.collect():
        found.setdefault(row.batch, {})[row.metric] = row.row_count
    return found


def read_bronze(spark: SparkSession, config: RefreshConfig, table: BronzeTable) -> DataFrame:
    return ledger.committed_rows(spark, config.folder(table.target), table.schema)


def read_daily_usage(spark: SparkSession, config: RefreshConfig) -> DataFrame:
    """Usage by account, day and batch, for the complete batches of the events."""
    events = config.folder("bronze_usage_events")
    return ledger.committed_rows(spark, config.folder(DAILY_USAGE), daily_schema(spark), events)


def refresh(spark: SparkSession, config: RefreshConfig) -> dict[str, dict[str, int]]:
    """Run all layers; returns the violation counts per table.

    Stops at a broken FAIL rule, of silver or of gold, with both published tables
    unchanged. The counts of a table are logged as soon as they exist, those of a
    failing one included; those of a stream batch by batch, each batch once, whichever
    run took it.
    """
    run_id = uuid.uuid4().hex
    metrics: dict[str, dict[str, int]] = {}
    finish_publications(spark, config.target_root)

    def log(name: str, counts: dict[str, int], batch: str | None = None) -> None:
        rows = quality_log(spark, {name: counts}, run_id, batch)
        append_table(rows, config.table(QUALITY_LOG))

    for t in BRONZE_TABLES:
        ingest(spark, config, t)
        total = Counter({"total_rows": 0, **{rule.name: 0 for rule in t.rules}})
        batches = pending_counts(spark, config, t)
        for batch, counts in batches.items():
            log(t.target, counts, batch)
            total.update(counts)
        if not batches:
            log(t.target, dict(total))
        metrics[t.target] = dict(total)
    accounts, subscriptions, _ = (read_bronze(spark, config, t) for t in BRONZE_TABLES)
    usage = usage_90d_from_daily(read_daily_usage(spark, config), config.as_of)
    silver, gold = config.table(SILVER_TABLE), config.table(GOLD_TABLE)

    def seen(table: str, counts: dict[str, int]) -> None:
        name = table.split(".")[-1]
        metrics[name] = counts
        log(name, counts)

    publish_all(
        spark,
        [
            Publication(
                silver,
                lambda _: account_health(subscriptions, accounts, usage),
                schemas.SILVER,
                schemas.SILVER_RULES,
                "Subscriptions with account attributes and recent usage",
            ),
            Publication(
                gold,
                lambda staged: segment_revenue(staged[silver]),
                schemas.GOLD,
                schemas.GOLD_RULES,
                "Revenue and accounts by plan and industry",
            ),
        ],
        config.target_root,
        seen,
    )
    snapshot_table(spark, gold, config.table(SNAPSHOT_TABLE), config.target_root)
    for name in (SILVER_TABLE, GOLD_TABLE, SNAPSHOT_TABLE):
        prune_versions(spark, config.table(name), config.target_root, config.keep_versions)
    return metrics


def refresh_features(spark: SparkSession, config: RefreshConfig) -> None:
    """Rebuild the feature table from the published silver table."""
    features = account_features(spark.table(config.table(SILVER_TABLE)), config.as_of)
    publish(
        features,
        config.table(FEATURE_TABLE),
        config.target_root,
        features.schema,
        comment="Label and model features, one row per account",
    )
    prune_versions(spark, config.table(FEATURE_TABLE), config.target_root, config.keep_versions)
