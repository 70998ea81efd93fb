"""Named queries over the test tables, one per operator or tight group."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens import schemas
from renewlens.functions import md5_bucket
from renewlens.operators import arrival, evaluation, quality, skew, violations
from renewlens.plans import features as feature_plans
from renewlens.plans import given_model, health, reports, scoring, training
from renewlens.session import fresh_path, staged
from renewlens.sources import star_tables as star
from renewlens.sources import tables
from renewlens.streaming import bronze, ledger

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = training.TrainingSettings()
FACET_PLANS = ("Growth", "Enterprise")
FACET_INDUSTRIES = star.INDUSTRIES[:3]


# --- layers -------------------------------------------------------------------


def _bronze(df: DataFrame, schema, rules) -> DataFrame:
    return quality.gate(tables.conform(df, schema), rules)


def bronze_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(
        star.accounts(spark, folder), schemas.ACCOUNTS, schemas.BRONZE_ACCOUNTS_RULES
    )


def bronze_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(
        star.subscriptions(spark, folder),
        schemas.SUBSCRIPTIONS,
        schemas.BRONZE_SUBSCRIPTIONS_RULES,
    )


def bronze_usage_events(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze(
        star.usage_events(spark, folder), schemas.USAGE_EVENTS, schemas.BRONZE_USAGE_EVENTS_RULES
    )


def _streamed(spark, folder, source, transform, schema, rules, partition_by=()) -> DataFrame:
    """Stream one source table to a bronze folder and read the folder back."""
    target = fresh_path(spark, f"bronze-{source}")
    source_schema = star.table(spark, folder, source).schema
    bronze.append_new(
        bronze.read_appended(spark, folder, source_schema, glob=f"{source}.parquet"),
        target,
        fresh_path(spark, f"offsets-{source}"),
        rules,
        transform=lambda df: tables.conform(transform(df), schema),
        partition_by=partition_by,
    )
    return tables.conform(ledger.committed_rows(spark, target, schema), schema)


def bronze_stream_accounts(spark: SparkSession, folder: str) -> DataFrame:
    nation = star.table(spark, folder, "nation")
    return _streamed(
        spark,
        folder,
        "customer",
        lambda df: star.to_accounts(df, nation),
        schemas.ACCOUNTS,
        schemas.BRONZE_ACCOUNTS_RULES,
    )


def bronze_stream_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(
        spark,
        folder,
        "orders",
        star.to_subscriptions,
        schemas.SUBSCRIPTIONS,
        schemas.BRONZE_SUBSCRIPTIONS_RULES,
    )


def bronze_stream_usage_events(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(
        spark,
        folder,
        "events",
        star.to_usage_events,
        schemas.USAGE_EVENTS,
        schemas.BRONZE_USAGE_EVENTS_RULES,
        ("event_date",),
    )


def usage_90d(spark: SparkSession, folder: str) -> DataFrame:
    return health.usage_90d(bronze_usage_events(spark, folder), star.AS_OF)


def usage_90d_from_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Through the written daily table, as a refresh reads it."""
    target = fresh_path(spark, "daily-usage")
    health.write_daily_usage(bronze_usage_events(spark, folder), target)
    return health.usage_90d_from_daily(spark.read.parquet(target), star.AS_OF)


def _streamed_usage(spark: SparkSession, folder: str) -> str:
    """Events streamed in two runs, the second with late ones; the sink's folder.

    Every fourth event comes in the second run, whatever its day.
    """
    source, target = fresh_path(spark, "arriving-events"), fresh_path(spark, "bronze-events")
    offsets = fresh_path(spark, "offsets-events")
    arriving = star.usage_events(spark, folder)
    late = F.pmod(F.xxhash64("account_id", "event_date"), F.lit(4)) == 0

    def roll_up(rows: DataFrame, query: str, batch: int) -> None:
        health.append_daily_usage(rows, ledger.batch_folder(f"{target}-daily", query, batch))

    for part in (~late, late):
        arriving.filter(part).write.mode("append").parquet(source)
        bronze.append_new(
            bronze.read_appended(spark, source, arriving.schema),
            target,
            offsets,
            schemas.BRONZE_USAGE_EVENTS_RULES,
            transform=lambda df: tables.conform(df, schemas.USAGE_EVENTS),
            partition_by=("event_date",),
            along=roll_up,
        )
    return target


def usage_90d_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Through daily rows added batch by batch, late events included, as a refresh does it."""
    target = _streamed_usage(spark, folder)
    daily = ledger.committed_rows(
        spark, f"{target}-daily", health.daily_schema(spark), ledger_of=target
    )
    return health.usage_90d_from_daily(daily, star.AS_OF)


def stream_ledger_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of streamed events as the ledger has them, over all batches."""
    target = _streamed_usage(spark, folder)
    counts = ledger.logged_counts(spark, target)
    return counts.groupBy("metric").agg(F.sum("row_count").alias("row_count"))


def committed_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Last complete batch of a ledger made of the orders: a batch a day, urgent ones complete."""
    orders = star.table(spark, folder, "orders")
    planted = orders.groupBy(F.to_timestamp(F.col("o_orderdate").cast("date")).alias("day")).agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    complete = planted.filter("urgent > 0").select(
        (F.col("day") + F.make_dt_interval(hours=F.col("urgent").cast("int"))).alias("committed_at")
    )
    last = ledger.committed_freshness(complete)
    return last.select(F.date_format("refreshed_at", "yyyy-MM-dd HH:mm:ss").alias("refreshed_at"))


def _joined(spark: SparkSession, folder: str, subscriptions: DataFrame) -> DataFrame:
    joined = health.account_health(
        subscriptions, bronze_accounts(spark, folder), usage_90d(spark, folder)
    )
    return tables.conform(joined, schemas.SILVER)


def silver_account_health(spark: SparkSession, folder: str) -> DataFrame:
    joined = _joined(spark, folder, bronze_subscriptions(spark, folder))
    return quality.gate(joined, schemas.SILVER_RULES)


def silver_one_heavy_account(spark: SparkSession, folder: str) -> DataFrame:
    """Silver where 5 of 16 subscriptions are one account's, whose rows are spread.

    The search for heavy keys runs whatever the size of the tables.
    """
    moved = F.substring(F.md5("subscription_id"), 1, 1) < "5"
    owner = F.when(moved, F.lit("ACC-000000001")).otherwise(F.col("account_id"))
    subscriptions = bronze_subscriptions(spark, folder).withColumn("account_id", owner)
    accounts = bronze_accounts(spark, folder)
    layout = skew.layout_for(subscriptions, accounts, "account_id", parts=32, small=0, min_rows=0)
    joined = health.account_health(subscriptions, accounts, usage_90d(spark, folder), layout)
    return quality.gate(tables.conform(joined, schemas.SILVER), schemas.SILVER_RULES)


def _gold(silver: DataFrame) -> DataFrame:
    gold = tables.conform(health.segment_revenue(silver), schemas.GOLD)
    return quality.gate(gold, schemas.GOLD_RULES)


def gold_mrr_by_plan_industry(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(silver_account_health(spark, folder))


def _published(spark: SparkSession, df: DataFrame, schema, rules) -> tuple[str, dict[str, int]]:
    """A frame published under a new name: (view, counts of the writing stage)."""
    view = f"published_{uuid.uuid4().hex[:12]}"
    counts = tables.publish(df, view, fresh_path(spark, "published"), schema, rules)
    return view, counts


def gold_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The published gold table, copied under another name as the refresh does it.

    Replaced once, as every refresh but the first does.
    """
    gold = health.segment_revenue(silver_account_health(spark, folder))
    view, _ = _published(spark, gold, schemas.GOLD, schemas.GOLD_RULES)
    copy, root = f"{view}_snapshot", fresh_path(spark, "gold-snapshot")
    tables.overwrite_table(spark.range(1).select(F.col("id").alias("older")), copy, root)
    tables.snapshot_table(spark, view, copy, root)
    return spark.table(copy)


def published_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver as readers see it: staged, checked, published, read by name."""
    joined = _joined(spark, folder, bronze_subscriptions(spark, folder))
    return spark.table(_published(spark, joined, schemas.SILVER, schemas.SILVER_RULES)[0])


def failed_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Gold after a publish that broke a FAIL rule: the version before is still served."""
    gold = health.segment_revenue(silver_account_health(spark, folder))
    root = fresh_path(spark, "published")
    view = f"published_{uuid.uuid4().hex[:12]}"
    tables.publish(gold, view, root, schemas.GOLD, schemas.GOLD_RULES)
    broken = gold.withColumn("account_count", F.lit(0).cast("long"))
    with contextlib.suppress(quality.ExpectationFailed):
        tables.publish(broken, view, root, schemas.GOLD, schemas.GOLD_RULES)
    return spark.table(view)


def observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of the silver rules as the writing stage counts them, as logged."""
    joined = _joined(spark, folder, bronze_subscriptions(spark, folder))
    _, counts = _published(spark, joined, schemas.SILVER, schemas.SILVER_RULES)
    log = tables.quality_log(spark, {"silver_account_health": counts}, "run")
    return log.select("table_name", "metric", "row_count")


def appended_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts appended to a table in two batches, then counted by plan."""
    accounts = bronze_accounts(spark, folder)
    target = f"appended_{uuid.uuid4().hex[:12]}"
    early = F.col("account_idx") % 2 == 0
    tables.append_table(accounts.filter(early), target)
    tables.append_table(accounts.filter(~early), target)
    stored = tables.conform(spark.table(target), schemas.ACCOUNTS)
    return stored.groupBy("plan_type").agg(
        F.count(F.lit(1)).alias("accounts"), F.count_distinct("account_id").alias("different")
    )


# --- data quality -------------------------------------------------------------


def dq_bronze_counts(spark: SparkSession, folder: str) -> DataFrame:
    checked = (
        ("bronze_accounts", star.accounts, schemas.BRONZE_ACCOUNTS_RULES),
        ("bronze_subscriptions", star.subscriptions, schemas.BRONZE_SUBSCRIPTIONS_RULES),
        ("bronze_usage_events", star.usage_events, schemas.BRONZE_USAGE_EVENTS_RULES),
    )
    first, *rest = (
        quality.violation_counts(source(spark, folder), name, rules)
        for name, source, rules in checked
    )
    for counts in rest:
        first = first.unionByName(counts)
    return first


def dq_silver_counts(spark: SparkSession, folder: str) -> DataFrame:
    joined = _joined(spark, folder, bronze_subscriptions(spark, folder))
    return quality.violation_counts(joined, "silver_account_health", schemas.SILVER_RULES)


def dq_gold_counts(spark: SparkSession, folder: str) -> DataFrame:
    gold = health.segment_revenue(silver_account_health(spark, folder))
    return quality.violation_counts(gold, "gold_mrr_by_plan_industry", schemas.GOLD_RULES)


def injected_violations(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.table(spark, folder, "orders")
    clean = orders.select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.concat(F.lit("SUB-"), F.col("o_orderkey").cast("string")).alias("subscription_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("monthly_recurring_revenue"),
    )
    return violations.inject(clean, "order_key", violations.SUBSCRIPTION_VIOLATIONS, md5_bucket)


# --- reports ------------------------------------------------------------------


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments built from one subscription per account."""
    subscriptions = _bronze(
        star.latest_subscriptions(spark, folder),
        schemas.SUBSCRIPTIONS,
        schemas.BRONZE_SUBSCRIPTIONS_RULES,
    )
    silver = quality.gate(_joined(spark, folder, subscriptions), schemas.SILVER_RULES)
    return reports.facets(reports.segment_metrics(_gold(silver)))


def _published_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of the full gold table: an account counts once, its orders all.

    With more churned orders than accounts, active accounts are negative and the
    figures per active account NULL.
    """
    return reports.facets(reports.segment_metrics(gold_mrr_by_plan_industry(spark, folder)))


def _faceted(spark: SparkSession, folder: str) -> DataFrame:
    return reports.facets(_segments(spark, folder), FACET_PLANS, FACET_INDUSTRIES)


REPORTS: dict[str, tuple[Callable[[DataFrame, tuple[str, ...]], DataFrame], str]] = {
    # report -> (frame, name of the faceted variant)
    "kpis": (lambda s, _: reports.kpis(s), "kpis_faceted"),
    "kpi_texts": (lambda s, _: reports.kpi_texts(s), "kpi_texts_faceted"),
    "mrr_by_industry": (lambda s, _: reports.mrr_by_industry(s), "mrr_by_industry_faceted"),
    "mrr_share_by_plan": (lambda s, _: reports.mrr_share_by_plan(s), "mrr_share_faceted"),
    "churn_matrix": (reports.churn_matrix, "churn_matrix_faceted"),
    "churn_matrix_texts": (reports.churn_matrix_texts, "churn_matrix_texts_faceted"),
    "mrr_vs_churn": (lambda s, _: reports.mrr_vs_churn(s), "mrr_vs_churn_faceted"),
    "segment_table": (lambda s, _: reports.segment_table(s), "segment_table_faceted"),
    "segment_table_texts": (
        lambda s, _: reports.segment_table_texts(s),
        "segment_table_texts_faceted",
    ),
}


def _report_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, (frame, faceted_name) in REPORTS.items():
        found[name] = lambda s, d, f=frame: f(_segments(s, d), star.INDUSTRIES)
        found[faceted_name] = lambda s, d, f=frame: f(_faceted(s, d), FACET_INDUSTRIES)
    return found


def churn_alert(spark: SparkSession, folder: str) -> DataFrame:
    return reports.churn_alert(_segments(spark, folder))


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    return tables.freshness(spark, folder)


# --- features, models, scores -------------------------------------------------


def account_features(spark: SparkSession, folder: str) -> DataFrame:
    return feature_plans.account_features(silver_account_health(spark, folder), star.AS_OF)


def _stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table as the jobs after it find it: written once, read many times."""
    return staged(account_features(spark, folder), "account-features")


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    split = feature_plans.with_split(_stored_features(spark, folder))
    return split.select("account_id", "is_churned", "is_test")


def split_churn_rate(spark: SparkSession, folder: str) -> DataFrame:
    return feature_plans.split_rates(train_test_split(spark, folder))


def _fixed_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_features(spark, folder).withColumn(
        "churn_risk", F.bround(scoring.fixed_score(), schemas.SCORE_DECIMALS)
    )


def confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_metrics(_fixed_scores(spark, folder), "is_churned", "churn_risk")


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.roc_auc(_fixed_scores(spark, folder), "is_churned", "churn_risk")


def roc_auc_by_plan(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.roc_auc(
        _fixed_scores(spark, folder), "is_churned", "churn_risk", ["plan_type"]
    )


def shuffled_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The row pairs that permutation importance draws on the hold-out rows."""
    test = staged(train_test_split(spark, folder), "split").filter("is_test")
    return training.shuffled_pairs(
        test, "account_id", schemas.IMPORTANCE_REPEATS, schemas.SPLIT_SEED
    )


def _fixed_risks(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.risk_list(account_features(spark, folder), scoring.fixed_score())


def risk_scores_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.ranked(_fixed_risks(spark, folder))


def risk_band_counts(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.band_counts(_fixed_risks(spark, folder))


def revenue_at_risk(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.revenue_at_risk(_fixed_risks(spark, folder))


def top10_risk(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.top_risks(_fixed_risks(spark, folder))


def champion(spark: SparkSession, folder: str) -> DataFrame:
    """Choose between two fixed scores, one the mirror image of the other."""
    scores = _fixed_scores(spark, folder)
    mirrored = F.bround(F.lit(1.0) - F.col("churn_risk"), schemas.SCORE_DECIMALS)
    both = scores.select(
        "is_churned",
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("position"),
                    F.lit(schemas.BASELINE_MODEL).alias("model"),
                    F.col("churn_risk").alias("score"),
                ),
                F.struct(
                    F.lit(1).alias("position"),
                    F.lit(schemas.BOOSTED_MODEL).alias("model"),
                    mirrored.alias("score"),
                ),
            )
        ),
    )
    areas = evaluation.roc_auc(both, "is_churned", "score", ["position", "model"])
    return evaluation.champion(areas).select("model", "auc")


def _trained(spark: SparkSession, folder: str, importance: bool = False):
    return training.train(
        _stored_features(spark, folder),
        fresh_path(spark, "models"),
        SETTINGS,
        with_importance=importance,
    )


def model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder).metrics


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder, importance=True).importance


def training_status(spark: SparkSession, folder: str) -> DataFrame:
    return _trained(spark, folder).status


def churn_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Train, register, load by name and version, score, rank."""
    root = fresh_path(spark, "models")
    features = _stored_features(spark, folder)
    training.train(features, root, SETTINGS, with_importance=False)
    model = training.load_model(root, schemas.REGISTERED_MODEL, 1)
    return scoring.ranked(scoring.score_accounts(features, model))


def _encoding(spark: SparkSession, folder: str):
    """All features with their part, and the job's encoders fitted on the training rows."""
    split = staged(feature_plans.with_split(_stored_features(spark, folder)), "split")
    return split, training.encoders().fit(split.filter(~F.col("is_test")))


def encoded_features(spark: SparkSession, folder: str) -> DataFrame:
    """Categories and scaled numbers of every account, as the models see them."""
    split, encoding = _encoding(spark, folder)
    rows = given_model.encoded_rows(split, encoding)
    return rows.withColumn("value", F.round("value", 6) + F.lit(0.0))


def _given(spark: SparkSession, folder: str):
    """A model of known coefficients, stored and loaded as a trained one is."""
    split, encoding = _encoding(spark, folder)
    model = given_model.given_model(spark, encoding)
    root = fresh_path(spark, "models")
    version = training.register_model(spark, model, root, schemas.REGISTERED_MODEL)
    return split, training.load_model(root, schemas.REGISTERED_MODEL, version)


def scores_fixed_model(spark: SparkSession, folder: str) -> DataFrame:
    split, model = _given(spark, folder)
    return scoring.ranked(scoring.score_accounts(split, model))


def importance_fixed(spark: SparkSession, folder: str) -> DataFrame:
    split, model = _given(spark, folder)
    test = split.filter("is_test").drop("is_test")
    return training.permutation_importance(model, test, seed=schemas.SPLIT_SEED)


# --- arrival ------------------------------------------------------------------


def _arriving_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers arrive as accounts."""
    return star.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("source_key"),
        F.col("s_name").alias("company_name"),
        F.when(F.col("s_nationkey") % 2 == 0, "Starter").otherwise("Growth").alias("plan_type"),
    )


def arrival_keys(spark: SparkSession, folder: str) -> DataFrame:
    return arrival.key_accounts(
        _arriving_accounts(spark, folder), star.accounts(spark, folder), F.col("source_key")
    )


def arrival_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Children of the arrived accounts only, out of the table after the append."""
    stored = star.accounts(spark, folder)
    arrived = arrival_keys(spark, folder)
    columns = ["account_idx", "account_id", "plan_type"]
    appended = stored.select(*columns).unionByName(arrived.select(*columns))
    return arrival.key_subscriptions(appended, arrival.next_account_index(stored).scalar())


def arrival_event_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Orders arrive as usage events."""
    batch = star.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("source_key"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    )
    return arrival.key_events(batch, star.usage_events(spark, folder), F.col("source_key"))


def queries() -> dict[str, Query]:
    named = (
        bronze_accounts,
        bronze_subscriptions,
        bronze_usage_events,
        bronze_stream_accounts,
        bronze_stream_subscriptions,
        bronze_stream_usage_events,
        dq_bronze_counts,
        dq_silver_counts,
        dq_gold_counts,
        injected_violations,
        usage_90d,
        usage_90d_from_daily,
        usage_90d_incremental,
        stream_ledger_counts,
        committed_freshness,
        silver_account_health,
        silver_one_heavy_account,
        gold_mrr_by_plan_industry,
        gold_snapshot,
        published_silver,
        failed_publish,
        observed_counts,
        appended_twice,
        churn_alert,
        freshness,
        account_features,
        train_test_split,
        split_churn_rate,
        confusion_metrics,
        roc_auc,
        roc_auc_by_plan,
        shuffled_pairs,
        risk_scores_fixed,
        risk_band_counts,
        revenue_at_risk,
        top10_risk,
        champion,
        encoded_features,
        scores_fixed_model,
        importance_fixed,
        model_metrics,
        feature_importance,
        training_status,
        churn_scores,
        arrival_keys,
        arrival_subscriptions,
        arrival_event_keys,
    )
    found: dict[str, Query] = {q.__name__: q for q in named}
    found["segment_derived"] = _segments
    found.update(_report_queries())
    # The same reports on the gold table as it is published, all orders included.
    found["segment_derived_published"] = _published_segments
    found["churn_alert_published"] = lambda s, d: reports.churn_alert(_published_segments(s, d))
    for name, (frame, _) in REPORTS.items():
        found[f"{name}_published"] = lambda s, d, f=frame: f(
            _published_segments(s, d), star.INDUSTRIES
        )
    return found
