"""The three source tables, mapped from the star-schema test tables.

Modulo rules plant NULL keys, invalid statuses and negative amounts. They are
part of the data definition and keep every row.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.functions import padded_key
from renewlens.operators.ranking import latest_per_key

# --- fixed values of the mapping ---------------------------------------------
AS_OF = datetime.date(2024, 4, 14)
KEY_WIDTH = 9
INDUSTRIES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
# -----------------------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table, read by its declared schema: no footers are opened to plan a query."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _unless(bad: Column, value: Column) -> Column:
    return F.when(~bad, value)


def to_accounts(customer: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    digit = key % 10
    plan = F.when(digit < 6, "Starter").when(digit < 9, "Growth").otherwise("Enterprise")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("account_idx"),
        _unless(key % 19 == 7, padded_key("ACC-", key, KEY_WIDTH)).alias("account_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        plan.alias("plan_type"),
        F.col("n_name").alias("country"),
        F.date_sub(F.lit(AS_OF), (key % 700 + 30).cast("int")).alias("contract_start_date"),
    )


def to_subscriptions(orders: DataFrame) -> DataFrame:
    key, price, state = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    return orders.select(
        _unless(key % 19 == 11, padded_key("SUB-", key, KEY_WIDTH)).alias("subscription_id"),
        padded_key("ACC-", F.col("o_custkey"), KEY_WIDTH).alias("account_id"),
        F.when(key % 13 == 5, -price).otherwise(price).alias("monthly_recurring_revenue"),
        F.when(key % 11 == 3, "paused")
        .when(state == "F", "churned")
        .when(state == "O", "active")
        .otherwise("trial")
        .alias("status"),
        F.col("o_orderdate").cast("date").alias("renewal_date"),
    )


def to_usage_events(events: DataFrame) -> DataFrame:
    key = F.col("event_id")
    return events.select(
        _unless(key % 17 == 3, padded_key("EVT-", key, KEY_WIDTH)).alias("event_id"),
        padded_key("ACC-", F.col("user_id"), KEY_WIDTH).alias("account_id"),
        F.col("event_type").alias("feature_name"),
        F.col("ts").cast("date").alias("event_date"),
        F.col("value").alias("session_duration_minutes"),
        F.get_json_object("props", "$.k").cast("int").alias("pages_viewed"),
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return to_accounts(table(spark, folder, "customer"), table(spark, folder, "nation"))


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return to_subscriptions(table(spark, folder, "orders"))


def latest_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """One subscription per account, for reports on account counts."""
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return to_subscriptions(latest_per_key(table(spark, folder, "orders"), ["o_custkey"], order))


def usage_events(spark: SparkSession, folder: str) -> DataFrame:
    return to_usage_events(table(spark, folder, "events"))
