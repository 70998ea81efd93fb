"""Table contracts: columns, types, comments, constraints and fixed values.

Everything here is plain data. Constraints are SQL predicates so that the
module can be imported before a Spark session exists.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from renewlens.operators.quality import DROP, FAIL, WARN, Expectation

# --- fixed values: results depend on these exact numbers and names -----------
VALID_STATUSES = ("active", "churned", "trial")
PLAN_ORDER = ("Starter", "Growth", "Enterprise")
USAGE_WINDOW_DAYS = 90
RISK_LABELS = ("Low", "Medium", "High")
RISK_EDGES = (-0.01, 0.4, 0.7, 1.01)
CHURN_ALERT_THRESHOLD = 0.35
DECISION_THRESHOLD = 0.5
TEST_FRACTION = 0.2
SPLIT_SEED = 42
SCORE_DECIMALS = 4
IMPORTANCE_REPEATS = 5
ACCOUNT_KEY = ("ACC-", 5)
SUBSCRIPTION_KEY = ("SUB-", 5)
EVENT_KEY = ("EVT-", 8)
CATEGORICAL_FEATURES = ("plan_type", "industry", "country")
NUMERIC_FEATURES = (
    "tenure_days",
    "monthly_recurring_revenue",
    "total_events_90d",
    "total_session_minutes_90d",
    "total_pages_viewed_90d",
)
BASELINE_MODEL = "logreg_baseline"
BOOSTED_MODEL = "gradient_boosted_trees"
REGISTERED_MODEL = "account_churn_model"
# -----------------------------------------------------------------------------

FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES


def _table(*columns: tuple[str, DataType, str]) -> StructType:
    return StructType(
        [StructField(name, kind, True, {"comment": note}) for name, kind, note in columns]
    )


ACCOUNTS = _table(
    ("account_idx", LongType(), "Running number the key is built from"),
    ("account_id", StringType(), "Account key"),
    ("company_name", StringType(), "Name of the company"),
    ("industry", StringType(), "Line of business"),
    ("plan_type", StringType(), "Subscribed plan tier"),
    ("country", StringType(), "Country the account is billed in"),
    ("contract_start_date", DateType(), "First day of the contract"),
)

SUBSCRIPTIONS = _table(
    ("subscription_id", StringType(), "Subscription key"),
    ("account_id", StringType(), "Account the subscription belongs to"),
    ("monthly_recurring_revenue", DoubleType(), "Revenue per month, two decimals"),
    ("status", StringType(), "Life-cycle state as delivered by the source"),
    ("renewal_date", DateType(), "Next or last renewal; independent of status"),
)

USAGE_EVENTS = _table(
    ("event_id", StringType(), "Event key"),
    ("account_id", StringType(), "Account that caused the event"),
    ("feature_name", StringType(), "Feature that was used"),
    ("event_date", DateType(), "Day of the event"),
    ("session_duration_minutes", DoubleType(), "Length of the session, at most two decimals"),
    ("pages_viewed", IntegerType(), "Pages seen in the session"),
)

SILVER = _table(
    ("account_id", StringType(), "Account key; repeats when an account has several subscriptions"),
    ("subscription_id", StringType(), "Subscription key"),
    ("company_name", StringType(), "Name of the company"),
    ("industry", StringType(), "Line of business"),
    ("plan_type", StringType(), "Subscribed plan tier"),
    ("country", StringType(), "Country the account is billed in"),
    ("contract_start_date", DateType(), "First day of the contract"),
    ("monthly_recurring_revenue", DoubleType(), "Revenue per month"),
    ("status", StringType(), "Life-cycle state"),
    ("renewal_date", DateType(), "Next or last renewal"),
    ("is_churned", BooleanType(), "Whether the subscription has ended"),
    ("usage_event_count_90d", LongType(), "Events of the account inside the usage window"),
    ("total_session_minutes_90d", DoubleType(), "Session minutes inside the usage window"),
    ("total_pages_viewed_90d", LongType(), "Pages seen inside the usage window"),
)

GOLD = _table(
    ("plan_type", StringType(), "Subscribed plan tier"),
    ("industry", StringType(), "Line of business"),
    ("active_mrr", DoubleType(), "Revenue per month of active subscriptions"),
    ("total_mrr", DoubleType(), "Revenue per month of all subscriptions"),
    ("account_count", LongType(), "Different accounts in the segment"),
    ("churned_account_count", LongType(), "Rows of the segment flagged as churned"),
)

BRONZE_ACCOUNTS_RULES = (Expectation("valid_account_id", "account_id IS NOT NULL", DROP),)
BRONZE_SUBSCRIPTIONS_RULES = (
    Expectation("valid_subscription_id", "subscription_id IS NOT NULL", DROP),
)
BRONZE_USAGE_EVENTS_RULES = (Expectation("valid_event_id", "event_id IS NOT NULL", DROP),)
SILVER_RULES = (
    Expectation("account_id_present", "account_id IS NOT NULL", FAIL),
    Expectation("valid_status", f"status IN {VALID_STATUSES}", DROP),
    Expectation("non_negative_mrr", "monthly_recurring_revenue >= 0", WARN),
)
GOLD_RULES = (
    Expectation("non_negative_active_mrr", "active_mrr >= 0", WARN),
    Expectation("positive_account_count", "account_count > 0", FAIL),
)
