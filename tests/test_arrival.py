from pyspark.sql import functions as F

from frames import accounts, events
from renewlens import schemas
from renewlens.operators import arrival, violations


def _batch(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("source_key"), F.lit("Growth").alias("plan_type")
    )


def test_empty_tables_start_at_zero(spark):
    assert arrival.next_account_index(accounts(spark)).first()[0] == 0
    assert arrival.next_event_index(events(spark)).first()[0] == 0


def test_null_event_ids_do_not_count(spark):
    ev = events(spark, ("EVT-00000041", "A", 0, 1.0, 1), (None, "A", 0, 1.0, 1))
    assert arrival.next_event_index(ev).first()[0] == 42


def test_two_appends_past_the_padding_never_collide(spark):
    stored = spark.range(99_998, 99_999).select(
        F.col("id").alias("account_idx"), F.concat(F.lit("ACC-"), "id").alias("account_id"),
        F.lit("Growth").alias("plan_type"),
    )
    columns = stored.columns
    for key in (F.col("source_key"), None):
        first = arrival.key_accounts(_batch(spark, 300), stored, key).select(*columns)
        once = stored.unionByName(first)
        second = arrival.key_accounts(_batch(spark, 300, 1000), once, key).select(*columns)
        everything = once.unionByName(second)
        got = everything.agg(
            F.count("*"), F.count_distinct("account_id"), F.max("account_idx")
        ).first()
        assert tuple(got) == (601, 601, 100_598)


def test_children_of_this_batch_only(spark):
    table = accounts(spark, "A0", "A1", None, "A3")
    children = arrival.key_subscriptions(table, 1).collect()
    assert {(r.subscription_id, r.account_id) for r in children} == {
        ("SUB-00001", "A1"), ("SUB-00003", "A3")
    }


def test_event_keys_continue(spark):
    ev = events(spark, ("EVT-00000009", "A", 0, 1.0, 1))
    keys = {r.event_id for r in arrival.key_events(_batch(spark, 3), ev).collect()}
    assert keys == {"EVT-00000010", "EVT-00000011", "EVT-00000012"}


def test_violations_hit_about_their_rate_and_repeat(spark):
    clean = spark.range(5000).select(
        F.col("id").cast("string").alias("k"),
        F.concat(F.lit("SUB-"), "id").alias("subscription_id"),
        F.lit("active").alias("status"),
        F.lit(5.0).alias("monthly_recurring_revenue"),
    )
    messy = violations.inject(clean, "k", violations.SUBSCRIPTION_VIOLATIONS)
    again = violations.inject(clean.orderBy(F.desc("k")), "k", violations.SUBSCRIPTION_VIOLATIONS)
    assert messy.exceptAll(again).count() == 0
    counts = messy.agg(
        F.count_if(F.col("subscription_id").isNull()).alias("key"),
        F.count_if(F.col("status") == "paused").alias("status"),
        F.count_if(F.col("monthly_recurring_revenue") < 0).alias("mrr"),
    ).first()
    assert 175 <= counts.key <= 325
    assert 420 <= counts.status <= 580
    assert 330 <= counts.mrr <= 470
    assert messy.columns == clean.columns and messy.count() == 5000


def test_injected_rows_are_caught_by_the_gates(spark):
    clean = accounts(spark, *(f"A{i}" for i in range(400)))
    messy = violations.inject(clean, "company_name", (violations.null_key("account_id"),))
    dropped = messy.filter("account_id IS NULL").count()
    from renewlens.operators.quality import gate

    assert dropped > 0
    assert gate(messy, schemas.BRONZE_ACCOUNTS_RULES).count() == 400 - dropped
