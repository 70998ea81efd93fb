"""Batches whose keys continue where the stored table ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.functions import padded_key
from renewlens.operators.ranking import dense_index, number_rows
from renewlens.schemas import ACCOUNT_KEY, EVENT_KEY, SUBSCRIPTION_KEY


def next_account_index(accounts: DataFrame) -> DataFrame:
    """One row: the first free account number, 0 for an empty table."""
    highest = F.max("account_idx")
    return accounts.agg((F.coalesce(highest, F.lit(-1)) + 1).alias("first_free"))


def next_event_index(events: DataFrame) -> DataFrame:
    """Like ``next_account_index``; the number is read from the event keys."""
    number = F.substr("event_id", F.lit(len(EVENT_KEY[0]) + 1)).cast("long")
    known = events.filter(F.col("event_id").isNotNull())
    return known.agg((F.coalesce(F.max(number), F.lit(-1)) + 1).alias("first_free"))


def _numbered(batch: DataFrame, natural_key: Column | None) -> DataFrame:
    if natural_key is None:
        return number_rows(batch, "_number")
    keyed = batch.withColumn("_digest", F.md5(natural_key))
    return dense_index(keyed, "_digest", "_number").drop("_digest")


def key_accounts(
    batch: DataFrame, accounts: DataFrame, natural_key: Column | None = None
) -> DataFrame:
    """Give every arriving account a number and key after the stored ones.

    With a unique ``natural_key`` the numbering can be repeated; without one the
    batch is checkpointed with its numbers.
    """
    index = F.col("_number") + next_account_index(accounts).scalar()
    return (
        _numbered(batch, natural_key)
        .withColumn("account_idx", index)
        .withColumn("account_id", padded_key(ACCOUNT_KEY[0], F.col("account_idx"), ACCOUNT_KEY[1]))
        .drop("_number")
    )


def key_events(
    batch: DataFrame, events: DataFrame, natural_key: Column | None = None
) -> DataFrame:
    index = F.col("_number") + next_event_index(events).scalar()
    return (
        _numbered(batch, natural_key)
        .withColumn("event_id", padded_key(EVENT_KEY[0], index, EVENT_KEY[1]))
        .drop("_number")
    )


def key_subscriptions(accounts: DataFrame, first_index: Column | int) -> DataFrame:
    """One subscription for each valid account numbered from ``first_index`` on."""
    base = F.lit(first_index) if isinstance(first_index, int) else first_index
    new = accounts.filter((F.col("account_idx") >= base) & F.col("account_id").isNotNull())
    return new.select(
        padded_key(SUBSCRIPTION_KEY[0], F.col("account_idx"), SUBSCRIPTION_KEY[1]).alias(
            "subscription_id"
        ),
        "account_id",
        "plan_type",
    )
