"""Positions and per-key picks without sorting everything in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.session import shared_folder

# Leading hex digits of a digest that name a bucket: 16**4 buckets, which bounds
# every histogram below and leaves 1/65,536 of the rows to sort together.
BUCKET_DIGITS = 4


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``.

    Spark turns a window filtered to its first row into a group limit that runs
    before the shuffle too, so a key with very many rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def bucket_of(digest: Column) -> Column:
    return F.substring(digest, 1, BUCKET_DIGITS)


def bucket_offsets(df: DataFrame, digest: str, within: Sequence[str] = ()) -> DataFrame:
    """Rows per digest bucket and rows in all earlier buckets, per ``within`` group.

    At most 16**4 rows per group. ``within`` must have a fixed, small set of values.
    """
    counts = df.groupBy(*within, bucket_of(F.col(digest)).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*within)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))


def dense_index(
    df: DataFrame, digest: str, name: str, within: Sequence[str] = (), ties: Sequence[str] = ()
) -> DataFrame:
    """Number rows 0..n-1 in digest order, per ``within`` group.

    ``digest`` must be a hex digest of a unique key, so that its buckets are
    even. Each bucket is sorted on its own and moved up by the count of rows in the
    buckets before it.
    """
    keys = [*within, "_bucket"]
    local = Window.partitionBy(*keys).orderBy(digest, *ties)
    offsets = bucket_offsets(df, digest, within).drop("_rows")
    return (
        df.withColumn("_bucket", bucket_of(F.col(digest)))
        .withColumn("_local", F.row_number().over(local))
        .join(offsets, keys)  # broadcast where it is small
        .withColumn(name, F.col("_before") + F.col("_local") - 1)
        .drop("_bucket", "_local", "_before")
    )


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Number rows 0..n-1 in no particular order; needs no key at all.

    The rows get their task-local numbers once and are checkpointed with them,
    so both passes below, and any repeated task, see the same numbers. Works
    for exact copies, which no hash could tell apart.
    """
    shared_folder(df.sparkSession)
    local_bits = F.lit((1 << 33) - 1)
    numbered = df.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    task = F.shiftright("_id", 33)
    counts = numbered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per task of the batch: bounded by the number of tasks.
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        numbered.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(local_bits))
        .drop("_task", "_id", "_before")
    )
