"""Exact stratified hold-out split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.operators.ranking import bucket_of, bucket_offsets


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: float, name: str = "is_test"
) -> DataFrame:
    """Flag the first ``round(fraction * n)`` rows of each label in key-digest order.

    The rows are never sorted or shuffled. A histogram of digest buckets tells
    in which bucket the quota of a label runs out; only that bucket (1/65,536 of
    the label) is ranked to find the last key inside the quota, and the flag is
    then a comparison with that key. ``key`` must be unique, ``label`` has a
    fixed set of values.
    """
    keyed = df.select(label, F.col(key).alias("_key"), F.md5(F.col(key)).alias("_digest"))
    histogram = bucket_offsets(keyed, "_digest", [label])
    total = F.sum("_rows").over(Window.partitionBy(label))
    quota = F.round(F.lit(fraction) * total).cast("long")
    boundary = (
        histogram.withColumn("_quota", quota)
        .filter((F.col("_before") < F.col("_quota"))
                & (F.col("_quota") <= F.col("_before") + F.col("_rows")))
        .select(label, "_bucket", (F.col("_quota") - F.col("_before")).alias("_left"))
    )
    in_bucket = Window.partitionBy(label).orderBy("_digest", "_key")
    cut = (
        keyed.withColumn("_bucket", bucket_of(F.col("_digest")))
        .join(F.broadcast(boundary), [label, "_bucket"])
        .withColumn("_nth", F.row_number().over(in_bucket))
        .filter(F.col("_nth") == F.col("_left"))
        .select(label, F.struct("_digest", "_key").alias("_last"))
    )
    # One row per label. A label whose quota is 0 has none and goes to training.
    place = F.struct(F.md5(F.col(key)).alias("_digest"), F.col(key).alias("_key"))
    return (
        df.join(F.broadcast(cut), label, "left")
        .withColumn(name, F.coalesce(place <= F.col("_last"), F.lit(False)))
        .drop("_last")
    )
