"""Classifier metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewlens.functions import ratio_or_zero
from renewlens.schemas import DECISION_THRESHOLD

SLICES = 256


def confusion_metrics(
    df: DataFrame, label: str, score: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Confusion counts and the rates built from them; undefined rates are 0."""
    actual = F.col(label) == 1
    predicted = (F.col(score) >= threshold).cast("int") == 1
    counts = df.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def roc_auc(
    df: DataFrame, label: str, score: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Exact area under the ROC curve per group; equal scores count one half.

    AUC is the share of (positive, negative) pairs in the right order. Rows are
    first counted per distinct score, so ties cannot pile up. Distinct scores
    are cut into slices at estimated quantiles and only ordered inside a slice;
    a second step over the few slice totals adds the pairs across slices. The
    quantiles are read once and only balance the work, so their error does not
    touch the result. ``groups`` must have a fixed, small set of values. NULL
    when a group lacks positives or negatives.
    """
    by = list(groups)
    positive, negative = F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)
    scores = (
        df.groupBy(*by, F.col(score).alias("_score"))
        .agg(positive.alias("_pos"), negative.alias("_neg"))
    )
    cuts = scores.groupBy(*by).agg(
        F.array_sort(
            F.array_distinct(
                F.percentile_approx("_score", [i / SLICES for i in range(1, SLICES)], 2000)
            )
        ).alias("_cuts")
    )
    # One row with at most SLICES numbers per group; few enough groups are broadcast.
    if by:
        sliced = scores.join(cuts, by)
    else:
        sliced = scores.withColumn("_cuts", cuts.scalar())
    sliced = sliced.withColumn(
        "_slice", F.size(F.filter("_cuts", lambda c: c < F.col("_score")))
    ).drop("_cuts")

    lower = Window.partitionBy(*by, "_slice").orderBy("_score")
    below = F.coalesce(
        F.sum("_neg").over(lower.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # Twice the pairs, to stay in whole numbers; decimal because they outgrow 64 bits.
    wide = "decimal(38,0)"
    inside = (
        sliced.withColumn("_below", below)
        .groupBy(*by, "_slice")
        .agg(
            F.sum(
                (F.col("_pos").cast("decimal(19,0)")
                 * (2 * F.col("_below") + F.col("_neg")).cast("decimal(18,0)")).cast(wide)
            ).cast(wide).alias("_pairs2"),
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
        )
    )
    slices = Window.partitionBy(*by).orderBy("_slice")
    neg_before = F.coalesce(
        F.sum("_neg").over(slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    across = (
        F.col("_pos").cast("decimal(19,0)") * (2 * F.col("_before")).cast("decimal(18,0)")
    ).cast(wide)
    return (
        inside.withColumn("_before", neg_before)
        .groupBy(*by)
        .agg(
            F.sum((F.col("_pairs2") + across).cast(wide)).cast("double").alias("_pairs2"),
            F.sum("_pos").alias("n_positive"),
            F.sum("_neg").alias("n_negative"),
        )
        .withColumn(
            "auc",
            F.try_divide(
                F.col("_pairs2"),
                F.lit(2.0) * F.col("n_positive").cast("double")
                * F.col("n_negative").cast("double"),
            ),
        )
        .drop("_pairs2")
    )


def champion(metrics: DataFrame) -> DataFrame:
    """The model with the largest AUC; the earlier one wins a tie."""
    return metrics.orderBy(F.col("auc").desc_nulls_last(), "position").limit(1)
