"""Bounded samples of rows, the same whatever the order or number of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.session import staged

PREFIX_BITS = 12


def row_mark(*columns: str) -> Column:
    """A hash of what tells rows apart; equal rows share it and count once."""
    return F.xxhash64(*columns)


def least_marks(rows: DataFrame, quota: int) -> DataFrame:
    """The ``quota`` least different values of ``mark``."""
    return rows.select("mark").distinct().orderBy("mark").limit(quota)


def least_marks_by(rows: DataFrame, group: str, quota: int) -> DataFrame:
    """(group, mark): the ``quota`` least different marks of each group.

    A count by group and leading bits of the mark tells which leading bits are read of each
    group; only the rows with those are ordered, about ``quota`` of a group and not the
    group. They are found by group and bits together, so a frequent group is many keys.
    """
    # Unsigned order, as the leading bits have it.
    prefix = F.shiftrightunsigned("mark", 64 - PREFIX_BITS).alias("__prefix")
    different = staged(rows.select(group, "mark", prefix).distinct(), "marks")
    counts = different.groupBy(group, "__prefix").agg(F.count(F.lit(1)).alias("__n"))
    # At most 2 ** PREFIX_BITS rows a group.
    before = Window.partitionBy(group).orderBy("__prefix").rowsBetween(
        Window.unboundedPreceding, -1
    )
    needed = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    needed = needed.where(F.col("__before") < quota).select(group, "__prefix")
    low = different.join(needed, [group, "__prefix"], "left_semi")
    order = Window.partitionBy(group).orderBy("__prefix", "mark")
    ranked = low.withColumn("__rank", F.row_number().over(order))
    return ranked.where(F.col("__rank") <= quota).select(group, "mark")
