"""Joins whose rows hold a block of data each, handed to Python a few at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from renewlens.session import staged

ROWS = 16  # of such a join in one Arrow batch


def _table(spark: SparkSession, table: DataFrame) -> DataFrame:
    """A written table, read in another session."""
    files = table.inputFiles()
    if not files:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(*files)


def joined_blocks(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    run: Callable,
    schema: str,
    name: str,
    spread: Callable[[DataFrame], DataFrame] = lambda blocks: blocks,
) -> DataFrame:
    """``run`` (as in mapInArrow) over the inner join of two tables of blocks, written.

    The size of Arrow batches is a setting of the session. The join runs in a session
    of its own, so that the caller's keeps its settings. ``spread`` gives the blocks of
    the left side, as written once, the columns on which they meet the right side.
    """
    spark = left.sparkSession
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    left, right = staged(left, f"{name}-left"), staged(right, f"{name}-right")
    met = spread(_table(own, left)).join(_table(own, right), on)
    return _table(spark, staged(met.mapInArrow(run, schema), name))
