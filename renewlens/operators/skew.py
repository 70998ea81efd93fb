"""Equi-joins that stay balanced when a few keys hold much of the data.

The usual plan hashes the join key, so all rows of one key meet in one task.
Here the heavy keys of both sides are found first and their rows are laid out
on a small grid: a left row picks one line and is copied along it, a right row
picks one column and is copied along that, so every pair of rows still meets
exactly once. Keys that are not heavy are joined as they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HEAVY_KEYS = 1000  # tracked at least; as many as partitions, where there are more
SKETCH_ITEMS = 20  # sketch entries for each tracked key
MOST_SKETCHED = 1_000_000  # Spark's bound on sketch entries
SMALL_BYTES = 64 << 20  # files below this size fit one task whatever their keys are
HEAVY_ROWS = 100_000  # fewer rows of a key are no burden for a task
LINE, COLUMN = "_line", "_column"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """Size of the files a frame reads, from file listings alone.

    Sources of unknown size report a very large one.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_plain_scan(df: DataFrame) -> bool:
    """Whether the rows reach this frame without a shuffle."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Exchange" not in plan.replace("BroadcastExchange", "")


def heavy_keys(
    df: DataFrame,
    key: str,
    parts: int | None = None,
    small: int = SMALL_BYTES,
    min_rows: int = HEAVY_ROWS,
) -> dict[object, int]:
    """Keys holding far more than a partition's share, with the number of pieces to cut.

    One pass over the key column with a fixed-size sketch, so neither the
    number of keys nor their skew matters. The counts are estimates; they
    steer the layout only, never the result.
    """
    if input_bytes(df) < small:
        return {}
    parts = parts or _partitions(df)
    # No more than parts / 2 keys can hold twice a partition's share.
    tracked = min(max(MAX_HEAVY_KEYS, parts), MOST_SKETCHED // 2)
    sketched = min(tracked * SKETCH_ITEMS, MOST_SKETCHED)
    found = (
        df.select(F.col(key).alias("k"))
        .filter(F.col("k").isNotNull())
        .agg(
            F.count("k").alias("n"),
            F.expr(f"approx_top_k(k, {tracked}, {sketched})").alias("top"),
        )
        .first()
    )
    enough = max(min_rows, found.n * 2.0 / parts)
    return {
        item["item"]: max(2, math.ceil(parts * item["count"] / found.n))
        for item in found.top
        if item["count"] >= enough
    }


@dataclass(frozen=True)
class Layout:
    """How the heavy keys of a join are spread: key -> (lines, columns)."""

    key: str
    pieces: Mapping[object, tuple[int, int]]

    @property
    def join_columns(self) -> list[str]:
        return [self.key, LINE, COLUMN] if self.pieces else [self.key]

    def _with_pieces(self, df: DataFrame) -> DataFrame:
        kind = df.schema[self.key].dataType.simpleString()
        table = df.sparkSession.createDataFrame(
            [(k, n, m) for k, (n, m) in self.pieces.items()],
            f"`{self.key}` {kind}, _lines int, _columns int",
        )
        sized = df.join(F.broadcast(table), self.key, "left")
        one = F.lit(1)
        return sized.withColumns(
            {"_lines": F.coalesce("_lines", one), "_columns": F.coalesce("_columns", one)}
        )

    @staticmethod
    def _pick(df: DataFrame, pieces: str, seed: int) -> Column:
        """A cell for each row that comes out the same when a task is repeated.

        Rows of a plain scan always come in the same order, so a seeded draw will
        do, and it tells exact copies apart. After a shuffle the order may change;
        there the row's own content decides.
        """
        if is_plain_scan(df):
            return F.floor(F.rand(seed) * F.col(pieces)).cast("int")
        content = F.xxhash64(*(F.col(c) for c in df.columns), F.lit(seed))
        return F.pmod(content, F.col(pieces)).cast("int")

    @staticmethod
    def _every(pieces: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))

    def _place(self, df: DataFrame, line: Column, column: Column) -> DataFrame:
        # One generator per select.
        return (
            df.withColumn(LINE, line).withColumn(COLUMN, column).drop("_lines", "_columns")
        )

    def left(self, df: DataFrame) -> DataFrame:
        if not self.pieces:
            return df
        sized = self._with_pieces(df)
        return self._place(sized, self._pick(df, "_lines", 11), self._every("_columns"))

    def right(self, df: DataFrame) -> DataFrame:
        if not self.pieces:
            return df
        sized = self._with_pieces(df)
        return self._place(sized, self._every("_lines"), self._pick(df, "_columns", 13))

    def everywhere(self, df: DataFrame) -> DataFrame:
        """Copy a side with one row per key to all cells of its key."""
        if not self.pieces:
            return df
        sized = self._with_pieces(df)
        return self._place(sized, self._every("_lines"), self._every("_columns"))

    def clean(self, df: DataFrame) -> DataFrame:
        return df.drop(LINE, COLUMN) if self.pieces else df


def layout_for(
    left: DataFrame,
    right: DataFrame,
    key: str,
    parts: int | None = None,
    small: int = SMALL_BYTES,
    min_rows: int = HEAVY_ROWS,
) -> Layout:
    """Inspect both sides and lay out their heavy keys."""
    lines = heavy_keys(left, key, parts, small, min_rows)
    columns = heavy_keys(right, key, parts, small, min_rows)
    both = lines.keys() | columns.keys()
    return Layout(key, {k: (lines.get(k, 1), columns.get(k, 1)) for k in both})


def balanced_inner_join(
    left: DataFrame, right: DataFrame, key: str, layout: Layout | None = None
) -> DataFrame:
    layout = layout or layout_for(left, right, key)
    joined = layout.left(left).join(layout.right(right), layout.join_columns)
    return layout.clean(joined)
