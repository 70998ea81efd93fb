"""Plant data-quality violations in an existing table, to exercise the gates.

Rows are chosen by a hash of their key, so a run can be repeated; different
salts choose independently.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.functions.columns import hash_bucket

# --- fixed values: violation rates in percent --------------------------------
NULL_KEY_PERCENT = 5
INVALID_STATUS_PERCENT = 10
NEGATIVE_REVENUE_PERCENT = 8
INVALID_STATUS = "paused"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Violation:
    """Replace ``column`` in ``percent`` of the rows."""

    column: str
    percent: int
    replace: Callable[[Column], Column]

    def salt(self) -> str:
        return f"{self.column}/{self.percent}"


def null_key(column: str) -> Violation:
    return Violation(column, NULL_KEY_PERCENT, lambda c: F.lit(None).cast("string"))


SUBSCRIPTION_VIOLATIONS = (
    null_key("subscription_id"),
    Violation("status", INVALID_STATUS_PERCENT, lambda c: F.lit(INVALID_STATUS)),
    Violation("monthly_recurring_revenue", NEGATIVE_REVENUE_PERCENT, lambda c: -c),
)


def inject(
    df: DataFrame,
    key: str,
    violations: tuple[Violation, ...],
    bucket: Callable[[Column, str], Column] = hash_bucket,
) -> DataFrame:
    changed = {
        v.column: F.when(bucket(F.col(key), v.salt()) < v.percent, v.replace(F.col(v.column)))
        .otherwise(F.col(v.column))
        for v in violations
    }
    return df.withColumns(changed)
