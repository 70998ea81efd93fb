"""Row-level data-quality gates: drop, warn and fail, with counts.

A predicate that is NULL counts as violated. All predicates are counted on the
same rows, before any row is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP, FAIL, WARN = "DROP", "FAIL", "WARN"


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate over the output columns of a table."""

    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self) -> None:
        if self.action not in (DROP, FAIL, WARN):
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def violations(self) -> Column:
        return F.count_if(~self.holds())


class ExpectationFailed(RuntimeError):
    """A FAIL expectation was violated; nothing has been published."""

    def __init__(
        self, table: str, violations: Mapping[str, int], metrics: Mapping[str, int] | None = None
    ):
        self.table = table
        self.violations = dict(violations)
        self.metrics = dict(violations if metrics is None else metrics)
        super().__init__(f"{table}: {self.violations}")


def _counters(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows"), *(r.violations().alias(r.name) for r in rules)]


def drop_violations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Keep the rows that meet every DROP rule.

    A bare filter: it already treats NULL as "no", and unlike a counted gate it
    is pushed into the parquet scan.
    """
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(F.expr(rule.predicate))
    return df


def gate(
    df: DataFrame, rules: Sequence[Expectation], observation: Observation | str | None = None
) -> DataFrame:
    """Apply the DROP rules; count every rule when an observation is given.

    The counters need all columns and rows they test, so they keep filters from
    reaching the scan: pass an observation on write paths only. Keep the gate
    in the last stage of the write (no shuffle between gate and sink), where
    Spark counts each partition once even if tasks are run again.
    """
    if observation is not None:
        df = df.observe(observation, *_counters(rules))
    return drop_violations(df, rules)


def violation_counts(df: DataFrame, table: str, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule with its violations, from a single pass over ``df``."""
    counted = df.agg(*_counters(rules))
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(r.name).alias("constraint_name"),
            F.lit(r.action).alias("action"),
            F.col(r.name).alias("violations"),
            F.col("total_rows").alias("total_rows"),
        )
        for r in rules
    ]
    return counted.select(F.inline(F.array(*entries)))


def raise_on_failure(
    table: str, rules: Sequence[Expectation], metrics: Mapping[str, int]
) -> None:
    broken = {
        r.name: metrics.get(r.name, 0)
        for r in rules
        if r.action == FAIL and metrics.get(r.name, 0) > 0
    }
    if broken:
        raise ExpectationFailed(table, broken, metrics)
