"""Column expressions used across the plans."""

from renewlens.functions.columns import (
    days_between,
    exact_sum,
    exact_total,
    floor_at_zero,
    md5_bucket,
    or_unknown,
    padded_key,
    percent_text,
    plan_rank,
    ratio_or_null,
    ratio_or_zero,
    risk_band,
    rounded_score,
    usd_text,
)

__all__ = [
    "days_between",
    "exact_sum",
    "exact_total",
    "floor_at_zero",
    "md5_bucket",
    "or_unknown",
    "padded_key",
    "percent_text",
    "plan_rank",
    "ratio_or_null",
    "ratio_or_zero",
    "risk_band",
    "rounded_score",
    "usd_text",
]
