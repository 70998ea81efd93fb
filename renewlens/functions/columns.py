"""Scalar and aggregate expressions. All stay inside generated JVM code."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from renewlens.schemas import PLAN_ORDER, RISK_EDGES, RISK_LABELS, SCORE_DECIMALS


def day(as_of: datetime.date | str | None) -> Column:
    """The reference day: a literal when given, else today."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


SUM_DECIMALS = 6
_WHOLE_LIMIT = 9.2e18


def exact_total(column: Column | str) -> tuple[Column, Column]:
    """Two aggregates: the sum to six decimals as a decimal, and what no decimal can hold.

    Each amount is cut into its whole part and millionths, and whole parts into high
    and low bits, which are summed apart: 64-bit sums at the price of doubles, where
    decimals take several times as long. NaN, infinite and astronomic amounts go to
    the second sum (a double; NULL if there are none).
    """
    col = F.col(column) if isinstance(column, str) else column
    col = col.cast("double")
    fits = F.abs(col) < _WHOLE_LIMIT  # NaN counts as larger than any number
    value = F.when(fits, col)
    whole = value.cast("bigint")
    fine = F.rint((value - whole) * 10**SUM_DECIMALS).cast("bigint")
    high = F.sum(F.shiftright(whole, 20)).cast("decimal(20,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(20,0)")
    wholes = high * F.lit(1 << 20).cast("decimal(7,0)") + low
    total = wholes + F.sum(fine).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")
    return total.cast("decimal(38,6)"), F.sum(F.when(~fits, col))


def joined_total(total: Column, special: Column) -> Column:
    """Both sums of ``exact_total`` as one double."""
    number = total.cast("double")
    return F.when(special.isNull(), number).otherwise(F.coalesce(number, F.lit(0.0)) + special)


def exact_sum(column: Column | str) -> Column:
    """Sum of amounts to six decimals that does not depend on row order.

    Doubles summed across tasks differ in the last digits from run to run. Digits
    beyond the sixth decimal of an amount are rounded away; NaN and infinity do to
    the result what they do to a plain sum.
    """
    return joined_total(*exact_total(column))


def floor_at_zero(column: Column | str) -> Column:
    """NULL and negative amounts become 0."""
    return F.greatest(F.coalesce(column, F.lit(0.0)), F.lit(0.0))


def or_unknown(column: Column | str) -> Column:
    return F.coalesce(column, F.lit("Unknown"))


def days_between(later: Column, earlier: Column | str) -> Column:
    return F.datediff(later, earlier)


def ratio_or_null(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL unless the denominator is positive (segment figures)."""
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(numerator, F.when(d > 0, d))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """0 when there is nothing to divide by (overall figures)."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def padded_key(prefix: str, index: Column, width: int) -> Column:
    """Prefix plus zero-padded number; longer numbers keep all their digits."""
    digits = index.cast("string")
    return F.concat(
        F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
    )


def plan_rank(plan: Column | str = "plan_type") -> Column:
    """Position in the tier order; 0 for plans outside it."""
    return F.array_position(F.array(*(F.lit(p) for p in PLAN_ORDER)), F.col(plan))


def rounded_score(column: Column | str) -> Column:
    """Half-to-even, so that ties do not drift upwards."""
    return F.bround(column, SCORE_DECIMALS)


def risk_band(score: Column | str) -> Column:
    """Right-closed bands; NULL for a missing or out-of-range score."""
    s = F.col(score) if isinstance(score, str) else score
    band = F.when(s <= RISK_EDGES[0], F.lit(None).cast("string"))
    for label, upper in zip(RISK_LABELS, RISK_EDGES[1:]):
        band = band.when(s <= upper, label)
    return band


def usd_text(column: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(column, 0))


def percent_text(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.concat(F.format_number(c * 100, 1), F.lit("%"))


def md5_bucket(key: Column, salt: str, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) that other engines can reproduce."""
    digest = F.md5(F.concat(F.lit(salt + ":"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def hash_bucket(key: Column, salt: str, buckets: int = 100) -> Column:
    """Cheaper bucket for data that only Spark reads."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(buckets))
