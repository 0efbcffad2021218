"""Numeric column expressions: rounding, guarded ratios, scaling, casts from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double.

    ``round(x, 2)`` goes through the shortest decimal text of the double and
    differs in the last digit from engines that scale; scaling first agrees.
    """
    if digits == 0:
        return F.round(value)
    scale = float(10 ** digits)
    return F.round(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, null where the denominator is 0 or null."""
    return numerator / F.nullif(denominator, F.lit(0))


def guarded_std(std: Column) -> Column:
    """A zero deviation counts as 1; a null one (too few rows) stays null."""
    return F.when(std == 0, F.lit(1.0)).otherwise(std)


def z_score(value: Column, mean: Column, std: Column) -> Column:
    return (value - mean) / guarded_std(std)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position of ``value`` in [low, high]; 0.5 where the range is empty."""
    span = high - low
    return F.when(span > 0, (value - low) / F.nullif(span, F.lit(0.0))).when(span.isNotNull(), F.lit(0.5))


def is_true(condition: Column) -> Column:
    """A comparison with a missing value is false, not unknown."""
    return F.coalesce(condition, F.lit(False))


def order_free_sum(value: Column) -> Column:
    """Sum doubles as decimals, so the result does not depend on task order."""
    return F.sum(value.cast("decimal(28,9)")).cast("double")


def text_to_bigint(text: Column) -> Column:
    """Integer from text; accepts whole-valued decimals (``7.0``), else null."""
    as_double = text.try_cast("double")
    whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), whole)


def epoch_ms_to_timestamp(millis: Column) -> Column:
    """Zone-free timestamp from epoch milliseconds, whatever the session's zone."""
    seconds = (millis.cast("decimal(20,0)") / F.lit(1000)).try_cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
