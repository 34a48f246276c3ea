"""Indicator series: grouped means, resampling and joins.

Every series is keyed by a canonical bucket: ``year`` INT or ``month`` text
``yyyy/MM``. A grouped mean has one row per bucket, so the joined indicator
table is bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions._util import as_col
from panelkit.functions.buckets import month_bucket, split_bucket, year_bucket

EXACT = "decimal(30,10)"


def mean_value(value, rounding: tuple[int, int] | None = None, value_type: str | None = None) -> Column:
    """Mean of a (text or numeric) column.

    ``rounding=(p, s)``: exact decimal mean, rounded half-up to
    ``decimal(p, s)``; a mean out of range is NULL. Otherwise a double mean.
    ``value_type``: cast each input first (e.g. ``'decimal(4,2)'``)."""
    v = as_col(value)
    if value_type:
        v = v.try_cast(value_type)
    if rounding:
        return F.avg(v.try_cast(EXACT)).try_cast(f"decimal({rounding[0]},{rounding[1]})")
    return F.avg(v.try_cast("double")).cast("double")


def _grouped_mean(df: DataFrame, bucket: Column, name: str, value, out: str, rounding, value_type) -> DataFrame:
    v = as_col(value)
    if value_type:
        v = v.try_cast(value_type)
    parsed = v.try_cast(EXACT if rounding else "double")
    return (df.select(bucket.alias(name), parsed.alias("_v"))
              .where(F.col(name).isNotNull() & F.col("_v").isNotNull())
              .groupBy(name).agg(mean_value("_v", rounding).alias(out)))


def mean_by_month(df: DataFrame, date, value, out: str, fmt: str | None = None,
                  rounding: tuple[int, int] | None = (4, 2), value_type: str | None = None) -> DataFrame:
    """A01 (``rounding=(4,2)``) and A05 (``rounding=None``: double mean):
    mean per ``yyyy/MM`` month. ``fmt`` parses text dates (T05)."""
    return _grouped_mean(df, month_bucket(date, fmt), "month", value, out, rounding, value_type)


def mean_by_year(df: DataFrame, date, value, out: str, rounding: tuple[int, int] | None = None,
                 value_type: str | None = None) -> DataFrame:
    """A03 (double mean) and A04 (``value_type='decimal(4,2)'``,
    ``rounding=(4,2)``): mean per calendar year (T08)."""
    return _grouped_mean(df, year_bucket(date), "year", value, out, rounding, value_type)


def resample_month_to_year(monthly: DataFrame, value: str, month: str = "month",
                           rounding: tuple[int, int] | None = (4, 2)) -> DataFrame:
    """A02 second stage: mean of the monthly means per year, so every month
    weighs the same whatever its number of observations."""
    y, _ = split_bucket(month)
    return _grouped_mean(monthly, y, "year", value, value, rounding, None)


def join_indicators(left: DataFrame, right: DataFrame, on: str = "year") -> DataFrame:
    """Inner join of two series on their bucket."""
    return left.join(right, on, "inner")


def model_table(panel: DataFrame, indicators: DataFrame, on: str = "year") -> DataFrame:
    """Panel x indicators. The indicator side holds one row per bucket, so
    adaptive execution broadcasts it by its measured size."""
    return panel.join(indicators, on, "inner")
