"""Economic indicator tables (C05 yearly, C06 monthly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.buckets import month_bucket, split_bucket
from panelkit.functions.predicates import date_between, date_from, drop_sentinel, exclude_year, numeric_prefix
from panelkit.operators.indicators import EXACT, mean_by_month

INTEREST_COLUMN = "5y-fixed-posted"
#: Type of a state's exact totals.
STATE_TOTAL = "decimal(38,10)"


def conversion_monthly(conversion: DataFrame, date_format: str = "M/d/yy", exclude: int | None = None) -> DataFrame:
    """W04 T05 (W10) A01: mean rate per month as decimal(4,2)."""
    rows = conversion.where(numeric_prefix("rate"))
    if exclude is not None:
        rows = rows.where(exclude_year(month_bucket("date", date_format), exclude))
    return mean_by_month(rows, "date", "rate", "conversionrate", fmt=date_format, rounding=(4, 2))


def monthly_state(conversion: DataFrame | None = None, oil: DataFrame | None = None, interest: DataFrame | None = None,
                  date_format: str = "M/d/yy", interest_column: str = INTEREST_COLUMN, sentinel: str = ".") -> DataFrame:
    """What months and years need of the series (A01-A05), in one aggregation:
    ``series``, ``month``, the exact ``total`` of the rates, the ``real`` total of
    the prices, and their number ``n``. It merges by addition
    (:func:`merge_states`), so the rows of a new file are added without a second
    look at the old ones, and it is bounded by the calendar.

    Conversion: rates that start with a digit (W04 T05). Oil: prices that are not
    ``sentinel`` (W07). Interest: values rounded to decimal(4,2)."""
    parts = []
    if conversion is not None:
        parts.append(conversion.where(numeric_prefix("rate")).select(
            F.lit("conversion").alias("series"), month_bucket("date", date_format).alias("month"),
            F.col("rate").try_cast(EXACT).alias("exact"), F.lit(None).cast("double").alias("real")))
    if oil is not None:
        parts.append(oil.where(drop_sentinel("oilprice", sentinel)).select(
            F.lit("oil").alias("series"), month_bucket("date").alias("month"),
            F.lit(None).cast(EXACT).alias("exact"), F.col("oilprice").try_cast("double").alias("real")))
    if interest is not None:
        parts.append(interest.select(
            F.lit("interest").alias("series"), month_bucket("date").alias("month"),
            F.col(f"`{interest_column}`").try_cast("decimal(4,2)").cast(EXACT).alias("exact"), F.lit(None).cast("double").alias("real")))
    rows = reduce(DataFrame.unionByName, parts)
    return (rows.where(F.col("month").isNotNull() & (F.col("exact").isNotNull() | F.col("real").isNotNull()))
            .groupBy("series", "month").agg(F.sum("exact").cast(STATE_TOTAL).alias("total"), F.sum("real").alias("real"), F.count("*").alias("n")))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows of several states."""
    return (reduce(DataFrame.unionByName, states).groupBy("series", "month")
            .agg(F.sum("total").cast(STATE_TOTAL).alias("total"), F.sum("real").alias("real"), F.sum("n").alias("n")))


def _exact_mean(total, n, rounding: str = "decimal(4,2)"):
    return (total.cast(EXACT) / n.cast("decimal(18,0)")).try_cast(rounding)


def yearly_from_state(state: DataFrame, interest_start: str = "2006-01") -> DataFrame:
    """C05 from the months: the mean of the monthly conversion means (A02), the
    mean oil price (A03) and the mean interest rate from ``interest_start`` on
    (W08 A04), of the years that all three have."""
    if interest_start.count("-") != 1:
        raise ValueError("a state holds whole months: interest_start is yyyy-MM")
    is_conv, is_oil = F.col("series") == "conversion", F.col("series") == "oil"
    is_rate = (F.col("series") == "interest") & (F.col("month") >= F.lit(interest_start.replace("-", "/")))
    year, _ = split_bucket("month")
    monthly = F.when(is_conv, _exact_mean(F.col("total"), F.col("n")))
    return (state.groupBy(year.alias("year")).agg(
        F.count(monthly).alias("_months"), F.sum(F.when(is_oil, F.col("n"))).alias("_prices"), F.sum(F.when(is_rate, F.col("n"))).alias("_rates"),
        F.avg(monthly.cast(EXACT)).try_cast("decimal(4,2)").alias("conversionrate"),
        F.sum(F.when(is_oil, F.col("real"))).alias("_price"), F.sum(F.when(is_rate, F.col("total"))).alias("_rate"))
        .where("_months > 0 AND _prices > 0 AND _rates > 0")
        .select("year", _exact_mean(F.col("_rate"), F.col("_rates")).alias("interestrates"),
                (F.col("_price") / F.col("_prices")).alias("oilprice"), "conversionrate"))


def yearly_indicators(conversion: DataFrame, oil: DataFrame, interest: DataFrame,
                      date_format: str = "M/d/yy", interest_start: str = "2006-01",
                      interest_column: str = INTEREST_COLUMN, sentinel: str = ".") -> DataFrame:
    """``year, interestrates decimal(4,2), oilprice double,
    conversionrate decimal(4,2)``, one row per year present in all three.

    Conversion: monthly means, then the mean of the monthly means (A02).
    Oil: yearly mean of the prices that are not ``sentinel`` (W07 T08 A03).
    Interest: values rounded to decimal(4,2), from ``interest_start`` (W08),
    yearly mean rounded to decimal(4,2) (A04). Each series is read once, and all
    go through one aggregation by month (:func:`monthly_state`)."""
    from_day = interest.where(date_from("date", interest_start))
    return yearly_from_state(monthly_state(conversion, oil, from_day, date_format, interest_column, sentinel), interest_start[:7])


def monthly_from_state(state: DataFrame, oil: DataFrame, start: str = "2006-01", end: str = "2015-12",
                       exclude: int | None = 2016) -> DataFrame:
    """C06 from the months: interest from ``start`` to ``end`` (W09 A05) and
    conversion without the year ``exclude`` (W10 A01), joined to every oil price
    line of the month (T09; no aggregate, ``.`` reads as NULL)."""
    is_rate = (F.col("series") == "interest") & F.col("month").between(start.replace("-", "/"), end.replace("-", "/"))
    is_conv = F.col("series") == "conversion"
    if exclude is not None:
        is_conv = is_conv & exclude_year("month", exclude)
    pair = (state.where(is_rate | is_conv).groupBy("month").agg(
        F.max(F.when(is_rate, F.col("total").cast("double") / F.col("n"))).alias("interestrates"),
        F.max(F.when(is_conv, _exact_mean(F.col("total"), F.col("n")))).alias("conversionrate"),
        F.count_if(is_rate).alias("_rates"), F.count_if(is_conv).alias("_months")).where("_rates > 0 AND _months > 0"))
    oil_m = oil.select(month_bucket("date").alias("month"), F.col("oilprice").try_cast("double").alias("oilprice"))
    y, m = split_bucket("month")
    return oil_m.join(pair, "month").select(y.alias("year"), m.alias("month"), "interestrates", "oilprice", "conversionrate")


def monthly_indicators(conversion: DataFrame, oil: DataFrame, interest: DataFrame,
                       date_format: str = "M/d/yy", start: str = "2006-01", end: str = "2015-12",
                       exclude: int | None = 2016, text_bounds: bool = False,
                       interest_column: str = INTEREST_COLUMN) -> DataFrame:
    """``year, month, interestrates, oilprice, conversionrate``.

    Interest: values rounded to decimal(4,2) in the months ``start`` ..
    ``end`` (W09), unrounded monthly mean as double (A05). Conversion:
    monthly mean without the ``exclude`` year (W10, A01). Oil: every price
    line with its month. Both rates come from one aggregation by month."""
    within = interest.where(date_between("date", start, end, text_bounds))
    state = monthly_state(conversion, None, within, date_format, interest_column)
    return monthly_from_state(state, oil, start[:7], end[:7], exclude)
