"""Date buckets (T05-T09) with a canonical key: ``year`` INT and a zero-padded
``yyyy/MM`` month text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions._util import as_col
from panelkit.functions.predicates import as_date

MONTH_FORMAT = "yyyy/MM"


def month_bucket(c, fmt: str | None = None) -> Column:
    """T05 (``fmt`` given: parse text such as ``M/d/yy``; bad text is NULL)
    and T09 (no ``fmt``: a date/timestamp or ISO text) to ``yyyy/MM``."""
    if fmt is None:
        return F.date_format(as_date(c), MONTH_FORMAT)
    return F.date_format(F.try_to_timestamp(as_col(c), F.lit(fmt)), MONTH_FORMAT)


def year_bucket(c) -> Column:
    """Calendar year (not the week-based year) of a date, timestamp or
    ISO text."""
    return F.year(as_date(c))


def split_bucket(c) -> tuple[Column, Column]:
    """``yyyy/MM`` into (year INT, month INT)."""
    c = as_col(c)
    return (F.split_part(c, F.lit("/"), F.lit(1)).try_cast("int"),
            F.split_part(c, F.lit("/"), F.lit(2)).try_cast("int"))
