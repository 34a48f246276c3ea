"""Row predicates (W01-W12) as native expressions. All but the date ranges are
never NULL, so ``df.where(p)`` and ``df.where(~p)`` split the rows cleanly; the
date ranges (W08, W09) are plain comparisons, NULL for a NULL or bad date, so
that a typed column's range reaches the Parquet scan."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions._util import as_col, text


def has_key(c) -> Column:
    """Key present, i.e. trimmed text is not empty (NULL counts as empty)."""
    return text(c) != ""


def has_value(c) -> Column:
    """Field non-empty; same rule as W01."""
    return has_key(c)


def has_length(c, n: int = 7) -> Column:
    """``length(trim(c)) = n``; NULL is false."""
    return F.length(text(c)) == F.lit(n)


def numeric_prefix(c) -> Column:
    """Text starts with a digit run (a prefix test: ``1.2abc`` passes)."""
    return F.coalesce(as_col(c).rlike("^[0-9]+"), F.lit(False))


def not_null(c) -> Column:
    """W05."""
    return as_col(c).isNotNull()


def all_not_null(cols) -> Column:
    """W06 as a predicate: every listed column is non-NULL."""
    out = F.lit(True)
    for c in cols:
        out = out & as_col(c).isNotNull()
    return out


def drop_sentinel(c, sentinel: str = ".") -> Column:
    """Value differs from a missing-value marker; NULL is dropped too."""
    return F.coalesce(as_col(c) != F.lit(sentinel), F.lit(False))


def _month_start(bound: str) -> _dt.date:
    parts = [int(p) for p in bound.split("-")]
    return _dt.date(parts[0], parts[1] if len(parts) > 1 else 1, parts[2] if len(parts) > 2 else 1)


def _next_month(d: _dt.date) -> _dt.date:
    return _dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)


def as_date(c) -> Column:
    """Text (``yyyy-MM-dd...``), date or timestamp to DATE; bad text is NULL.
    On a DATE column the cast vanishes."""
    return as_col(c).try_cast("date")


def date_from(c, start: str) -> Column:
    """Typed lower bound, ``start`` is ``yyyy-MM`` or ``yyyy-MM-dd``."""
    return as_date(c) >= F.lit(_month_start(start))


def date_between(c, start: str, end: str, text_bounds: bool = False) -> Column:
    """The months ``start`` .. ``end`` inclusive (half-open on the day
    after). ``text_bounds=True`` keeps the old text comparison, which loses
    every day of the end month after its first."""
    if text_bounds:
        t = as_col(c).cast("string")
        return (t >= F.lit(start)) & (t <= F.lit(end))
    d = as_date(c)
    lo = _month_start(start)
    hi = _next_month(_month_start(end)) if end.count("-") == 1 else _month_start(end) + _dt.timedelta(days=1)
    return (d >= F.lit(lo)) & (d < F.lit(hi))


def exclude_year(bucket, year: int) -> Column:
    """Drop rows whose ``yyyy/MM`` bucket lies in ``year`` (the intended
    meaning; the old code compared the month part and never dropped a row)."""
    y = F.split_part(as_col(bucket), F.lit("/"), F.lit(1))
    return F.coalesce(y != F.lit(str(year)), F.lit(False))


def valid_code(c, width: int = 41) -> Column:
    """W12, first half: the concatenated one-hot text has the expected width."""
    return F.coalesce(F.length(as_col(c)) == F.lit(width), F.lit(False))


def valid_onehot(c, width: int) -> Column:
    """W12 for one code block: exactly one '1' among ``width`` digits; a raw
    value that no dictionary mapped is not one."""
    return valid_code(c, width) & F.coalesce(as_col(c).rlike("^0*10*$"), F.lit(False))


def valid_vector(arr, size: int = 48) -> Column:
    """W12, second half: ``size(vector) = size``."""
    return F.coalesce(F.size(as_col(arr)) == F.lit(size), F.lit(False))
