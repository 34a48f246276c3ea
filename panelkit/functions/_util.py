from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """Trimmed text with NULL read as empty: the one place where the
    'empty CSV field is NULL' rule of Spark 4 meets the old '' tests."""
    return F.coalesce(F.trim(as_col(c).cast("string")), F.lit(""))
