"""Projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, cols) -> DataFrame:
    """Column subset; the scan below reads only these columns."""
    return df.select(*cols)


def project_rename(df: DataFrame, cols, renames: dict) -> DataFrame:
    """Subset with renames (e.g. ``{'taxAssess': 'year'}``)."""
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in cols])
