"""Sinks and actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by=None) -> str:
    """S09. Default mode fails if the folder exists (as the old sink did).
    ``partition_by='year'`` lets later reads prune whole years."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def delimited_lines(df: DataFrame, sep: str = " ", columns=None) -> DataFrame:
    """S10/T16 projection: every row as one text line of joined columns."""
    cols = list(columns) if columns else df.columns
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
                     .alias("value"))


def write_delimited(df: DataFrame, path: str, sep: str = " ", columns=None, mode: str = "errorifexists") -> str:
    """S10. All tasks write; for one file (R04) pass ``df.coalesce(1)``, which
    sends every row through one task."""
    delimited_lines(df, sep, columns).write.mode(mode).text(path)
    return path


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a session view and return the table it names."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def row_count(df: DataFrame) -> DataFrame:
    """S13 as a one-row DataFrame (``n``); ``.first().n`` is the action."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"))


def preview(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """First ``n`` rows in an explicit order, so it is repeatable.
    Planned as a distributed top-k (TakeOrderedAndProject)."""
    cols = order_by or df.columns
    return df.orderBy(*cols).limit(n)
