"""A census of input lines that don't fit.

Readers are permissive: a line with too few or too many fields, or with a quote
that never closes, still gives a row, with empty or missing fields. The census
counts such lines per file, so they don't vanish without a trace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources.readers import text_schema

_LINE = "_unfit_line"
CENSUS_SCHEMA = "file string, lines long, bad_lines long"


def _per_file(df: DataFrame, bad) -> DataFrame:
    return (df.groupBy(F.col("_file").alias("file"))
            .agg(F.count(F.lit(1)).cast("long").alias("lines"), F.count_if(bad).cast("long").alias("bad_lines")))


def census_csv(spark: SparkSession, paths, schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """``file``, ``lines`` (headers aside) and ``bad_lines`` of CSV files read
    with ``schema`` (all text); without one the header's columns count. A line
    is bad if it does not parse into exactly these fields."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is None:
        schema = text_schema(spark.read.option("header", header).csv(paths).columns)
    df = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
          .option("columnPruning", False)  # a parser that skips fields does not see their number
          .schema(T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())])).csv(paths))
    # a reader asked for the unfit line alone refuses; the first field's length is never negative
    bad = F.col(_LINE).isNotNull() & (F.coalesce(F.length(F.col(f"`{schema.names[0]}`")), F.lit(0)) >= 0)
    return _per_file(df.withColumn("_file", F.input_file_name()), bad)


def census_whitespace(spark: SparkSession, paths, fields: int = 2) -> DataFrame:
    """The same for text lines split on whitespace: a line is bad if it does not
    have exactly ``fields`` fields (blank lines have none)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = F.filter(F.split(F.trim(F.col("value")), r"\s+"), lambda x: x != "")
    return _per_file(spark.read.text(paths).withColumn("_file", F.input_file_name()), F.size(parts) != fields)
