"""Readers (S01-S08). CSV and text are read with explicit schemas and
normalised in one place: an empty CSV field arrives as NULL on Spark 4 and is
turned back into '' so that the register's emptiness tests keep their meaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the yearly register files (28 columns).
REGISTER_COLUMNS = (
    "PID", "legalType", "folio", "coordinates", "zoneName", "zoneCat", "lot", "block",
    "plan", "districtLot", "fCivicNum", "tCivicNum", "streetName", "postalCode",
    "NLegalName1", "NLegalName2", "NLegalName3", "NLegalName4", "NLegalName5",
    "curVal", "curImpVal", "taxAssess", "preVal", "preImpVal", "yearBuilt",
    "bigImpYear", "taxLevy", "neighbourhoodCode",
)
# The historical files lack these four columns (24 columns left).
HISTORY_MISSING = ("zoneName", "zoneCat", "preVal", "preImpVal")
HISTORY_COLUMNS = tuple(c for c in REGISTER_COLUMNS if c not in HISTORY_MISSING)
# Conversion-rate file columns.
RATE_COLUMNS = ("date", "USD", "rate", "reciprate")


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


REGISTER_SCHEMA = text_schema(REGISTER_COLUMNS)
HISTORY_SCHEMA = text_schema(HISTORY_COLUMNS)
RATE_SCHEMA = text_schema(RATE_COLUMNS)


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv(spark: SparkSession, paths, schema: T.StructType | None = None,
             header: bool = True, fill_empty: bool = True) -> DataFrame:
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(_paths(paths))
    return df.na.fill("") if fill_empty else df


def scan_register(spark: SparkSession, paths, with_source: bool = False) -> DataFrame:
    """One or many yearly register files (28 text columns) in one
    scan. The year of a row is its ``taxAssess`` column, not the file name;
    ``with_source`` adds the file path for auditing."""
    df = read_csv(spark, paths, REGISTER_SCHEMA)
    return df.withColumn("source_file", F.input_file_name()) if with_source else df


def scan_register_hist(spark: SparkSession, paths, with_source: bool = False) -> DataFrame:
    """Historical files (24 columns); the four missing columns are
    added as NULL and the 28-column order is restored."""
    df = read_csv(spark, paths, HISTORY_SCHEMA)
    for c in HISTORY_MISSING:
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.select(*REGISTER_COLUMNS)
    return df.withColumn("source_file", F.input_file_name()) if with_source else df


def scan_years(spark: SparkSession, path_for_year, years, historical: bool = False,
               with_source: bool = False) -> DataFrame:
    """The year loop as a single multi-path read (one plan, one scan)."""
    paths = [path_for_year(y) if callable(path_for_year) else path_for_year.format(year=y) for y in years]
    scan = scan_register_hist if historical else scan_register
    return scan(spark, paths, with_source=with_source)


def scan_rates(spark: SparkSession, paths) -> DataFrame:
    """Conversion-rate CSV (date, USD, rate, reciprate), all text."""
    return read_csv(spark, paths, RATE_SCHEMA, fill_empty=False)


def scan_header_only(spark: SparkSession, paths) -> DataFrame:
    """CSV with a header and no schema: every column is text. Names such
    as ``5y-fixed-posted`` need backticks in SQL text."""
    return read_csv(spark, paths, None, fill_empty=False)


def scan_whitespace(spark: SparkSession, paths, names=("date", "oilprice")) -> DataFrame:
    """Text lines split on runs of whitespace; field i -> ``names[i]``.
    A short line gives NULL fields (``get`` is NULL past the end)."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    return spark.read.text(_paths(paths)).select(
        *[F.get(parts, i).alias(n) for i, n in enumerate(names)])


def parse_whitespace(df: DataFrame, column: str = "value", names=("date", "oilprice")) -> DataFrame:
    """S06 on an existing text column."""
    parts = F.split(F.trim(F.col(column)), r"\s+")
    return df.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])


def scan_parquet(spark: SparkSession, paths, columns: Iterable[str] | None = None) -> DataFrame:
    """S08. Selecting ``columns`` right here lets the scan prune the rest."""
    df = spark.read.parquet(*_paths(paths))
    return df.select(*columns) if columns else df
