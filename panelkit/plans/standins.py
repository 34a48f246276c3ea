"""Stand-in inputs derived by Spark from the driver's test tables.

The original inputs (yearly register files, three indicator series) are not
available; these DataFrames have their shapes and are computed from
``orders``, ``lineitem`` and ``part`` so that their size grows with the
tables:

* register (one row per order, text columns as read from CSV):
  PID = o_custkey, folio = o_orderkey, legalType = o_orderstatus,
  zoneName = o_orderpriority, empty for every 17th order; zoneCat empty and
  filled from it, but for every 13th order (a code, or a zone's name),
  postalCode = part name of the order's first line, ties on the line number
  broken by the name, NULL first (FSA = its first word), padded to the valid
  length but for every 20th order,
  curVal / curImpVal = the key's totals of o_totalprice / l_extendedprice in
  the year, preVal / preImpVal = the same totals of the year before,
  taxAssess = year(o_orderdate). Several orders of a key in a year are the
  duplicates that dedup removes.
* conversion rates (date ``M/d/yyyy``, USD, rate, reciprate) from lineitem:
  rate = 1 + 10 x l_tax, a holiday note where l_returnflag = 'R'.
* oil price lines ``yyyy-MM-dd<spaces>price`` from lineitem: price =
  l_quantity, ``.`` (missing) where l_linestatus = 'O' and l_returnflag = 'N'.
* interest rates (header CSV: date, 5y-fixed-posted, 1y-fixed-posted):
  100 x l_discount and 100 x l_tax.

Years: base 1995, history 1996-1999, main 2000-2001 (reference year 2001).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.sources.readers import HISTORY_COLUMNS, HISTORY_MISSING, REGISTER_COLUMNS

# Fixed values of the stand-in layout.
BASE_YEAR = 1995
HISTORY_YEARS = (1996, 1997, 1998, 1999)
MAIN_YEARS = (2000, 2001)
REFERENCE_YEAR = 2001
STANDIN_ZONE_NAMES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STANDIN_ZONE_CODES = ("1", "2", "3", "4", "5")
STANDIN_LEGAL = ("F", "O", "P")
STANDIN_POSTAL_LEN = 20
RATE_DATE_FORMAT = "M/d/yyyy"
INTEREST_START = "1995-01"
MONTHLY_START, MONTHLY_END, MONTHLY_EXCLUDE = "1995-01", "2000-12", 2001


def table(spark: SparkSession, sf_dir: str, name: str, *cols) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def _orders_with_totals(spark: SparkSession, sf_dir: str, with_part_name: bool = False):
    """Orders with their year and line total (lineitem alone: the totals do
    not depend on part), plus - only for the register - the part name of
    the order's first line (a left join, so a missing part gives NULL)."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    aggs = [F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("ext")]
    if with_part_name:
        part = table(spark, sf_dir, "part", "p_partkey", "p_name")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        aggs.append(F.min(F.struct("l_linenumber", "p_name")).getField("p_name").alias("pname"))
    per_order = lines.groupBy("l_orderkey").agg(*aggs)
    o = (orders.withColumn("yr", F.year("o_orderdate"))
         .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    sums = o.groupBy("o_custkey", "yr").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("cur"),
                                           F.sum("ext").alias("imp"))
    return o, sums


def register_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register stand-in, 28 text columns, '' for missing (as scanned)."""
    o, sums = _orders_with_totals(spark, sf_dir, with_part_name=True)
    prev = sums.select("o_custkey", (F.col("yr") + 1).alias("yr"), F.col("cur").alias("pcur"),
                       F.col("imp").alias("pimp"))
    reg = o.join(sums, ["o_custkey", "yr"]).join(prev, ["o_custkey", "yr"], "left")
    given = {
        "PID": F.col("o_custkey").cast("string"),
        "legalType": F.col("o_orderstatus"),
        "folio": F.col("o_orderkey").cast("string"),
        "zoneName": F.when(F.col("o_orderkey") % 17 == 0, "").otherwise(F.col("o_orderpriority")),
        "zoneCat": F.when(F.col("o_orderkey") % 26 == 0, "2-HIGH").when(F.col("o_orderkey") % 13 == 0, "3"),
        "postalCode": F.when(F.col("o_orderkey") % 20 == 0, F.col("pname"))
        .otherwise(F.rpad(F.col("pname"), STANDIN_POSTAL_LEN, ".")),
        "curVal": F.col("cur").cast("string"),
        "curImpVal": F.col("imp").cast("string"),
        "taxAssess": F.col("yr").cast("string"),
        "preVal": F.col("pcur").cast("string"),
        "preImpVal": F.col("pimp").cast("string"),
    }
    return reg.select(*[F.coalesce(given.get(c, F.lit(None).cast("string")), F.lit("")).alias(c)
                        for c in REGISTER_COLUMNS])


def history_rows(register: DataFrame) -> DataFrame:
    """The register as the 24-column historical files show it (the four
    missing columns NULL, 28-column order kept)."""
    out = register.select(*HISTORY_COLUMNS)
    for c in HISTORY_MISSING:
        out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*REGISTER_COLUMNS)


def conversion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_shipdate", "l_quantity", "l_tax", "l_returnflag")
    rate = (F.col("l_tax").cast("decimal(4,2)") * F.lit(10) + F.lit(1)).cast("decimal(6,2)").cast("string")
    return li.select(F.date_format("l_shipdate", RATE_DATE_FORMAT).alias("date"),
                     F.col("l_quantity").cast("string").alias("USD"),
                     F.when(F.col("l_returnflag") == "R", F.lit("Bank holiday")).otherwise(rate).alias("rate"),
                     F.lit("").alias("reciprate"))


def oil_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_shipdate", "l_quantity", "l_linestatus", "l_returnflag")
    price = F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit(".")) \
             .otherwise(F.col("l_quantity").cast("decimal(10,2)").cast("string"))
    return li.select(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("   "), price).alias("value"))


def interest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_shipdate", "l_discount", "l_tax")
    return li.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                     (F.col("l_discount").cast("decimal(4,2)") * F.lit(100)).cast("decimal(6,2)")
                     .cast("string").alias("5y-fixed-posted"),
                     (F.col("l_tax").cast("decimal(4,2)") * F.lit(100)).cast("decimal(6,2)")
                     .cast("string").alias("1y-fixed-posted"))


def customer_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain panel (PID, year, curVal, curImpVal) = key totals per year,
    one row per key and year."""
    _, sums = _orders_with_totals(spark, sf_dir)
    return sums.select(F.col("o_custkey").cast("string").alias("PID"), F.col("yr").alias("year"),
                       F.col("cur").cast("double").alias("curVal"), F.col("imp").cast("double").alias("curImpVal"))
