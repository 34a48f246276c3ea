"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from panelkit.operators import dedup_by_key, prior_value
from panelkit.plans.register import CleanOptions, register_panel
from panelkit.sources.readers import REGISTER_COLUMNS


def skewed_register(spark, n=30000):
    ids = spark.range(n)
    pid = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string"))
    year = (F.lit(2006) + F.col("id") % 11).cast("string")
    given = {
        "PID": pid, "taxAssess": year, "legalType": F.lit("LAND"), "folio": F.col("id").cast("string"),
        "zoneName": F.lit("RS-1"), "postalCode": F.concat(F.lit("V"), (F.col("id") % 7).cast("string"), F.lit("B 1A1")),
        "curVal": (F.col("id") * 10).cast("string"), "curImpVal": F.col("id").cast("string"),
        "preVal": F.lit("1"), "preImpVal": F.lit("1"),
    }
    return ids.select(*[F.coalesce(given.get(c, F.lit("")), F.lit("")).alias(c) for c in REGISTER_COLUMNS])


def test_hot_key_dedup_is_exact(spark):
    reg = skewed_register(spark)
    out = dedup_by_key(reg, ["PID", "taxAssess"], order_by=["folio"])
    got = out.groupBy("PID", "taxAssess").count()
    assert got.where(F.col("count") != 1).count() == 0
    assert out.count() == reg.select("PID", "taxAssess").distinct().count()
    hot_2006 = out.where((F.col("PID") == "HOT") & (F.col("taxAssess") == "2006")).first()
    want = reg.where((F.col("PID") == "HOT") & (F.col("taxAssess") == "2006")).agg(F.min("folio")).first()[0]
    assert hot_2006.folio == want


def test_hot_key_panel(spark):
    reg = skewed_register(spark)
    p = register_panel(reg, reg, [2014, 2015, 2016], 2006, list(range(2007, 2014)), 2016, CleanOptions(),
                       persist=None)
    panel = p["panel"]
    assert panel.groupBy("PID", "year").count().where(F.col("count") != 1).count() == 0
    hot = panel.where(F.col("PID") == "HOT").select("year").distinct().count()
    assert hot == 11
    assert prior_value(panel.select("PID", "year", "curVal", "curImpVal"), how="inner").where(
        F.col("PID") == "HOT").count() == 10
