"""Column functions on literal edge cases (the test tables hold no NULL and
no empty field, so these cases are written out)."""

from pyspark.sql import functions as F

from panelkit.functions import (
    band_value, code_to_array, date_between, date_from, drop_sentinel, exclude_year, has_key, has_length,
    month_bucket, numeric_prefix, onehot_text, prefix_before, split_bucket, year_bucket,
)
from panelkit.sources import parse_whitespace


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_key_and_length_are_null_safe(spark):
    keys = spark.createDataFrame([("1",), ("",), (" ",), (None,)], "k string")
    assert col_values(keys.select(has_key("k").alias("v")), "v") == [True, False, False, False]
    codes = spark.createDataFrame([("V6B 1A1",), (" V6B 1A1 ",), ("V6B1A1X",), ("V6B",), (None,)], "p string")
    assert col_values(codes.select(has_length("p", 7).alias("v")), "v") == [True, True, True, False, False]


def test_fsa_prefix(spark):
    codes = spark.createDataFrame([("V6B 1A1",), (" V6B 1A1 ",), ("V6B1A1X",), (None,)], "p string")
    got = col_values(codes.select(prefix_before("p", " ", strip=True).alias("v")), "v")
    assert got == ["V6B", "V6B", None, None]


def test_zone_category(spark):
    zones = spark.createDataFrame([("RS-1",), ("CD",), ("",), ("FM-1-A",), (None,)], "z string")
    got = col_values(zones.select(prefix_before("z", "-", missing="CD").alias("v")), "v")
    assert got == ["RS", "CD", "CD", "FM", None]


def test_onehot_text_width_and_position(spark):
    df = spark.range(9).select(onehot_text(F.col("id").cast("int"), 9).alias("c"))
    codes = col_values(df, "c")
    assert all(len(c) == 9 and c.count("1") == 1 for c in codes)
    assert [c.index("1") for c in codes] == list(range(9))


def test_numeric_prefix_and_month_bucket(spark):
    rows = [("12/31/15", "1.3840"), ("01/01/16", "Bank holiday"), ("02/01/06", "1.2abc"), ("2/1/06", "1.1"),
            ("13/01/15", "1.1"), ("n/a", "1.0")]
    df = spark.createDataFrame(rows, "d string, r string")
    assert col_values(df.select(numeric_prefix("r").alias("v")), "v") == [True, False, True, True, True, True]
    got = col_values(df.select(month_bucket("d", "M/d/yy").alias("m")), "m")
    assert got == ["2015/12", "2016/01", "2006/02", "2006/02", None, None]


def test_whitespace_lines_and_sentinel(spark):
    lines = spark.createDataFrame([("2006-01-03   63.11",), ("2006-01-04 .",), ("broken",), ("DATE VALUE",)], "value string")
    parsed = parse_whitespace(lines)
    assert [tuple(r) for r in parsed.collect()] == [("2006-01-03", "63.11"), ("2006-01-04", "."),
                                                   ("broken", None), ("DATE", "VALUE")]
    kept = parsed.where(drop_sentinel("oilprice"))
    assert col_values(kept, "date") == ["2006-01-03", "DATE"]
    assert col_values(parsed.select(year_bucket("date").alias("y")), "y") == [2006, 2006, None, None]


def test_calendar_year_not_week_year(spark):
    df = spark.createDataFrame([("2014-12-29",), ("2014-12-31",), ("2015-01-01",)], "d string")
    assert col_values(df.select(year_bucket("d").alias("y")), "y") == [2014, 2014, 2015]


def test_date_range_keeps_whole_end_month(spark):
    days = ["2005-12-31", "2006-01-01", "2015-11-30", "2015-12-05", "2016-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    typed = col_values(df.select(date_between("d", "2006-01", "2015-12").alias("v")), "v")
    assert typed == [False, True, True, True, False]
    old = col_values(df.select(date_between("d", "2006-01", "2015-12", text_bounds=True).alias("v")), "v")
    assert old == [False, True, True, False, False]
    assert col_values(df.select(date_from("d", "2006-01").alias("v")), "v") == [False, True, True, True, True]


def test_exclude_year_and_split(spark):
    df = spark.createDataFrame([("2015/12",), ("2016/01",)], "b string")
    assert col_values(df.where(exclude_year("b", 2016)), "b") == ["2015/12"]
    y, m = split_bucket("b")
    assert [tuple(r) for r in df.select(y, m).collect()] == [(2015, 12), (2016, 1)]


def test_value_bands(spark):
    vals = [299999.99, 300000.0, 699999.99, 700000.0, 1000000.0, 1400000.0, 1600000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert col_values(df.select(band_value("v").alias("b")), "b") == ["1", "2", "2", "3", "4", "5", "6", None]


def test_code_to_array(spark):
    df = spark.createDataFrame([("101", 5.0), ("10", 6.0)], "c string, x double")
    got = col_values(df.select(code_to_array("c", "x", width=3).alias("a")), "a")
    assert got == [[1.0, 0.0, 1.0, 5.0], []]
