"""Operators: encoders, keys, panel joins, indicators, quality."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import (
    backfill_attribute, category_codes, correlate_with, dedup_by_key, encode_categories, encode_legal, encode_zone,
    fit_categories, fit_per_class_regression, hash_split, impute_prior, map_values, mean_by_month, number_rows,
    prior_value, quality_report, stack_years, standardize,
)


def test_map_values_does_not_chain(spark):
    df = spark.createDataFrame([("A",), ("B",), ("Z",), (None,)], "v string")
    got = [r.v for r in map_values(df, "v", {"A": "B", "B": "C"}).collect()]
    assert got == ["B", "C", "Z", None]


def test_zone_and_legal_codes(spark):
    df = spark.createDataFrame([("One Family Dwelling", "LAND"), ("RT", "STRATA"), ("XX", "OTHER")], "z string, l string")
    got = [tuple(r) for r in encode_legal(encode_zone(df, "z"), "l").collect()]
    assert got == [("100000000", "100"), ("010000000", "010"), ("XX", "001")]


@pytest.mark.parametrize("unseen,expected", [("null", [None]), ("keep", ["zz"])])
def test_unseen_categories(spark, unseen, expected):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "f string")
    d = fit_categories(train, "f")
    assert [(r.value, r.idx, r.code) for r in category_codes(d).orderBy("idx").collect()] == [("a", 0, "100"), ("b", 1, "010"),
                                                                              ("c", 2, "001")]
    other = spark.createDataFrame([("zz",)], "f string")
    assert [r.f for r in encode_categories(other, "f", d, unseen=unseen).collect()] == expected


def test_unseen_error(spark):
    train = spark.createDataFrame([("a",), ("b",)], "f string")
    other = spark.createDataFrame([("zz",)], "f string")
    with pytest.raises(Exception):
        encode_categories(other, "f", fit_categories(train, "f"), unseen="error").collect()


def test_any_number_of_categories(spark):
    df = spark.range(60_000).select(F.format_string("v%05d", F.col("id") % 20_000).alias("f"))
    d = fit_categories(df, "f")
    got = encode_categories(df, "f", d, value="idx", out="i")
    assert d.count() == 20_000 and {r.width for r in d.select("width").distinct().collect()} == {20_000}
    assert got.where(F.col("i").cast("int") != F.substring("f", 2, 5).cast("int")).count() == 0
    one = encode_categories(df.where("f = 'v19999'").limit(1), "f", d).first().f
    assert len(one) == 20_000 and one.endswith("1") and one.count("1") == 1
    assert fit_categories(df.where("false"), "f").collect() == []


def test_rows_are_numbered_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(9)
    got = [(r.k, r.nth) for r in number_rows(df, [F.col("k").desc()], "nth").orderBy("nth").collect()]
    want = sorted((r.k for r in df.collect()), reverse=True)
    assert got == [(k, i) for i, k in enumerate(want)]


def test_hot_category_is_split_in_the_join(spark):
    """A value (and NULL) with a third of the rows each: the join's partitions
    of that value are split, and no row is lost."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("v"), (F.col("id") % 400).cast("string")))
        df = spark.range(60_000, numPartitions=8).select("id", hot.alias("f"), F.sha2(F.col("id").cast("string"), 256).alias("pay"))
        out = encode_categories(df, "f", fit_categories(df, "f"), value="idx", out="i")
        assert out.agg(F.count("*"), F.count("i")).first() == (60_000, 40_000)
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        assert len(rows) == 60_000 and "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_dedup_is_deterministic_and_partition_independent(spark):
    rows = [(1, "2001", "x", 5), (1, "2001", "x", 4), (1, "2002", "y", 1), (2, "2001", "z", 9)]
    df = spark.createDataFrame(rows, "k int, y string, a string, b int")
    want = sorted(tuple(r) for r in dedup_by_key(df, ["k"], order_by=["y"]).collect())
    assert want == [(1, "2001", "x", 4), (2, "2001", "z", 9)]
    for n in (1, 3, 7):
        got = sorted(tuple(r) for r in dedup_by_key(df.repartition(n), ["k"], order_by=["y"]).collect())
        assert got == want
    last = sorted(tuple(r) for r in dedup_by_key(df, ["k"], order_by=["y"], keep="last").collect())
    assert last == [(1, "2002", "y", 1), (2, "2001", "z", 9)]


def test_hash_split_disjoint_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = hash_split(df, ["k"], (0.6, 0.4))
    ka, kb = {r.k for r in a.collect()}, {r.k for r in b.collect()}
    assert not ka & kb and len(ka | kb) == 2000
    assert 1000 < len(ka) < 1400
    a2, _ = hash_split(df.repartition(5), ["k"], (0.6, 0.4))
    assert {r.k for r in a2.collect()} == ka


def test_prior_value_previous_year_equals_self_join(spark):
    rows = [("k1", 2006, 10.0), ("k1", 2007, 11.0), ("k1", 2009, 13.0), ("k2", 2007, 5.0), ("k2", 2008, 6.0)]
    df = spark.createDataFrame(rows, "PID string, year int, curVal double")
    got = prior_value(df, pairs={"preVal": "curVal"})
    a = df.alias("a")
    b = df.alias("b")
    joined = a.join(b, (F.col("a.PID") == F.col("b.PID")) & (F.col("a.year") == F.col("b.year") + 1)) \
        .select("a.PID", "a.year", "a.curVal", F.col("b.curVal").alias("preVal"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))
    base = prior_value(df, pairs={"preVal": "curVal"}, mode="base_year", base_year=2006)
    assert sorted(map(tuple, base.collect())) == [("k1", 2007, 11.0, 10.0), ("k1", 2009, 13.0, 10.0)]


def test_backfill_takes_latest_donor_row(spark):
    target = spark.createDataFrame([("a", 2006), ("b", 2006), ("c", 2006)], "PID string, year int")
    donor = spark.createDataFrame([("a", 2015, "RS"), ("a", 2016, "RT"), ("b", 2014, "C")],
                                  "PID string, year int, zoneCat string")
    got = sorted(map(tuple, backfill_attribute(target, donor).collect()))
    assert got == [("a", 2006, "RT"), ("b", 2006, "C")]
    left = backfill_attribute(target, donor, how="left")
    assert left.count() == 3


def test_impute_and_stack_text_with_double(spark):
    base = impute_prior(spark.createDataFrame([("k", "100", "bad")], "PID string, curVal string, curImpVal string"))
    assert [tuple(r) for r in base.select("preVal", "preImpVal").collect()] == [(99.0, None)]
    text = spark.createDataFrame([("k", "5.5"), ("j", "oops")], "PID string, preVal string")
    dbl = spark.createDataFrame([("m", 2.0)], "PID string, preVal double")
    out = sorted(map(tuple, stack_years([text, dbl], numeric=("preVal",)).collect()))
    assert out == [("j", None), ("k", 5.5), ("m", 2.0)]


def test_decimal_mean_rounds_half_up_and_overflows_to_null(spark):
    df = spark.createDataFrame([("2015-01-01", "1.00"), ("2015-01-02", "1.01"), ("2015-02-01", "150"),
                                ("2015-02-02", "50")], "d string, v string")
    got = {r.month: r.m for r in mean_by_month(df, "d", "v", "m").collect()}
    assert str(got["2015/01"]) == "1.01" and got["2015/02"] is None


def test_quality_report_one_pass(spark):
    df = spark.createDataFrame([("a", 1.5), ("", None), (" ", 2.0)], "s string, x double")
    r = quality_report(df).first()
    assert (r.rows, r.empty_s, r.empty_x) == (3, 2, 1)


def test_constant_column_correlation_and_scaling(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, c double")
    corr = {r.column: r.correlation for r in correlate_with(df, "a", ["a", "c"]).collect()}
    assert abs(corr["a"] - 1.0) < 1e-12 and corr["c"] is None
    z = [tuple(r) for r in standardize(df, ["a", "c"]).collect()]
    assert z == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_per_class_regression_matches_closed_form(spark):
    rows = [(0, float(x), 3.0 + 2.0 * x) for x in range(10)] + [(1, float(x), 1.0 - x) for x in range(5)]
    df = spark.createDataFrame(rows, "cls int, x double, y double")
    got = {r["class"]: r for r in fit_per_class_regression(df, "cls", ["x"], "y").collect()}
    assert abs(got[0.0].intercept - 3.0) < 1e-9 and abs(got[0.0].coefficients[0] - 2.0) < 1e-9
    assert abs(got[1.0].intercept - 1.0) < 1e-9 and abs(got[1.0].coefficients[0] + 1.0) < 1e-9


def test_two_stage_model_learns_separable_bands(spark):
    from pyspark.ml.functions import array_to_vector

    from panelkit.operators import two_stage_model
    rows = []
    for i in range(240):
        band = i % 3
        x = band * 10.0 + (i % 7) / 10.0
        value = [100000.0, 500000.0, 800000.0][band] + 1000.0 * (i % 7)
        rows.append((i, x, float(i % 7), value))
    df = spark.createDataFrame(rows, "k int, x double, z double, curVal double") \
        .withColumn("features", array_to_vector(F.array("x", "z")))
    train = df.where(F.col("k") % 4 != 0)
    test = df.where(F.col("k") % 4 == 0)
    for named in (("z",), None):  # a named column, the whole vector
        res = two_stage_model(train, test, "curVal", "features", named, key=("k",))
        assert res.accuracy.first().accuracy > 0.95
        found = res.rmse_by_class.collect()
        assert found and all(r.rmse < 1.0 and r.n_unscored == 0 for r in found)


def test_per_class_regression_takes_any_number_of_classes(spark):
    df = spark.range(30_000).select((F.col("id") % 3000).alias("cls"), F.col("id").cast("double").alias("x"),
                                    (F.col("id") * 2.0 + F.col("id") % 3000).alias("y"))
    got = fit_per_class_regression(df, "cls", ["x"], "y")
    assert got.count() == 3000
    assert got.where((F.abs(F.col("coefficients")[0] - 2) > 1e-6) | (F.abs(F.col("intercept") - F.col("class")) > 1e-3)).count() == 0


def test_rows_of_a_band_without_regression_are_counted(spark):
    from panelkit.operators import predict_per_class, rmse_by_class
    df = spark.createDataFrame([(float(i % 3), float(i), 2.0 * i) for i in range(30)], "cls double, x double, y double")
    coefs = fit_per_class_regression(df.where("cls < 2"), "cls", ["x"], "y")
    got = {r["class"]: (r.n, r.n_unscored) for r in rmse_by_class(predict_per_class(df, coefs, "cls", ["x"], "p"), "cls", "y", "p").collect()}
    assert got == {0.0: (10, 0), 1.0: (10, 0), 2.0: (10, 10)}


def test_prior_value_refuses_two_rows_of_one_year(spark):
    import pytest
    from pyspark.errors import PySparkException
    rows = [("A", 2000, 1.0, 1.0), ("A", 2001, 2.0, 2.0), ("B", 2000, 3.0, 3.0), ("B", 2000, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "PID string, year int, curVal double, curImpVal double")
    out = prior_value(df.where("PID = 'A'"))
    assert [(r.year, r.preVal) for r in out.collect()] == [(2001, 1.0)]
    with pytest.raises(PySparkException, match="two rows of one year for PID B"):
        prior_value(df).collect()
    for plan in (prior_value(df)._jdf.queryExecution().executedPlan().toString(),):
        assert plan.count("Exchange") == 1


def test_prior_value_keeps_the_first_year_at_its_factor(spark):
    rows = [("A", 2000, 100.0, 10.0), ("A", 2001, 110.0, 11.0), ("A", 2003, 120.0, 12.0), ("B", 2001, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "PID string, year int, curVal double, curImpVal double")
    for mode, want in (("previous_year", [("A", 2000, 99.0), ("A", 2001, 100.0)]),
                       ("base_year", [("A", 2000, 99.0), ("A", 2001, 100.0), ("A", 2003, 100.0)])):
        out = prior_value(df, mode=mode, base_year=2000, first_factor=0.99)
        assert sorted((r.PID, r.year, r.preVal) for r in out.collect()) == want


def test_dedup_within_key_is_dedup_by_key_laid_out(spark):
    from panelkit.operators import dedup_within_key
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 700).cast("string").alias("k"),
                                    (2000 + F.col("id") % 5).cast("string").alias("y"), (F.col("id") * 7919 % 30_011).alias("v"), F.col("id").alias("w"))
    for keep in ("first", "last"):
        for order in ((), ("v",)):
            rows = lambda d: sorted(map(tuple, d.select("k", "y", "v", "w").collect()))
            want = dedup_by_key(df.where("y <> '2004'"), ["k", "y"], order, keep)
            got = dedup_within_key(df, "k", "y", ["2000", "2001", "2002", "2003", "2000"], order, keep)
            assert rows(got) == rows(want) and got.columns == df.columns
    plan = dedup_within_key(df, "k", "y", ["2000"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1
    assert dedup_within_key(df, "k", "y", []).count() == 0


def test_monthly_states_merge_to_the_state_of_all_rows(spark):
    from panelkit.plans.indicators import merge_states, monthly_from_state, monthly_state, yearly_from_state
    conv = spark.createDataFrame([(f"{m}/{d}/06", f"1.{m:02}{d}") for m in (1, 2, 3) for d in (1, 5)] + [("1/9/06", "Bank holiday"), ("x", "2")], "date string, rate string")
    oil = spark.createDataFrame([("2006-01-03", "60.5"), ("2006-02-03", "."), ("2006-02-04", "62"), ("2007-01-01", "70"), (None, "1")], "date string, oilprice string")
    rate = spark.createDataFrame([("2006-01-31", "5.126"), ("2006-02-28", "5.25"), ("2005-12-01", "9"), ("2006-02-27", "bad")], "date string, `5y-fixed-posted` string")
    rows = lambda df: sorted(map(str, df.collect()))
    whole = monthly_state(conv, oil, rate)
    halves = merge_states(monthly_state(conv.where("rate < '1.03'"), oil.limit(0), rate), monthly_state(conv.where("rate >= '1.03'"), oil, rate.limit(0)))
    assert rows(halves) == rows(whole) and halves.dtypes == whole.dtypes
    year = yearly_from_state(halves).collect()
    assert [(r.year, str(r.interestrates), r.oilprice, str(r.conversionrate)) for r in year] == [(2006, "5.19", 61.25, "1.02")]
    months = sorted(monthly_from_state(halves, oil).collect(), key=str)
    assert [(r.year, r.month, r.oilprice) for r in months if r.oilprice] == [(2006, 1, 60.5), (2006, 2, 62.0)]
    assert len(months) == 3  # the price that is missing has its line
