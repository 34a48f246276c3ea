"""Query catalog: one Spark query per inventory row, over the driver's test
tables (through the stand-ins of :mod:`panelkit.plans.standins`).

Doubles that come out of an aggregate are rounded to 6 places here (and in
the matching oracle SQL) because two engines may sum in different orders."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import (
    band_value, code_to_array, concat_codes, date_between, date_from, drop_sentinel, exclude_year,
    has_key, has_length, has_value, month_bucket, not_null, numeric_prefix, onehot_text, prefix_before,
    split_bucket, valid_code, valid_vector, year_bucket,
)
from panelkit.operators import (
    accuracy, apply_feature_pipeline, assemble_features, backfill_attribute, cast_numeric, category_codes, complete_cases,
    correlate_with, correlation_list, dedup_by_key, describe_numeric, distinct_values, encode_categories,
    encode_legal, encode_zone, fill_from, fit_band_classifier, fit_categories, fit_feature_pipeline,
    fit_per_class_regression, impute_prior, join_indicators, map_values, mean_by_month,
    mean_by_year, model_table, pca_project, predict_band, predict_per_class, prior_value, project,
    project_rename, quality_report, resample_month_to_year, rmse, rmse_by_class, scale_year, split_label,
    stack_years, standardize, two_stage_model, weight_by_correlation,
)
from panelkit.plans import standins as S
from panelkit.plans.indicators import conversion_monthly, monthly_indicators, yearly_indicators
from panelkit.plans.model import certificate, read_model_set, train_value_model, write_model_sets
from panelkit.plans.register import CleanOptions, materialize, register_panel
from panelkit.session import scratch_dir
from panelkit.stages import releasing, store_stage
from panelkit.sources import (
    HISTORY_COLUMNS, as_view, parse_whitespace, preview, row_count, scan_header_only, scan_parquet, scan_rates,
    scan_register, scan_register_hist, scan_whitespace, scan_years, write_delimited, write_parquet,
)
from panelkit.functions.text import band_index

DIGITS = 6
MAIN_10 = ("PID", "legalType", "zoneName", "zoneCat", "postalCode", "curVal", "curImpVal", "taxAssess",
           "preVal", "preImpVal")
LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def rnd(df: DataFrame, *cols, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def opts() -> CleanOptions:
    return CleanOptions(postal_len=S.STANDIN_POSTAL_LEN, zone_names=S.STANDIN_ZONE_NAMES, zone_codes=S.STANDIN_ZONE_CODES,
                        legal_values=S.STANDIN_LEGAL)


# ---------------------------------------------------------------- inputs
def reg(spark, d):
    return S.register_rows(spark, d)


def stages(spark, d, mode="previous_year", main_only=False):
    # the stand-in register plays the yearly files: materialize it once, as
    # those would be on disk, instead of re-deriving it for every reader (the
    # main years alone have one reader)
    r = reg(spark, d) if main_only else materialize(reg(spark, d), "table")
    return register_panel(r, S.history_rows(r), S.MAIN_YEARS, S.BASE_YEAR, S.HISTORY_YEARS,
                          S.REFERENCE_YEAR, opts(), mode)


def conv(spark, d):
    return S.conversion_rows(spark, d)


def oil(spark, d):
    return parse_whitespace(S.oil_lines(spark, d))


def interest(spark, d):
    return S.interest_rows(spark, d)


def yearly(spark, d):
    return yearly_indicators(conv(spark, d), oil(spark, d), interest(spark, d),
                             date_format=S.RATE_DATE_FORMAT, interest_start=S.INTEREST_START)


def cy_panel(spark, d):
    return S.customer_year_panel(spark, d)


def _csv_round_trip(spark, df, label, header=True):
    path = scratch_dir(spark, label)
    df.write.option("header", header).csv(path)
    return path


# ---------------------------------------------------------------- sources
def s01_scan_register(spark, d):
    return scan_register(spark, _csv_round_trip(spark, reg(spark, d), "register"))


def s02_scan_register_hist(spark, d):
    path = _csv_round_trip(spark, reg(spark, d).select(*HISTORY_COLUMNS), "register-hist")
    return scan_register_hist(spark, path)


def s03_scan_years(spark, d):
    path = scratch_dir(spark, "register-years")
    reg(spark, d).withColumn("file_year", F.col("taxAssess")).write.partitionBy("file_year") \
        .option("header", True).csv(path)
    return scan_years(spark, lambda y: f"{path}/file_year={y}", S.MAIN_YEARS)


def s04_scan_rates(spark, d):
    return scan_rates(spark, _csv_round_trip(spark, conv(spark, d), "rates"))


def s05_scan_header_only(spark, d):
    return scan_header_only(spark, _csv_round_trip(spark, interest(spark, d), "interest"))


def s06_scan_whitespace(spark, d):
    path = scratch_dir(spark, "oil")
    S.oil_lines(spark, d).write.text(path)
    return scan_whitespace(spark, path)


def s08_scan_parquet(spark, d):
    return scan_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])


def s09_write_parquet(spark, d):
    path = write_parquet(cy_panel(spark, d), scratch_dir(spark, "panel"), partition_by="year")
    return spark.read.parquet(path).select("PID", "year", "curVal", "curImpVal")


def s10_write_delimited(spark, d):
    path = write_delimited(reg(spark, d).select("PID", "taxAssess", "legalType", "curVal"),
                           scratch_dir(spark, "lines"), sep=" ")
    return spark.read.text(path)


def s11_as_view(spark, d):
    as_view(reg(spark, d), "taxreport")
    return spark.sql("SELECT PID, legalType, zoneName, curVal, taxAssess FROM taxreport "
                     "WHERE NOT (PID = '') AND length(trim(zoneName)) = 6")


def s13_row_count(spark, d):
    return row_count(reg(spark, d))


def s14_preview(spark, d):
    return preview(cy_panel(spark, d), 20, order_by=["PID", "year"])


# ---------------------------------------------------------------- projections
def p01_project(spark, d):
    return project(reg(spark, d), MAIN_10)


def p02_project_rename(spark, d):
    return project_rename(reg(spark, d), ["PID", "legalType", "curVal", "taxAssess"], {"taxAssess": "year"})


def p05_impute_prior(spark, d):
    base = cy_panel(spark, d).where(F.col("year") == S.BASE_YEAR)
    return impute_prior(base)


def p06_cast_numeric(spark, d):
    return cast_numeric(reg(spark, d), ["curVal", "curImpVal", "taxAssess", "preVal", "preImpVal"],
                        keep=("PID", "folio"))


def p07_fill_from(spark, d):
    r = reg(spark, d).select("folio", "zoneName", "zoneCat")
    return fill_from(r, "zoneCat", "zoneName", lambda c: prefix_before(c, "-", missing="CD"))


def p08_map_values(spark, d):
    o = S.table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    return map_values(o, "o_orderpriority", {"1-URGENT": "2-HIGH", "2-HIGH": "3-MEDIUM"})


# ---------------------------------------------------------------- predicates
def w01_has_key(spark, d):
    return reg(spark, d).where(has_key("postalCode")).select("folio", "postalCode")


def w02_has_length(spark, d):
    return S.table(spark, d, "orders", "o_orderkey", "o_orderpriority").where(has_length("o_orderpriority", 6))


def w03_has_value(spark, d):
    return reg(spark, d).where(has_value("zoneName")).select("folio", "zoneName")


def w04_numeric_prefix(spark, d):
    return conv(spark, d).where(numeric_prefix("rate")).select("date", "rate")


def w05_not_null(spark, d):
    c = conv(spark, d).select("date", F.col("rate").try_cast("double").alias("rate"))
    return c.where(not_null("rate"))


def w06_complete_cases(spark, d):
    typed = cast_numeric(reg(spark, d), ["curVal", "curImpVal", "preVal", "preImpVal"], keep=("folio",))
    return complete_cases(typed, ["curVal", "curImpVal", "preVal", "preImpVal"])


def w07_drop_sentinel(spark, d):
    return oil(spark, d).where(drop_sentinel("oilprice"))


def w08_date_from(spark, d):
    return interest(spark, d).where(date_from("date", "1996-01")).select("date", "5y-fixed-posted")


def w09_date_between(spark, d):
    return interest(spark, d).where(date_between("date", "1996-01", "2000-12")).select("date", "5y-fixed-posted")


def w10_exclude_year(spark, d):
    c = conv(spark, d).withColumn("month", month_bucket("date", S.RATE_DATE_FORMAT))
    return c.where(exclude_year("month", 2001)).select("date", "month", "rate")


def w12_valid_vector(spark, d):
    main = stages(spark, d, main_only=True)["main"]
    code = concat_codes("zoneCat", "legalType", "FSA")
    vectors = main.select("PID", "year", code.alias("code"), code_to_array(code, "year", width=16).alias("vector"))
    return vectors.where(valid_vector("vector", 17) & valid_code("code", 16)) \
        .select("PID", "year", "code", F.size("vector").alias("size"))


# ---------------------------------------------------------------- joins
def j01_backfill_attribute(spark, d):
    target = cy_panel(spark, d).where(F.col("year") < F.lit(min(S.MAIN_YEARS)))
    donor = reg(spark, d).where(F.col("taxAssess").isin([str(y) for y in S.MAIN_YEARS])) \
        .select("PID", F.col("taxAssess").cast("int").alias("year"), "zoneName")
    return backfill_attribute(target, donor, "PID", ["zoneName"], ["year"])


def j02_prior_value(spark, d):
    return prior_value(cy_panel(spark, d), "PID", "year", mode="previous_year")


def j02_prior_value_base_year(spark, d):
    return prior_value(cy_panel(spark, d), "PID", "year", mode="base_year", base_year=S.BASE_YEAR)


def _int_year(spark, d):
    return mean_by_year(interest(spark, d).where(date_from("date", S.INTEREST_START)), "date", "5y-fixed-posted",
                        "interestrates", rounding=(4, 2), value_type="decimal(4,2)")


def _oil_year(spark, d):
    return mean_by_year(oil(spark, d).where(drop_sentinel("oilprice")), "date", "oilprice", "oilprice")


def _conv_year(spark, d):
    return resample_month_to_year(conversion_monthly(conv(spark, d), S.RATE_DATE_FORMAT), "conversionrate")


def j03_join_indicators(spark, d):
    return rnd(join_indicators(_int_year(spark, d), _oil_year(spark, d), "year"), "oilprice")


def j04_join_indicators(spark, d):
    j = join_indicators(join_indicators(_int_year(spark, d), _oil_year(spark, d), "year"), _conv_year(spark, d))
    return rnd(j.select("year", "interestrates", "oilprice", "conversionrate"), "oilprice")


def j05_model_table(spark, d):
    return rnd(model_table(cy_panel(spark, d), yearly(spark, d)), "oilprice")


# ---------------------------------------------------------------- keys, aggregates
def d01_dedup_by_key(spark, d):
    o = S.table(spark, d, "orders")
    return dedup_by_key(o, ["o_custkey"], order_by=["o_orderdate"])


def d02_distinct_values(spark, d):
    p = S.table(spark, d, "part", "p_name").select(prefix_before("p_name", " ", strip=True).alias("FSA"))
    return distinct_values(p, "FSA")


def a01_mean_by_month(spark, d):
    return conversion_monthly(conv(spark, d), S.RATE_DATE_FORMAT)


def a02_resample_month_to_year(spark, d):
    return _conv_year(spark, d)


def a03_mean_by_year(spark, d):
    return rnd(_oil_year(spark, d), "oilprice")


def a04_mean_by_year(spark, d):
    return _int_year(spark, d)


def a05_mean_by_month(spark, d):
    m = mean_by_month(interest(spark, d), "date", "5y-fixed-posted", "interestrates", rounding=None,
                      value_type="decimal(4,2)")
    return rnd(m, "interestrates")


def a06_quality_report(spark, d):
    return quality_report(reg(spark, d))


def a07_describe_numeric(spark, d):
    return rnd(describe_numeric(cy_panel(spark, d), ["curVal", "curImpVal", "year"]), "curVal", "curImpVal", "year")


def a08_correlate_with(spark, d):
    li = S.table(spark, d, "lineitem", *LI_NUM)
    return rnd(correlate_with(li, "l_extendedprice", LI_NUM), "correlation")


# ---------------------------------------------------------------- union
def u01_stack_years(spark, d):
    s = stages(spark, d)
    return stack_years([s["main"], s["base"]], numeric=("curVal", "curImpVal", "preVal", "preImpVal"))


def u02_stack_years(spark, d):
    r = reg(spark, d)
    text_rows = r.where(F.col("taxAssess") != str(S.BASE_YEAR)).select("PID", "taxAssess", "preVal")
    base = impute_prior(r.where(F.col("taxAssess") == str(S.BASE_YEAR)), {"preVal": "curVal"}) \
        .select("PID", "taxAssess", "preVal")
    return stack_years([text_rows, base], numeric=("preVal",))


# ---------------------------------------------------------------- scalar functions
def t01_prefix_before(spark, d):
    p = S.table(spark, d, "part", "p_partkey", "p_name")
    return p.select("p_partkey", prefix_before("p_name", " ", strip=True).alias("FSA"))


def t02_prefix_before(spark, d):
    return reg(spark, d).select("folio", prefix_before("zoneName", "-", missing="CD").alias("zoneCat"))


def t03_onehot_text(spark, d):
    p = S.table(spark, d, "part", "p_partkey", "p_size")
    return p.select("p_partkey", onehot_text(F.col("p_size") - 1, 50).alias("code"))


def t04_onehot_text(spark, d):
    """The codes of all n values; n is counted once (a fitted width)."""
    n = S.table(spark, d, "nation", "n_nationkey")
    return n.select("n_nationkey", onehot_text(F.col("n_nationkey"), n.count()).alias("code"))


def t05_month_bucket(spark, d):
    return conv(spark, d).select("date", month_bucket("date", S.RATE_DATE_FORMAT).alias("month"))


def t06_split_bucket(spark, d):
    m = conversion_monthly(conv(spark, d), S.RATE_DATE_FORMAT)
    y, mo = split_bucket("month")
    return m.select(y.alias("year"), mo.alias("month"), "conversionrate")


def t08_year_bucket(spark, d):
    return oil(spark, d).select("date", year_bucket("date").alias("year"))


def t09_month_bucket(spark, d):
    li = S.table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    return li.select("l_orderkey", "l_linenumber", month_bucket("l_shipdate").alias("month"))


def t11_concat_codes(spark, d):
    main = stages(spark, d, main_only=True)["main"]
    return main.select("PID", "year", concat_codes("zoneCat", "legalType", "FSA").alias("LegalZoneFSA"))


def t12_concat_codes(spark, d):
    main = stages(spark, d, main_only=True)["main"]
    return main.select(concat_codes("PID", "year", "zoneCat", "legalType", "FSA", sep=",").alias("line"))


def t13_code_to_array(spark, d):
    main = stages(spark, d, main_only=True)["main"]
    code = concat_codes("zoneCat", "legalType", "FSA")
    return main.select("PID", "year", code_to_array(code, "year", width=16).alias("vector"))


def t14_band_value(spark, d):
    return cy_panel(spark, d).select("PID", "year", band_value("curVal").alias("band"))


# ---------------------------------------------------------------- encoders, features
def _fsa(spark, d):
    return S.table(spark, d, "part", "p_partkey", "p_name") \
        .select("p_partkey", prefix_before("p_name", " ", strip=True).alias("FSA"))


def f01_fit_categories(spark, d):
    return category_codes(fit_categories(_fsa(spark, d), "FSA"))


def f01_encode_categories(spark, d):
    fsa = _fsa(spark, d)
    return encode_categories(fsa, "FSA", fit_categories(fsa, "FSA"))


def _early_words(spark, d):
    """All parts, and a dictionary of the words before 'm': the others are unseen."""
    fsa = _fsa(spark, d)
    return fsa, fit_categories(fsa.where(F.col("FSA") < "m"), "FSA")


def f01_encode_categories_null(spark, d):
    fsa, words = _early_words(spark, d)
    return encode_categories(fsa, "FSA", words, unseen="null", raw="fsaText")


def f01_encode_categories_keep(spark, d):
    fsa, words = _early_words(spark, d)
    return encode_categories(fsa, "FSA", words, unseen="keep")


def f02_encode_zone(spark, d):
    z = fill_from(reg(spark, d).select("folio", "zoneName", "zoneCat"), "zoneCat", "zoneName",
                  lambda c: prefix_before(c, "-", missing="CD"))
    return encode_zone(z.drop("zoneName"), "zoneCat", S.STANDIN_ZONE_NAMES, S.STANDIN_ZONE_CODES)


def f03_encode_legal(spark, d):
    o = S.table(spark, d, "orders", "o_orderkey", "o_orderstatus")
    return encode_legal(o, "o_orderstatus", S.STANDIN_LEGAL)


def f05_standardize(spark, d):
    li = S.table(spark, d, "lineitem", "l_orderkey", "l_linenumber", *LI_NUM)
    return rnd(standardize(li, LI_NUM), *LI_NUM)


def f06_scale_year(spark, d):
    li = S.table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate") \
        .select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"))
    return rnd(scale_year(li, "year"), "year")


def f07_weight_by_correlation(spark, d):
    li = S.table(spark, d, "lineitem", "l_orderkey", "l_linenumber", *LI_NUM)
    w = correlation_list(li, "l_extendedprice", LI_NUM)
    return rnd(weight_by_correlation(li, LI_NUM, w), *LI_NUM)


def f08_pca_project(spark, d):
    e = S.table(spark, d, "embeddings", "vec_id", "embedding")
    width = S.table(spark, d, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    _, out = pca_project(e, "embedding", width, "pca")
    # all components: a rotation, which keeps every row's length
    square = F.aggregate(vector_to_array("pca"), F.lit(0.0), lambda s, x: s + x * x)
    return out.select("vec_id", F.round(square, 4).alias("squared_length"))


def f09_assemble_features(spark, d):
    mt = model_table(stages(spark, d, main_only=True)["main"], yearly(spark, d))
    out = assemble_features(mt, ("zoneCat", "legalType", "FSA"), ("curImpVal", "year"), out="features")
    return out.select("PID", "year", "features")


def _features(spark, d):
    mt = rnd(model_table(stages(spark, d)["panel"], yearly(spark, d)), "oilprice")
    params = fit_feature_pipeline(mt.where(train_or_test() == "training"))
    return apply_feature_pipeline(mt.withColumn("keyYear", F.col("year")), params, as_vector=False)


def train_or_test():
    return split_label(["PID", "year"], (0.6, 0.4), ("training", "testing"))


def f10_feature_pipeline(spark, d):
    """Fitted on the training rows, applied to all."""
    return _features(spark, d).select("PID", F.col("keyYear").alias("year"), F.transform("features", lambda x: F.round(x, 4) + F.lit(0.0)).alias("features"))


# ---------------------------------------------------------------- split
def r01_hash_split(spark, d):
    o = S.table(spark, d, "orders", "o_orderkey")
    return o.select("o_orderkey", split_label(["o_orderkey"], (0.6, 0.4), ("training", "testing")).alias("split"))


def r02_hash_split(spark, d):
    p = cy_panel(spark, d).withColumn("band", band_value("curVal"))
    return p.select("PID", "year", "band",
                    split_label(["band", "PID", "year"], (0.7, 0.3), ("training", "testing")).alias("split"))


def r05_stage_tables(spark, d):
    """A stage that two others read, and their result: only its table is left."""
    with releasing(spark) as step:
        panel = store_stage(cy_panel(spark, d), "panel")
        sums = store_stage(panel.groupBy("year").agg(F.count("*").alias("n"), F.sum("curVal").alias("total")), "years")
        top = store_stage(panel.groupBy("year").agg(F.max("curVal").alias("largest")), "largest")
        return step.keep(rnd(store_stage(sums.join(top, "year"), "summary"), "total", digits=2))


# ---------------------------------------------------------------- models
def _legal_features(spark, d):
    """Rows with one saturated block of features, the legal type: the fitted
    probabilities are then the shares of the bands among its rows."""
    rows = stages(spark, d)["panel"].where(F.col("curImpVal").isNotNull())
    return assemble_features(rows, ("legalType",), (), widths={"legalType": len(S.STANDIN_LEGAL)}) \
        .withColumn("band", band_index("curVal"))


def m02_fit_band_classifier(spark, d):
    """Bands by legal type: their share, and whether the model gives it (to 0.01)."""
    f = materialize(_legal_features(spark, d), "table")
    model = fit_band_classifier(f, "features", "band", max_iter=100)
    p = vector_to_array("probability")
    scored = model.transform(f).select("legalType", "band", F.get(p, F.col("band").cast("int")).alias("p"))
    counted = scored.groupBy("legalType", "band").agg(F.count("*").alias("n"), F.avg("p").alias("p"))
    total = counted.groupBy("legalType").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    return counted.join(total, "legalType").select("legalType", "band", "n", F.round(share, 6).alias("share"),
                                                   (F.abs(F.col("p") - share) <= 0.01).alias("given"))


def m03_predict_band(spark, d):
    f = materialize(_legal_features(spark, d), "table")
    model = fit_band_classifier(f, "features", "band", max_iter=100)
    return predict_band(model, f).select("PID", "year", "band", "predicted_band")


def _band_frame(spark, d):
    return cy_panel(spark, d).withColumn("class", band_index("curVal"))


def m04_fit_per_class_regression(spark, d):
    c = fit_per_class_regression(_band_frame(spark, d), "class", ["curImpVal"], "curVal")
    out = c.select("class", "n", "intercept", F.element_at("coefficients", 1).alias("slope"))
    return rnd(out, "intercept", "slope")


def m04_fit_per_class_regression_two(spark, d):
    """Two features, value totals and year, all bands; a band whose features
    depend on each other shares the slope between them by their deviations."""
    c = fit_per_class_regression(_band_frame(spark, d), "class", ["curImpVal", "year"], "curVal")
    out = c.select("class", "n", "intercept", F.element_at("coefficients", 1).alias("slope"),
                   F.element_at("coefficients", 2).alias("year_slope"))
    return rnd(out, "intercept", "slope", "year_slope", digits=3)


def m05_two_stage_model(spark, d):
    f = materialize(_legal_features(spark, d).drop("band"), "table")
    res = two_stage_model(f.where(train_or_test() == "training"), f.where(train_or_test() == "testing"),
                          "curVal", "features", ("curImpVal",))
    return rnd(res.scored.where("part = 'score'").select("PID", "year", "band", "predicted_band", "predicted_value"), "predicted_value", digits=1)


def _one_feature_predictions(spark, d):
    b = _band_frame(spark, d)
    c = fit_per_class_regression(b, "class", ["curImpVal"], "curVal")
    return predict_per_class(b, c, "class", ["curImpVal"], "prediction")


def e01_accuracy(spark, d):
    p = prior_value(cy_panel(spark, d), "PID", "year", pairs={"preVal": "curVal"})
    return rnd(accuracy(p.select(band_value("curVal").alias("label"), band_value("preVal").alias("prediction"))),
               "accuracy")


def e02_rmse(spark, d):
    return rnd(rmse(_one_feature_predictions(spark, d), "curVal", "prediction"), "rmse", digits=4)


def e03_rmse_by_class(spark, d):
    return rnd(rmse_by_class(_one_feature_predictions(spark, d), "class", "curVal", "prediction"), "rmse", digits=4)


# ---------------------------------------------------------------- composites
def c01_clean_main_year(spark, d):
    return stages(spark, d, main_only=True)["main"]


def c02_clean_base_year(spark, d):
    return stages(spark, d)["base"]


def c03_clean_history(spark, d):
    return stages(spark, d)["history"]


def c04_build_panel(spark, d):
    return stages(spark, d)["panel"]


def c05_yearly_indicators(spark, d):
    return rnd(yearly(spark, d), "oilprice")


def c06_monthly_indicators(spark, d):
    m = monthly_indicators(conv(spark, d), oil(spark, d), interest(spark, d), date_format=S.RATE_DATE_FORMAT,
                           start=S.MONTHLY_START, end=S.MONTHLY_END, exclude=S.MONTHLY_EXCLUDE)
    return rnd(m, "interestrates")


def model_sets(spark, d) -> str:
    """C07's sink: the folder holding the training and testing sets."""
    out = scratch_dir(spark, "model-sets")
    write_model_sets(stages(spark, d)["panel"], rnd(yearly(spark, d), "oilprice"), out)
    return out


def c07_write_model_sets(spark, d):
    return spark.read.parquet(model_sets(spark, d))


def train_from_sets(spark, out: str, **options):
    """C08 proper (S08 onward): scan the written sets, fit, evaluate."""
    res = train_value_model(read_model_set(spark, out, "training"), read_model_set(spark, out, "testing"), **options)
    return res["metrics"]


C08_SHORT = {"code_cols": ("legalType",), "numeric_cols": (), "regression_features": ("curImpVal",)}


def c08_train_value_model(spark, d):
    """Standalone C08: writes the sets (C07) first, then trains on them, so
    the fits scan Parquet instead of re-running the panel lineage. The legal
    type classifies, the improvement value regresses: both have closed forms."""
    return rnd(train_from_sets(spark, model_sets(spark, d), **C08_SHORT), "value", digits=4)


def c08_train_value_model_full(spark, d):
    """C08 on all code blocks and numbers; the bands' regressions take the
    whole vector. Such a fit has no closed form, but its optimum has a
    certificate: per band the training rows, and for the rows scored, the sums
    of the score equations, which are 0 (to 2 places, in units of the features)
    whatever the data; and the test rows left out."""
    out = model_sets(spark, d)
    res = train_value_model(read_model_set(spark, out, "training"), read_model_set(spark, out, "testing"))
    left = res["metrics"].where("metric = 'left_out'").select(F.lit("left_out").alias("equation"), F.lit(None).cast("double").alias("class"),
                                                              "n", F.lit(0.0).alias("score"))
    return rnd(certificate(res).unionByName(left), "score", digits=2)


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and name[:1] in "spwjdautfrmec" and name[1:3].isdigit() and "_" in name}


def t07_split_bucket(spark, d):
    """The same split applied to the raw month text of every rate row."""
    c = conv(spark, d).select(month_bucket("date", S.RATE_DATE_FORMAT).alias("bucket"))
    y, mo = split_bucket("bucket")
    return c.select("bucket", y.alias("year"), mo.alias("month"))


QUERIES["t07_split_bucket"] = t07_split_bucket


def c03_clean_history_base_year(spark, d):
    """C03 with the compatibility switch ``mode='base_year'`` (what the old
    script ran: every history year takes its prior from the base year)."""
    return stages(spark, d, mode="base_year")["history"]


def j01_backfill_attribute_left(spark, d):
    """J01 with ``how='left'``: rows without a donor keep a NULL attribute."""
    target = cy_panel(spark, d).where(F.col("year") < F.lit(min(S.MAIN_YEARS)))
    donor = reg(spark, d).where(F.col("taxAssess").isin([str(y) for y in S.MAIN_YEARS])) \
        .select("PID", F.col("taxAssess").cast("int").alias("year"), "zoneName")
    return backfill_attribute(target, donor, "PID", ["zoneName"], ["year"], how="left")


def w09_date_between_text_bounds(spark, d):
    """W09 with ``text_bounds=True`` (old text comparison: the end month is
    cut after its first day)."""
    return interest(spark, d).where(date_between("date", "1996-01", "2000-12", text_bounds=True)) \
        .select("date", "5y-fixed-posted")


for _name in ("c03_clean_history_base_year", "j01_backfill_attribute_left", "w09_date_between_text_bounds"):
    QUERIES[_name] = globals()[_name]
