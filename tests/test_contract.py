"""Driver contract on the smallest tables: entry, and every query against
its DuckDB oracle (row count, column names, order-free values)."""

import collections
import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as E
from panelkit.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), collections.Counter(tuple(canon(r[i]) for i in order) for r in rows)


def test_entry_has_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "PID", "curVal", "curImpVal", "interestrates", "oilprice", "conversionrate"]
    assert dict(df.dtypes)["interestrates"] == "double"
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_a_model():
    assert set(QUERIES) <= set(E.oracle_sql())


FAST = ["c04_build_panel", "c05_yearly_indicators", "c06_monthly_indicators", "j05_model_table", "d01_dedup_by_key",
        "f01_encode_categories", "j02_prior_value", "e03_rmse_by_class", "s01_scan_register", "a06_quality_report",
        "t13_code_to_array", "r02_hash_split", "s02_scan_register_hist", "s03_scan_years", "s04_scan_rates",
        "s05_scan_header_only", "s06_scan_whitespace", "s10_write_delimited", "u02_stack_years", "t04_onehot_text",
        "m04_fit_per_class_regression", "a08_correlate_with", "c07_write_model_sets", "w12_valid_vector",
        "f08_pca_project", "f10_feature_pipeline", "m02_fit_band_classifier", "m03_predict_band", "m05_two_stage_model",
        "c08_train_value_model", "f01_encode_categories_keep", "f02_encode_zone", "t02_prefix_before", "w08_date_from",
        "w09_date_between", "t08_year_bucket", "t09_month_bucket", "m04_fit_per_class_regression_two",
        "c08_train_value_model_full", "f01_encode_categories_null", "c02_clean_base_year", "c03_clean_history",
        "c03_clean_history_base_year", "j02_prior_value_base_year"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    want = table([d[0] for d in res.description], res.fetchall())
    assert got == want


def test_full_model_metrics(spark):
    from panelkit.plans import catalog
    m = catalog.train_from_sets(spark, catalog.model_sets(spark, SF_SMALL)).collect()
    assert {"accuracy", "rmse", "left_out"} == {r.metric for r in m}
    assert [r.n for r in m if r.metric == "left_out"][0] > 0  # rows whose zone no code stands for


def test_rates_are_decimals_in_the_library(spark):
    """The contract presents them as DOUBLE; the library's own type is decimal(4,2)."""
    from panelkit.plans import catalog
    assert dict(catalog.c05_yearly_indicators(spark, SF_SMALL).dtypes)["conversionrate"] == "decimal(4,2)"
    assert dict(catalog.a04_mean_by_year(spark, SF_SMALL).dtypes)["interestrates"] == "decimal(4,2)"


@pytest.mark.parametrize("name,column", [("w03_has_value", "zoneName"), ("p07_fill_from", "zoneCat")])
def test_stand_ins_reach_both_outcomes(spark, name, column):
    from panelkit.plans import catalog
    rows = catalog.reg(spark, SF_SMALL).select("zoneName", "zoneCat", "postalCode").collect()
    assert 0 < sum(r[column] == "" for r in rows) < len(rows)
    assert 0 < sum(len(r.postalCode) == 20 for r in rows) < len(rows)
