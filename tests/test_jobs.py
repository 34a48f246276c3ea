"""The file-based jobs, run on the stand-in inputs written in the original
folder layout, give the same panel as the in-memory plan."""

import os

from pyspark.sql import functions as F

from panelkit.plans import catalog
from panelkit.plans import standins as S
from panelkit.plans.indicators import yearly_from_state
from panelkit.plans.jobs import Layout, build_panel_stages, etl_job, indicators_job, read_inputs, regression_job, state_job
from panelkit.session import ensure_checkpoint_dir, scratch_dir
from panelkit.sources.readers import HISTORY_COLUMNS
from tests.conftest import SF_SMALL

LAYOUT = Layout(main_years=S.MAIN_YEARS, reference_year=S.REFERENCE_YEAR, base_year=S.BASE_YEAR,
                history_years=S.HISTORY_YEARS, rate_date_format=S.RATE_DATE_FORMAT, interest_start=S.INTEREST_START,
                monthly_start=S.MONTHLY_START, monthly_end=S.MONTHLY_END, monthly_exclude=S.MONTHLY_EXCLUDE,
                opts=catalog.opts())


def write_inputs(spark):
    root = scratch_dir(spark, "inputs")
    reg = S.register_rows(spark, SF_SMALL)
    for y in (*S.MAIN_YEARS, S.BASE_YEAR, *S.HISTORY_YEARS):
        rows = reg.where(F.col("taxAssess") == str(y))
        if y not in S.MAIN_YEARS:
            rows = rows.select(*HISTORY_COLUMNS)
        rows.write.option("header", True).csv(f"{root}/taxreport/property_tax_report_csv{y}.csv")
    S.conversion_rows(spark, SF_SMALL).write.option("header", True).csv(f"{root}/conversion")
    S.oil_lines(spark, SF_SMALL).write.text(f"{root}/crudeoil")
    S.interest_rows(spark, SF_SMALL).write.option("header", True).csv(f"{root}/interestrate")
    return root


def scratch_folders(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:").rsplit("/", 1)[0]))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_jobs_from_files(spark):
    root = write_inputs(spark)
    src = read_inputs(spark, root, LAYOUT)
    assert rows(build_panel_stages(src, LAYOUT).panel) == rows(catalog.c04_build_panel(spark, SF_SMALL))
    out = scratch_dir(spark, "sets")
    before = scratch_folders(spark)
    paths = etl_job(spark, root, out, LAYOUT)
    assert scratch_folders(spark) - before <= {out.rsplit("/", 1)[1], out.rsplit("/", 1)[1] + "_quality"}
    assert {r.step for r in spark.read.parquet(f"{out}_quality").collect()} == {"main", "base", "history"}
    assert set(paths) == {"training", "testing"}
    census = {r.step: r for r in spark.read.parquet(f"{out}_quality").collect()}
    assert sum(f.lines for f in census["main"].bad_lines) == S.register_rows(spark, SF_SMALL).where(F.col("taxAssess").isin([str(y) for y in S.MAIN_YEARS])).count()
    assert all(f.bad_lines == 0 for r in census.values() for f in [*r.bad_lines, *r.indicator_bad_lines])
    assert len({f.file.rsplit("/", 2)[1] for f in census["history"].bad_lines}) == len(S.HISTORY_YEARS)
    written = spark.read.parquet(out)
    expected = catalog.c07_write_model_sets(spark, SF_SMALL)
    cols = sorted(expected.columns)
    got = rows(written.select(*cols).withColumn("oilprice", F.round("oilprice", 6)))
    assert got == rows(expected.select(*cols))
    assert indicators_job(spark, root, None, LAYOUT).count() == catalog.c06_monthly_indicators(spark, SF_SMALL).count()
    # a state of the months, and the same files added again: means stay, numbers double
    first, second = scratch_dir(spark, "state"), scratch_dir(spark, "state")
    state = state_job(spark, root, first, None, LAYOUT)
    twice = state_job(spark, root, second, first, LAYOUT)
    assert rows(yearly_from_state(twice, S.INTEREST_START).drop("oilprice")) == rows(catalog.c05_yearly_indicators(spark, SF_SMALL).drop("oilprice"))
    assert {(r.series, r.month): r.n for r in twice.collect()} == {(r.series, r.month): 2 * r.n for r in state.collect()}
    scored = scratch_dir(spark, "scored")
    metrics = regression_job(spark, out, scored_out=scored, max_iter=20).collect()
    assert {r.metric for r in metrics} == {"accuracy", "rmse", "left_out"}
    rows_scored = spark.read.parquet(scored)
    assert rows_scored.count() == sum(r.n for r in metrics if r.metric == "rmse") > 0
    with_pca = regression_job(spark, out, max_iter=5, pca_components=4).collect()
    assert {r.metric for r in with_pca} == {"accuracy", "rmse", "left_out"}
