"""End-to-end jobs over input files: the register-cleaning ETL (C01-C05,
C07), the monthly indicator table (C06) and model training (C08).

File layout (defaults follow the original inputs folder):

    <inputs>/taxreport/property_tax_report_csv<year>.csv   register, one file per year
    <inputs>/conversion/                                   conversion-rate CSVs
    <inputs>/crudeoil/                                     whitespace text, date price
    <inputs>/interestrate/                                 CSV with header

usage:
    python -m panelkit.plans.jobs etl <inputs> <output>
    python -m panelkit.plans.jobs indicators <inputs> <output>
    python -m panelkit.plans.jobs state <inputs> <state> [<previous state>]
    python -m panelkit.plans.jobs regression <output> [<metrics> [<scored rows>]]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.quality import QualityWatch
from panelkit.plans.indicators import merge_states, monthly_indicators, monthly_state, yearly_indicators
from panelkit.plans.model import read_model_set, train_value_model, write_model_sets
from panelkit.plans.register import STEPS, CleanOptions, RegisterPanel, register_panel
from panelkit.session import scratch_scope
from panelkit.sources import (
    HISTORY_SCHEMA, RATE_SCHEMA, REGISTER_SCHEMA, census_csv, census_whitespace, scan_header_only, scan_rates,
    scan_whitespace, scan_years,
)
from panelkit.stages import StageLedger

# Names of the original input files and folders.
REGISTER_FILE = "taxreport/property_tax_report_csv{year}.csv"


@dataclass
class Layout:
    """Years and input conventions; the defaults are the original ones."""
    main_years: tuple = (2014, 2015, 2016)
    reference_year: int = 2016
    base_year: int = 2006
    history_years: tuple = tuple(range(2007, 2014))
    register_file: str = REGISTER_FILE
    rate_date_format: str = "M/d/yy"
    interest_start: str = "2006-01"
    monthly_start: str = "2006-01"
    monthly_end: str = "2015-12"
    monthly_exclude: int | None = 2016
    opts: CleanOptions = field(default_factory=CleanOptions)
    prior_mode: str = "previous_year"


def _path(inputs: str, rel: str) -> str:
    return f"{inputs.rstrip('/')}/{rel}"


def read_inputs(spark: SparkSession, inputs: str, layout: Layout = Layout()) -> dict:
    """Scan every input once: main years (28 columns) and historical years
    (24 columns) as one multi-file scan each, and the three series."""
    reg_path = lambda y: _path(inputs, layout.register_file.format(year=y))
    return {
        "register_main": scan_years(spark, reg_path, layout.main_years),
        "register_hist": scan_years(spark, reg_path, [layout.base_year, *layout.history_years], historical=True),
        "conversion": scan_rates(spark, _path(inputs, "conversion")),
        "oil": scan_whitespace(spark, _path(inputs, "crudeoil")),
        "interest": scan_header_only(spark, _path(inputs, "interestrate")),
    }


def line_census(spark: SparkSession, inputs: str, layout: Layout = Layout()) -> DataFrame:
    """``step``, ``bad_lines`` and ``indicator_bad_lines``: for the register
    files of each cleaning step, and for the files of the three series, how many
    lines each has and how many don't fit (:mod:`panelkit.sources.census`)."""
    reg_path = lambda y: _path(inputs, layout.register_file.format(year=y))
    steps = {"main": (layout.main_years, REGISTER_SCHEMA), "base": ((layout.base_year,), HISTORY_SCHEMA),
             "history": (layout.history_years, HISTORY_SCHEMA)}
    files = F.array_sort(F.collect_list(F.struct("file", "lines", "bad_lines"))).alias("files")
    rows = [census_csv(spark, [reg_path(y) for y in years], schema).agg(files).select(F.lit(step).alias("step"), "files")
            for step, (years, schema) in steps.items() if years]
    series = (census_csv(spark, _path(inputs, "conversion"), RATE_SCHEMA).unionByName(census_csv(spark, _path(inputs, "interestrate")))
              .unionByName(census_whitespace(spark, _path(inputs, "crudeoil"))).agg(files).select(F.lit(None).cast("string").alias("step"), "files"))
    found = {r["step"]: r["files"] for r in reduce(DataFrame.unionByName, [*rows, series]).collect()}  # a line per input file
    kind = "array<struct<file: string, lines: long, bad_lines: long>>"
    return spark.createDataFrame([(s, found[s], found[None]) for s in steps if s in found], f"step string, bad_lines {kind}, indicator_bad_lines {kind}")


def build_panel_stages(src: dict, layout: Layout = Layout(), panel_only: bool = False) -> RegisterPanel:
    return register_panel(src["register_main"], src["register_hist"], layout.main_years, layout.base_year,
                          layout.history_years, layout.reference_year, layout.opts, layout.prior_mode, panel_only=panel_only)


def build_yearly(src: dict, layout: Layout = Layout()) -> DataFrame:
    return yearly_indicators(src["conversion"], src["oil"], src["interest"], date_format=layout.rate_date_format,
                             interest_start=layout.interest_start)


def etl_job(spark: SparkSession, inputs: str, output: str, layout: Layout = Layout(),
            fractions=(0.6, 0.4)) -> dict:
    """Register files + indicators -> panel -> model table -> training and
    testing sets written under ``output`` (partitioned by ``split``), and the
    quality rows of every cleaning step (A06) beside it, in ``<output>_quality``.

    The panel runs once: its quality is counted while the sets are written
    (should the counts not agree with what was written, because Spark repeated a
    task, they are taken anew from a panel of their own). The quality rows carry
    the census of the input lines. Stage tables go with their last reader; the
    job's scratch folders are gone when it ends."""
    src = read_inputs(spark, inputs, layout)
    years = [*layout.main_years, layout.base_year, *layout.history_years]
    with scratch_scope(spark), StageLedger(spark).recording():
        stages = build_panel_stages(src, layout, panel_only=True)
        panel = stages.panel
        watch = QualityWatch(panel.columns, STEPS, "year", years)
        paths = write_model_sets(watch.watch(panel, stages.step), build_yearly(src, layout), output, fractions)
        written = {r["year"]: r["count"] for r in spark.read.parquet(output).groupBy("year").count().collect()}
        if written and watch.agrees(written):
            quality = watch.report(spark)
        else:
            quality = build_panel_stages(src, layout).quality
        (quality.join(line_census(spark, inputs, layout), "step", "left")
         .write.mode("errorifexists").parquet(f"{output.rstrip('/')}_quality"))
    return paths


def indicators_job(spark: SparkSession, inputs: str, output: str | None = None,
                   layout: Layout = Layout()) -> DataFrame:
    """Monthly indicator table (C06); written as Parquet when ``output`` is given."""
    src = read_inputs(spark, inputs, layout)
    table = monthly_indicators(src["conversion"], src["oil"], src["interest"], date_format=layout.rate_date_format,
                               start=layout.monthly_start, end=layout.monthly_end, exclude=layout.monthly_exclude)
    if output:
        table.write.mode("errorifexists").parquet(output)
    return table


def state_job(spark: SparkSession, inputs: str, state_out: str, previous: str | None = None, layout: Layout = Layout()) -> DataFrame:
    """The series' sums by month (:func:`monthly_state`) of the files under
    ``inputs``, added to the stored state ``previous`` if there is one, written
    to ``state_out`` and read back. Files of a new month cost a read of their own
    rows; years (:func:`yearly_from_state`) and months come from the state."""
    src = read_inputs(spark, inputs, layout)
    state = monthly_state(src["conversion"], src["oil"], src["interest"], layout.rate_date_format)
    if previous:
        state = merge_states(spark.read.parquet(previous), state)
    state.write.mode("errorifexists").parquet(state_out)
    return spark.read.schema(state.schema).parquet(state_out)


def regression_job(spark: SparkSession, sets_dir: str, metrics_out: str | None = None, scored_out: str | None = None,
                   **options) -> DataFrame:
    """Train on ``training``, score ``testing`` (C08; ``options`` go to
    :func:`train_value_model`). The metric table is written as Parquet when
    ``metrics_out`` is given, the scored rows (key, value, bands, predicted
    value) when ``scored_out`` is. The job's scratch folders are gone when it ends."""
    with scratch_scope(spark), StageLedger(spark).recording():
        res = train_value_model(read_model_set(spark, sets_dir, "training"), read_model_set(spark, sets_dir, "testing"), **options)
        if scored_out:
            (res["result"].scored.where("part = 'score'")
             .select("PID", F.col("keyYear").alias("year"), "curVal", "band", "predicted_band", "predicted_value")
             .write.mode("errorifexists").parquet(scored_out))
        metrics = res["metrics"]
        metrics = spark.createDataFrame(metrics.collect(), metrics.schema)  # a line per band
    if metrics_out:
        metrics.write.mode("errorifexists").parquet(metrics_out)
    return metrics


def main(argv=None) -> None:
    from panelkit.session import build_session
    ap = argparse.ArgumentParser(prog="panelkit.plans.jobs")
    ap.add_argument("job", choices=["etl", "indicators", "state", "regression"])
    ap.add_argument("paths", nargs="+")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    if args.job == "etl":
        print(etl_job(spark, args.paths[0], args.paths[1]))
    elif args.job == "indicators":
        indicators_job(spark, args.paths[0], args.paths[1] if len(args.paths) > 1 else None).show()
    elif args.job == "state":
        state_job(spark, *args.paths[:3]).show()
    else:
        regression_job(spark, *args.paths[:3]).show()


if __name__ == "__main__":
    main()
