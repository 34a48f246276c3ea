"""Plan shape: the properties the design relies on at scale."""

from pyspark.sql import functions as F

from panelkit.operators import dedup_by_key
from panelkit.plans import catalog
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_broadcasts_the_indicators_and_prunes_scans(spark):
    df = catalog.j05_model_table(spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_dedup_has_a_partial_aggregate_not_a_window(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = dedup_by_key(df, ["o_custkey"], ["o_orderdate"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_predicates_reach_the_parquet_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where(F.col("o_orderstatus") != "F") \
        .select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,F))]" in plan


def test_date_ranges_reach_the_scan_of_a_typed_column(spark, tmp_path):
    from panelkit.functions import date_between, date_from
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(F.to_date("o_orderdate").alias("d"), "o_orderkey")
    df.write.parquet(f"{tmp_path}/dated")
    for p in (date_from("d", "1996-01"), date_between("d", "1996-01", "1997-06")):
        plan = spark.read.parquet(f"{tmp_path}/dated").where(p)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(d,1996-01-01)" in plan.split("PushedFilters:")[1]


def test_history_takes_one_window_and_one_backfill(spark):
    df = catalog.c04_build_panel(spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1


def test_each_input_is_exchanged_once_on_its_key(spark):
    """History rows are laid out by key in their dedup; window and backfill reuse it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stages = catalog.stages(spark, SF_SMALL)
        stages.valid_main, stages.dictionary
        plan = stages.panel._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(PID#") == 2, plan


def test_indicator_tables_take_one_shuffle_of_the_rows(spark):
    plan = catalog.c05_yearly_indicators(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan  # by month, then the months by year


def test_submitted_partition_setting_survives(spark):
    from panelkit.session import _submitted, build_session
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert build_session().conf.get("spark.sql.shuffle.partitions") == "13"
        assert _submitted("spark.master")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_no_python_evaluation_in_the_main_plans(spark):
    for name in ("c04_build_panel", "c06_monthly_indicators", "j05_model_table", "a06_quality_report"):
        df = catalog.QUERIES[name](spark, SF_SMALL)
        df.collect()
        plan = plan_of(df)
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
