"""Stage tables and their ledger: what is on disk at each point of a job."""

import os

import pytest
from pyspark.sql import functions as F

from panelkit.operators import number_rows
from panelkit.plans import catalog
from panelkit.plans import standins as S
from panelkit.plans.register import register_panel
from panelkit.session import scratch_scope
from panelkit.stages import StageLedger, releasing, store_stage, wrote
from tests.conftest import SF_SMALL


def folders(parent: str) -> list[str]:
    return sorted(os.listdir(parent)) if os.path.isdir(parent) else []


def test_a_table_goes_with_its_last_reader(spark, tmp_path):
    with scratch_scope(spark) as parent, StageLedger(spark).recording() as ledger:
        a = store_stage(spark.range(10).toDF("x"), "a", readers=2)
        first = a.where("x > 3")
        first.write.parquet(f"{tmp_path}/one")
        wrote(first)
        assert len(folders(parent)) == 1
        b = store_stage(a.groupBy().count(), "b")  # the second reader: a goes
        assert [f.split("-")[1] for f in folders(parent)] == ["b"] and b.first()[0] == 10
        ledger.release(b)
        assert ledger.tables and folders(parent)
        ledger.close()
        assert not ledger.tables and not folders(parent)


def test_release_keeps_what_a_live_plan_scans(spark):
    with scratch_scope(spark) as parent, StageLedger(spark).recording() as ledger:
        a, b, c = (store_stage(spark.range(5).toDF(n), n) for n in "xyz")
        live = a.crossJoin(c.limit(1)).groupBy("z").agg(F.sum("x").alias("s"))
        ledger.release(live)
        assert [f.split("-")[1] for f in folders(parent)] == ["x", "z"]
        assert live.collect() and ledger.read_by(b) == set()


def test_inner_steps_pass_on_what_they_return(spark):
    with scratch_scope(spark) as parent, StageLedger(spark).recording() as ledger:
        with releasing(spark) as step:
            draft = store_stage(spark.range(5).toDF("x"), "draft")
            out = step.keep(store_stage(draft.where("x > 1"), "final"))
        assert [f.split("-")[1] for f in folders(parent)] == ["final"] and len(ledger.tables) == 1
        assert out.count() == 3


def test_numbered_rows_are_a_finished_table(spark):
    with scratch_scope(spark) as parent:
        df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
        out, n = number_rows(df, [F.col("k").desc()], "nth", with_count=True)
        assert len(folders(parent)) == 1 and n == 1000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Sort" not in plan and "Join" not in plan
        assert all(r.nth == 999 - r.k for r in out.collect())
        assert number_rows(df.limit(0), [F.col("k")]).count() == 0


def test_the_panel_holds_two_stages_at_most(spark, tmp_path):
    register = S.register_rows(spark, SF_SMALL)
    register.write.parquet(f"{tmp_path}/register")
    register = spark.read.parquet(f"{tmp_path}/register")
    with scratch_scope(spark) as parent, StageLedger(spark).recording():
        stages = register_panel(register, S.history_rows(register), S.MAIN_YEARS, S.BASE_YEAR, S.HISTORY_YEARS, S.REFERENCE_YEAR,
                                catalog.opts(), panel_only=True)
        stages.valid_main
        assert [f.split("-")[1] for f in folders(parent)] == ["stage"]
        stages.dictionary
        assert [f.split("-")[1] for f in folders(parent)] == ["numbered", "stage"]
        panel = stages.panel
        panel.write.parquet(f"{tmp_path}/panel")
        wrote(panel)
        assert [f.split("-")[1] for f in folders(parent)] == ["numbered"]
    assert not os.path.exists(parent)
    assert spark.read.parquet(f"{tmp_path}/panel").count() == catalog.c04_build_panel(spark, SF_SMALL).count()


def test_quality_is_counted_while_the_panel_is_written(spark, tmp_path):
    from panelkit.operators import QualityWatch
    stages = catalog.stages(spark, SF_SMALL)
    panel, years = stages.panel, [*S.MAIN_YEARS, S.BASE_YEAR, *S.HISTORY_YEARS]
    watch = QualityWatch(panel.columns, ("main", "base", "history"), "year", years)
    watch.watch(panel, stages.step).write.parquet(f"{tmp_path}/panel")
    written = {r["year"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/panel").groupBy("year").count().collect()}
    assert watch.agrees(written) and not watch.agrees({**written, S.BASE_YEAR: 0})
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(watch.report(spark)) == rows(stages.quality)


@pytest.mark.parametrize("wrong", ["short", "long", "quote"])
def test_lines_that_do_not_fit_are_counted(spark, tmp_path, wrong):
    from panelkit.sources import census_csv, text_schema
    bad = {"short": "1,2", "long": "1,2,3,4", "quote": '1,"2,3'}[wrong]
    (tmp_path / "a.csv").write_text("x,y,z\n1,2,3\n,,\n" + bad + "\n\"4\",\"5,5\",6\n")
    (tmp_path / "b.csv").write_text("x,y,z\n1,2,3\n")
    for schema in (text_schema(["x", "y", "z"]), None):
        got = {r.file.rsplit("/", 1)[1]: (r.lines, r.bad_lines) for r in census_csv(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"], schema).collect()}
        assert got == {"a.csv": (4, 1), "b.csv": (1, 0)}


def test_whitespace_lines_that_do_not_fit_are_counted(spark, tmp_path):
    from panelkit.sources import census_whitespace
    (tmp_path / "oil.txt").write_text("2006-01-01   60\n2006-01-02\n\n2006-01-03 61 62\n  2006-01-04\t63  \n")
    assert [(r.lines, r.bad_lines) for r in census_whitespace(spark, f"{tmp_path}/oil.txt").collect()] == [(5, 3)]
