"""Data quality and summary statistics (A06-A08, W06), each one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.predicates import all_not_null

STATISTICS = ("count", "mean", "stddev", "min", "max")


def quality_report(df: DataFrame, cols=None, by: str | None = None) -> DataFrame:
    """One row (or one for each value of ``by``), ``rows`` plus
    ``empty_<c>`` = rows where ``c`` is NULL or blank text, for all columns in a
    single aggregation (not a job per column)."""
    cols = list(cols or [c for c in df.columns if c != by])
    return (df.groupBy(by) if by else df.groupBy()).agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        *[F.count_if(_empty(c)).cast("long").alias(f"empty_{c}") for c in cols])


def _empty(c: str):
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


class QualityWatch:
    """A06 without a pass of its own: the counts of :func:`quality_report` per
    step are taken while the frame is written for another purpose.

    ``watch`` puts the counts on the frame; ``counts`` gives them once it has
    been written. A task that Spark repeats after losing an executor may be
    counted twice where its rows feed a shuffle, so ``keys`` (a column and its
    expected values) are counted as well, for :meth:`agrees` to compare with
    what was written."""

    def __init__(self, cols, steps, key: str, values):
        self.cols, self.steps, self.key, self.values = list(cols), list(steps), key, list(values)
        self._seen = Observation()

    def watch(self, df: DataFrame, step) -> DataFrame:
        exprs = [F.count_if(F.col(self.key) == F.lit(v)).alias(f"key{i}") for i, v in enumerate(self.values)]
        for i, s in enumerate(self.steps):
            mine = F.coalesce(step == F.lit(s), F.lit(False))
            exprs.append(F.count_if(mine).alias(f"rows{i}"))
            exprs += [F.count_if(mine & _empty(c)).alias(f"empty{i}_{j}") for j, c in enumerate(self.cols)]
        return df.observe(self._seen, *exprs)

    def agrees(self, written: dict) -> bool:
        """Whether the watched rows of every key that was written are as many as those written."""
        seen = self._seen.get
        return all(seen[f"key{self.values.index(v)}"] == n for v, n in written.items())

    def report(self, spark: SparkSession) -> DataFrame:
        """The rows of ``quality_report(df, cols, by='step')``, for the steps that had rows."""
        seen = self._seen.get
        rows = [(s, seen[f"rows{i}"], *[seen[f"empty{i}_{j}"] for j in range(len(self.cols))])
                for i, s in enumerate(self.steps) if seen[f"rows{i}"]]
        return spark.createDataFrame(rows, "step string, rows long, " + ", ".join(f"empty_{c} long" for c in self.cols))


def complete_cases(df: DataFrame, cols) -> DataFrame:
    """Rows where every listed column is non-NULL."""
    return df.where(all_not_null(cols))


def describe_numeric(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample stddev, min, max of each column as doubles,
    one row per statistic, from a single aggregation."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).try_cast("double")
        aggs += [F.count(v).cast("double").alias(f"s{i}_count"), F.avg(v).alias(f"s{i}_mean"),
                 F.stddev_samp(v).alias(f"s{i}_stddev"), F.min(v).alias(f"s{i}_min"),
                 F.max(v).alias(f"s{i}_max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(s).alias("statistic"),
                     *[F.col(f"s{i}_{s}").alias(c) for i, c in enumerate(cols)]) for s in STATISTICS]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def correlate_with(df: DataFrame, target: str, cols) -> DataFrame:
    """Pearson correlation of ``target`` with each column, one pass; a
    zero-variance column gives NULL. Rows ``(column, correlation)``."""
    cols = list(cols)
    t = F.col(target).try_cast("double")
    aggs = [F.try_divide(F.covar_samp(t, F.col(c).try_cast("double")),
                         F.stddev_samp(t) * F.stddev_samp(F.col(c).try_cast("double"))).alias(f"c{i}")
            for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("correlation")) for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def correlation_list(df: DataFrame, target: str, cols) -> list:
    """The old list form (one value per column, NULL as None): a fitted
    parameter vector, collected once."""
    got = {r["column"]: r["correlation"] for r in correlate_with(df, target, cols).collect()}
    return [got[c] for c in cols]
