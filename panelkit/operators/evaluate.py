"""Evaluation (E01-E03), each a single aggregation, and all of them as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label (``n`` rows)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"),
                  F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n"),
                  F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"))


def rmse_by_class(df: DataFrame, class_col: str = "class", label: str = "label",
                  prediction: str = "prediction") -> DataFrame:
    """One row per class: ``class``, ``n`` rows, ``n_unscored`` of them
    without a prediction (no regression for their class), ``rmse`` of the others."""
    return df.groupBy(F.col(class_col).alias("class")).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.count_if(F.col(prediction).isNull()).cast("long").alias("n_unscored"),
        F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"))


def two_stage_metrics(scored: DataFrame, label: str = "curVal", prediction: str = "predicted_value", band: str = "band",
                      predicted_band: str = "predicted_band", part: str = "part") -> DataFrame:
    """E01, E03 and the rows left out, from one aggregation over the grouping
    sets (predicted band) and (all rows): ``metric``, ``class``, ``n``,
    ``n_unscored``, ``value``. Accuracy is over all rows that have a predicted
    band, RMSE per band over those of part 'score', 'left_out' counts the others."""
    whole, ours = F.col(part) != "left_out", F.col(part) == "score"
    rows = scored.select(F.col(predicted_band).alias("class"), whole.alias("whole"), ours.alias("ours"), F.col(prediction).isNull().alias("bare"),
                         F.when(whole, (F.col(band) == F.col(predicted_band)).cast("double")).alias("hit"),
                         F.when(ours, F.pow(F.col(label) - F.col(prediction), 2)).alias("error"))
    sums = rows.rollup("class").agg(
        F.grouping("class").alias("overall"), F.count_if("whole").alias("rows"), F.count_if(~F.col("whole")).alias("left"),
        F.count_if("ours").alias("n"), F.count_if(F.col("ours") & F.col("bare")).alias("unscored"),
        F.avg("hit").alias("right"), F.sqrt(F.avg("error")).alias("rmse"))

    def line(metric, cls, n, unscored, value):
        return F.struct(F.lit(metric).alias("metric"), cls.cast("double").alias("class"), n.cast("long").alias("n"),
                        unscored.cast("long").alias("n_unscored"), value.cast("double").alias("value"))
    none = F.lit(None)
    lines = F.when(F.col("overall") == 1, F.array(line("accuracy", none, F.col("rows"), none, F.col("right")),
                                                  line("left_out", none, F.col("left"), none, none))) \
        .when(F.col("n") > 0, F.array(line("rmse", F.col("class"), F.col("n"), F.col("unscored"), F.col("rmse"))))
    return sums.select(F.explode(lines).alias("m")).select("m.*")
