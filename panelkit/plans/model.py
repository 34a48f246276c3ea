"""Model table, split and sink (C07); training and evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.text import band_index
from panelkit.operators.features import (
    CODE_BLOCKS, FEATURE_NUMERIC, MODEL_NUMERIC, apply_feature_pipeline, cast_numeric, fit_feature_pipeline,
    pca_project, weight_by_correlation,
)
from panelkit.operators.indicators import model_table
from panelkit.operators.keys import split_label
from panelkit.operators.models import two_stage_model
from panelkit.operators.moments import predict_vector_regressions, score_equations
from panelkit.operators.quality import complete_cases, correlation_list
from panelkit.stages import store_stage, wrote

SPLIT_NAMES = ("training", "testing")


def labelled_model_table(panel: DataFrame, indicators: DataFrame, fractions=(0.6, 0.4),
                         key=("PID", "year")) -> DataFrame:
    """J05 + R01: the model table (key kept) with its ``split`` label."""
    return model_table(panel, indicators).withColumn("split", split_label(list(key), fractions, SPLIT_NAMES))


def write_model_sets(panel: DataFrame, indicators: DataFrame, out_dir: str, fractions=(0.6, 0.4),
                     key=("PID", "year"), mode: str = "errorifexists") -> dict:
    """Join, split and write both sets in ONE pass, partitioned by
    ``split`` (a reader of one set prunes the other). Returns the paths."""
    labelled = labelled_model_table(panel, indicators, fractions, key)
    labelled.write.mode(mode).partitionBy("split").parquet(out_dir)
    wrote(labelled)
    return {name: f"{out_dir}/split={name}" for name in SPLIT_NAMES}


def read_model_set(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(out_dir).where(F.col("split") == F.lit(name)).drop("split")


def prepare_training(df: DataFrame, code_cols=CODE_BLOCKS) -> DataFrame:
    """P06 + W06: value columns to double, complete cases only; ``keyYear``
    keeps the year of the row's key, whatever scaling does to ``year``."""
    typed = cast_numeric(df, MODEL_NUMERIC, keep=("PID", *code_cols))
    return complete_cases(typed, [*MODEL_NUMERIC, *code_cols]).withColumn("keyYear", F.col("year").cast("int"))


def train_value_model(train: DataFrame, test: DataFrame, max_iter: int = 100, code_cols=CODE_BLOCKS,
                      numeric_cols=FEATURE_NUMERIC, regression_features=None, pca_components: int | None = None) -> dict:
    """P06 W06 A08 F07 F10 T14 (F08) M05 E01 E03.

    Correlations with ``curVal`` are fitted on the training rows and used as
    column weights on both sets (a NULL correlation - a constant column -
    weighs 0); scaler, code widths and the optional PCA before the classifier
    are fitted on the training rows only. Returns the fitted pieces and a
    ``metrics`` DataFrame (metric, class, n, n_unscored, value): accuracy over
    the test rows, RMSE by predicted band over the scored part, and the test
    rows left out because a feature is missing or not mapped."""
    tr = prepare_training(train, code_cols)
    te = prepare_training(test, code_cols)
    corr = correlation_list(tr, "curVal", MODEL_NUMERIC)
    weights = [1.0 if c == "curVal" else (w if w is not None else 0.0) for c, w in zip(MODEL_NUMERIC, corr)]
    tr = weight_by_correlation(tr, MODEL_NUMERIC, weights)
    te = weight_by_correlation(te, MODEL_NUMERIC, weights)
    params = fit_feature_pipeline(tr, code_cols=code_cols, numeric_cols=numeric_cols)
    tr_f = apply_feature_pipeline(tr, params)
    te_f = apply_feature_pipeline(te, params, flag="complete")
    pca = None
    if pca_components:
        pca, tr_f = pca_project(tr_f, "features", pca_components, "_projected")
        te_f = pca.transform(te_f)
        tr_f, te_f = (d.drop("features").withColumnRenamed("_projected", "features") for d in (tr_f, te_f))
    tr_f = store_stage(tr_f, "training-rows")  # the fit's iterations scan vectors, not the steps to them
    result = two_stage_model(tr_f, te_f, "curVal", "features", regression_features, max_iter=max_iter,
                             key=("PID", "keyYear"), complete="complete")
    return {"correlations": dict(zip(MODEL_NUMERIC, corr)), "params": params, "pca": pca, "training": tr_f, "result": result,
            "metrics": result.metrics}


def certificate(res: dict) -> DataFrame:
    """Evidence that the fits of :func:`train_value_model` are optimal: their
    score equations (:func:`score_equations`) on the rows they were fitted to.

    One line per band of the classifier (``equation`` 'classifier', ``class``,
    the training rows ``n`` and how far the sums of (probability - [band = k]) x
    are from 0), and one line for the regressions ('regression', the rows that
    they and the scored part have, the largest of the bands). The sums are 0 at
    the optimum whatever the data, so no second fit is needed to check one."""
    result, training = res["result"], res["training"]
    p = vector_to_array("probability")
    tr = result.classifier.transform(training.withColumn("band", band_index("curVal")).where("band IS NOT NULL"))
    per_class = tr.select("band", "features", F.posexplode(p).alias("_k", "_p"))
    residual = F.col("_p") - (F.col("band") == F.col("_k")).cast("double")
    first = score_equations(per_class, F.col("_k").cast("double"), residual, "features")
    fitted = predict_vector_regressions(result.regressions, result.predicted.where("part = 'fit'"), "predicted_band")
    second = score_equations(fitted, F.col("predicted_band"), F.col("curVal") - F.col("predicted_value"), "features")
    of_rows = result.predicted.where("part <> 'left_out'").agg(F.count("*").alias("n"), F.stddev_pop("curVal").alias("sd"))
    parts = of_rows.withColumn("score", F.lit(None).cast("double")).unionByName(
        second.agg(F.max("score").alias("score")).select(F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("sd"), "score"))
    regression = parts.agg(F.max("n").alias("n"), F.coalesce(F.try_divide(F.max("score"), F.max("sd")), F.lit(0.0)).alias("score"))
    return first.select(F.lit("classifier").alias("equation"), F.col("group").alias("class"), "n", "score").unionByName(
        regression.select(F.lit("regression").alias("equation"), F.lit(None).cast("double").alias("class"), "n", "score"))
