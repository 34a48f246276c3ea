"""Value models (M02-M05): a band classifier, then a linear regression per
band, all fitted by distributed Spark jobs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.predicates import all_not_null
from panelkit.functions.text import BAND_BOUNDS, band_index
from panelkit.operators.evaluate import two_stage_metrics
from panelkit.operators.keys import split_label
from panelkit.operators.moments import COEF_SCHEMA, RANK, fit_vector_regressions, predict_vector_regressions
from panelkit.session import delete_path, scratch_dir
from panelkit.stages import store_stage


def fit_band_classifier(df: DataFrame, features: str = "features", label: str = "band",
                        max_iter: int = 100, reg_param: float = 0.0):
    """Multinomial logistic regression with intercept. Labels are 0-based
    class indices (see :func:`panelkit.functions.band_index`).

    The model comes back as saved and read again, without its training summary:
    that of a two-band model holds the session, and a session that has observed
    metrics can't be shipped to tasks with the model."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=reg_param, fitIntercept=True)
    path = scratch_dir(df.sparkSession, "classifier")
    lr.fit(df).write().save(path)
    model = LogisticRegressionModel.load(path)
    delete_path(df.sparkSession, path)
    return model


def predict_band(model, df: DataFrame, out: str = "predicted_band") -> DataFrame:
    """Append the predicted class; every input column stays on the row."""
    p = model.getOrDefault("predictionCol")
    return model.transform(df).drop("rawPrediction", "probability").withColumnRenamed(p, out)


def _solver(d: int, ridge: float):
    def solve(batches):
        """Least squares of each moment row. Features are scaled to deviation
        1; a singular class gets the shortest solution in that scale."""
        for moments in batches:
            out = []
            for r in moments.itertuples(index=False):
                cov = np.zeros((d, d))
                cov[np.triu_indices(d)] = np.nan_to_num(np.array(r.cov, float))
                cov = cov + np.triu(cov, 1).T + ridge * np.eye(d)
                scale = np.sqrt(np.diag(cov))
                unit = np.divide(1.0, scale, out=np.zeros(d), where=scale > 0)
                beta = unit * np.linalg.lstsq(cov * np.outer(unit, unit), np.nan_to_num(np.array(r.cov_y, float)) * unit,
                                              rcond=RANK)[0] if d else np.zeros(0)
                out.append((r.cls, r.n, float(r.mean_y - beta @ np.array(r.mean, float)) if d else r.mean_y, beta.tolist()))
            yield pd.DataFrame(out, columns=["class", "n", "intercept", "coefficients"])
    return solve


def fit_per_class_regression(df: DataFrame, class_col: str, feature_cols, label: str, ridge: float = 0.0) -> DataFrame:
    """M04 on named columns, any number of classes: least squares per class
    from one grouped aggregation.

    Per class, Spark computes the means and the population covariances of
    every feature pair and of each feature with the label (numerically stable
    merge-based aggregates, partial on the map side, so one huge class costs
    no more than many small ones). The d(d+3)/2+2 numbers of a class are solved
    where they are, in Arrow batches of class rows. Meant for some dozens of
    columns; :func:`fit_vector_regressions` takes whole vectors. Result: one
    row per class, ``(class, n, intercept, coefficients)``."""
    feats = list(feature_cols)
    d = len(feats)
    x = [F.col(c).cast("double") for c in feats]
    y = F.col(label).cast("double")
    numbers = "array<double>"
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_y"),
            F.array(*[F.avg(v) for v in x]).cast(numbers).alias("mean"),
            F.array(*[F.covar_pop(x[i], x[j]) for i in range(d) for j in range(i, d)]).cast(numbers).alias("cov"),
            F.array(*[F.covar_pop(v, y) for v in x]).cast(numbers).alias("cov_y")]
    clean = df.where(all_not_null([class_col, label, *feats]))
    moments = clean.groupBy(F.col(class_col).cast("double").alias("cls")).agg(*aggs)
    return moments.mapInPandas(_solver(d, ridge), COEF_SCHEMA)


def predict_per_class(df: DataFrame, coefficients: DataFrame, class_col: str, feature_cols,
                      out: str = "predicted_value") -> DataFrame:
    """Score rows with the regression of their class (a plain join on the
    class; NULL where the class has none)."""
    c = coefficients.select(F.col("class").alias("_cls"), F.col("intercept").alias("_b0"),
                            F.col("coefficients").alias("_b"))
    joined = df.join(c, F.col(class_col).cast("double") == F.col("_cls"), "left")
    pred = F.col("_b0")
    for i, f in enumerate(feature_cols):
        pred = pred + F.element_at(F.col("_b"), i + 1) * F.col(f).cast("double")
    return joined.withColumn(out, pred).drop("_cls", "_b0", "_b")


@dataclass
class TwoStageResult:
    """``scored`` holds every test row with its bands, its part ('fit', 'score'
    or 'left_out') and, in part 'score', the predicted value."""
    classifier: object
    regressions: DataFrame
    predicted: DataFrame
    scored: DataFrame
    metrics: DataFrame

    @property
    def accuracy(self) -> DataFrame:
        return self.metrics.where("metric = 'accuracy'").select("n", F.col("value").alias("accuracy"))

    @property
    def rmse_by_class(self) -> DataFrame:
        return self.metrics.where("metric = 'rmse'").select("class", "n", "n_unscored", F.col("value").alias("rmse"))


def two_stage_model(train: DataFrame, test: DataFrame, value: str = "curVal", features: str = "features",
                    regression_features=None, bounds=BAND_BOUNDS, max_iter: int = 100, ridge: float = 0.0,
                    key=("PID", "year"), fractions=(0.7, 0.3), complete: str | None = None) -> TwoStageResult:
    """The band classifier (M02) is fitted on ``train`` and predicts the
    bands of ``test``. Those rows are written once, by predicted band, and
    split 70/30 inside each band (R02): one part fits the band's regression
    (M04), the other is scored. The regressions use the whole feature vector,
    or the named ``regression_features``. Test rows whose flag ``complete`` is
    false have no band and are counted as left out. All metrics come from one
    aggregation (:func:`panelkit.operators.evaluate.two_stage_metrics`)."""
    tr = train.withColumn("band", band_index(value, bounds))
    te = test.withColumn("band", band_index(value, bounds))
    clf = fit_band_classifier(tr.where(F.col("band").isNotNull()), features, "band", max_iter)
    whole = F.col(complete) if complete else F.lit(True)
    banded = predict_band(clf, te).withColumn("predicted_band", F.when(whole, F.col("predicted_band")))
    part = F.when(whole, split_label([F.col("predicted_band").cast("int"), *key], fractions, ("fit", "score"))).otherwise("left_out")
    path = scratch_dir(test.sparkSession, "predicted")
    banded.withColumn("part", part).write.partitionBy("predicted_band", "part").parquet(path)
    predicted = test.sparkSession.read.parquet(path).withColumn("predicted_band", F.col("predicted_band").cast("double"))
    fit_rows = predicted.where("part = 'fit'")
    if regression_features is None:
        regressions = store_stage(fit_vector_regressions(fit_rows, "predicted_band", features, value, ridge), "regressions")
        scored = predict_vector_regressions(regressions, predicted, "predicted_band", features)
    else:
        regressions = store_stage(fit_per_class_regression(fit_rows, "predicted_band", regression_features, value, ridge), "regressions")
        scored = predict_per_class(predicted, regressions, "predicted_band", regression_features)
    scored = scored.withColumn("predicted_value", F.when(F.col("part") == "score", F.col("predicted_value")))
    return TwoStageResult(clf, regressions, predicted, scored, two_stage_metrics(scored, value))
