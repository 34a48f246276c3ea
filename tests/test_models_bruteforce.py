"""Queries without an SQL oracle, checked against brute force (numpy) on
the smallest tables."""

import numpy as np
from pyspark.sql import Observation
from pyspark.sql import functions as F

from panelkit.functions.text import band_index
from panelkit.operators import (
    assemble_features, fit_per_class_regression, fit_vector_regressions, pca_project, predict_vector_regressions,
)
from panelkit.plans import standins as S
from panelkit.plans.model import train_value_model
from tests.conftest import SF_SMALL


def test_pca_explained_variance_matches_numpy(spark):
    emb = S.table(spark, SF_SMALL, "embeddings", "vec_id", "embedding")
    model, out = pca_project(emb, "embedding", 3, "pca")
    x = np.array([r.embedding for r in emb.orderBy("vec_id").collect()], dtype=float)
    eig = np.sort(np.linalg.eigvalsh(np.cov(x, rowvar=False)))[::-1]
    want = eig[:3] / eig.sum()
    assert np.allclose(model.explainedVariance.toArray(), want, rtol=1e-6, atol=1e-9)
    assert out.count() == emb.count()


def test_pca_components_are_uncorrelated(spark):
    from pyspark.ml.functions import vector_to_array
    emb = S.table(spark, SF_SMALL, "embeddings", "vec_id", "embedding")
    _, out = pca_project(emb, "embedding", 64, "pca")
    x = np.array([r.p for r in out.select(vector_to_array("pca").alias("p")).collect()])
    cov = np.cov(x, rowvar=False)
    assert np.abs(cov - np.diag(np.diag(cov))).max() < 1e-9


def test_vector_regressions_match_lstsq(spark):
    """One-hot digits and numbers, by band, against numpy on the same rows."""
    rng = np.random.default_rng(0)
    rows = [(float(i % 2), "".join("1" if k == i % 5 else "0" for k in range(5)), float(rng.normal()), float(rng.normal())) for i in range(300)]
    rows = [(b, c, x, z, 3.0 * x - z + 10 * c.index("1") + b) for b, c, x, z in rows]
    df = spark.createDataFrame(rows, "band double, code string, x double, z double, y double")
    df = assemble_features(df, ("code",), ("x", "z"), widths={"code": 5})
    models = fit_vector_regressions(df, "band", "features", "y")
    assert {r["class"] for r in models.collect()} == {0.0, 1.0}
    got = predict_vector_regressions(models, df, "band", out="p").select("y", "p").collect()
    assert len(got) == 300 and max(abs(r.y - r.p) for r in got) < 1e-5


def test_feature_vectors_are_sparse_and_cost_in_proportion(spark):
    from pyspark.ml.linalg import SparseVector
    df = spark.createDataFrame([("0" * 4000 + "1" + "0" * 95, 2.0), ("1" + "0" * 4095, 0.5)], "code string, x double")
    got = [r.features for r in assemble_features(df, ("code",), ("x",), widths={"code": 4096}).collect()]
    assert all(isinstance(v, SparseVector) and v.size == 4097 and v.numNonzeros() == 2 for v in got)
    digits = assemble_features(df, ("code",), ("x",)).collect()
    assert [v.toArray().tolist() for v in got] == [r.features for r in digits]


def test_training_survives_unmapped_codes(spark):
    """One row in ten has a zone or legal value that no dictionary maps."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        zone = "DD" if i % 10 == 3 else "".join("1" if k == i % 4 else "0" for k in range(4))
        legal = "MYSTERY" if i % 10 == 7 else ("100", "010", "001")[i % 3]
        value = (150_000.0, 450_000.0)[i % 2] + float(rng.normal()) * 1000
        rows.append((str(i), value, value / 2, 2010.0 + i % 5, value * 0.9, value * 0.4, 50.0 + i % 7, 3.0 + i % 2, 1.1 + i % 3, zone, legal, "10"))
    df = spark.createDataFrame(rows, "PID string, curVal double, curImpVal double, year double, preVal double, preImpVal double, "
                                     "oilprice double, interestrates double, conversionrate double, zoneCat string, legalType string, FSA string")
    df.observe(Observation(), F.count("*").alias("n")).count()  # a session that has observed still ships its models
    train, test = df.where("cast(PID AS int) % 2 = 0 OR cast(PID AS int) % 7 = 0"), df.where("cast(PID AS int) % 2 = 1")
    res = train_value_model(train, test, max_iter=20)
    assert res["params"].code_widths == {"zoneCat": 4, "legalType": 3, "FSA": 2}
    m = {r.metric: r for r in res["metrics"].collect()}
    bad = test.where("zoneCat = 'DD' OR legalType = 'MYSTERY'").count()
    assert m["left_out"].n == bad > 0 and m["accuracy"].n == test.count() - bad


def test_multi_feature_per_class_regression_matches_lstsq(spark):
    panel = S.customer_year_panel(spark, SF_SMALL).withColumn("cls", band_index("curVal"))
    lagged = panel.select("PID", (F.col("year") + 1).alias("year"), F.col("curVal").alias("prev"))
    df = panel.join(lagged, ["PID", "year"]).select("cls", "curImpVal", "prev", F.col("year").cast("double")
                                                    .alias("yr"), "curVal").where(F.col("curImpVal").isNotNull())
    feats = ["curImpVal", "prev", "yr"]
    got = {r["class"]: r for r in fit_per_class_regression(df, "cls", feats, "curVal").collect()}
    rows = df.collect()
    for cls in {r.cls for r in rows}:
        sub = [r for r in rows if r.cls == cls]
        if len(sub) <= len(feats) + 1:
            continue
        a = np.array([[1.0] + [r[f] for f in feats] for r in sub])
        y = np.array([r.curVal for r in sub])
        beta = np.linalg.lstsq(a, y, rcond=None)[0]
        pred_np = a @ beta
        g = got[cls]
        pred_sp = g.intercept + a[:, 1:] @ np.array(g.coefficients)
        assert np.allclose(pred_sp, pred_np, rtol=1e-6, atol=1e-3)
