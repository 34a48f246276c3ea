"""Regressions on vectors from packed moments, against numpy; score equations."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators import fit_vector_regressions, moments, predict_vector_regressions, score_equations

SCHEMA = T.StructType([T.StructField("band", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("features", VectorUDT())])


def rows_of(seed: int, n: int, categories: int):
    """Two one-hot blocks (collinear with the constant) and three numbers, one of them constant in band 2."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        band = float(i % 3)
        a, b = int(rng.integers(categories)), int(rng.integers(4))
        x, z = float(rng.normal()), float(rng.normal() * 100)
        v = {a: 1.0, categories + b: 1.0, categories + 4: x, categories + 5: z, categories + 6: 5.0 if band == 2 else x + z}
        out.append((band, 3 * x - z + 10 * a + b + float(rng.normal()) + band, v))
    out += [(3.0, 42.0, {0: 1.0, categories + 4: 2.0}), (4.0, 1.0, {1: 1.0}), (4.0, 3.0, {1: 1.0}), (None, 1.0, {0: 1.0}), (0.0, None, {0: 1.0})]
    return out


def frame(spark, rows, width, dense_every=3):
    def vector(i, v):
        sparse = Vectors.sparse(width, v)
        return Vectors.dense(sparse.toArray()) if i % dense_every == 0 else sparse
    return spark.createDataFrame([(b, y, vector(i, v)) for i, (b, y, v) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("dense", [moments.DENSE, 0])
def test_all_bands_equal_numpy_singular_ones_too(spark, dense, monkeypatch):
    categories = 9
    width = categories + 7
    rows = rows_of(1, 600, categories)
    df = frame(spark, rows, width)
    found = []
    sums = moments.class_moments(df, "band", "features", "y").toPandas()
    monkeypatch.setattr(moments, "DENSE", dense)
    for band, part in sums.groupby("class"):
        n, intercept, beta = moments.solve_moments(part["i"].to_numpy(), part["j"].to_numpy(), part["total"].to_numpy())
        mine = [(y, v) for b, y, v in rows if b == band and y is not None]
        x = np.array([[1.0] + [v.get(k, 0.0) for k in range(width)] for _, v in mine])
        y = np.array([y for y, _ in mine])
        want = x @ np.linalg.lstsq(x, y, rcond=None)[0]
        got = intercept + x[:, 1:len(beta) + 1] @ beta
        assert n == len(mine) and np.allclose(got, want, rtol=1e-6, atol=1e-5), band
        found.append(band)
    assert found == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_one_aggregation_fits_and_a_join_scores(spark):
    df = frame(spark, rows_of(2, 300, 6), 13)
    fitted = fit_vector_regressions(df, "band", "features", "y")
    plan = fitted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    scored = predict_vector_regressions(fitted, df, "band", out="p")
    rest = {(r.band, r.n): r.missing for r in scored.groupBy("band").agg(F.count("*").alias("n"), F.count_if(F.col("p").isNull()).alias("missing")).collect()}
    assert rest[None, 1] == 1 and sum(rest.values()) == 1
    checked = score_equations(scored.where("y IS NOT NULL AND band IS NOT NULL"), F.col("band"), F.col("y") - F.col("p"), "features").collect()
    assert len(checked) == 5 and max(r.score for r in checked) < 1e-6
    off = score_equations(scored.where("band = 0 AND y IS NOT NULL"), F.col("band"), F.col("y") - F.col("p") + 0.5, "features").first()
    assert off.score > 0.4  # a fit that is not optimal shows


def test_thousands_of_categories_take_no_dense_system(spark):
    """Categories never meet each other: all but a few entries are eliminated first."""
    rng = np.random.default_rng(3)
    categories, rows = 4000, []
    for i in range(12_000):
        x = float(rng.normal())
        rows.append((0.0, 2.0 * x + i % categories, {i % categories: 1.0, categories + i % 3: 1.0, categories + 3: x}))
    df = frame(spark, rows, categories + 4, dense_every=10**9)
    got = predict_vector_regressions(fit_vector_regressions(df, "band", "features", "y"), df, "band", out="p")
    assert got.agg(F.max(F.abs(F.col("y") - F.col("p")))).first()[0] < 1e-5
