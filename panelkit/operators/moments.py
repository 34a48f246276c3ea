"""Least squares on feature vectors, all classes in one pass.

The moments of a class are the sums of the products of a row's entries, its
label and a constant. They are sparse (only pairs that occur together), are
summed in the tasks batch by batch, merge by addition, and meet in one grouped
aggregation; a class is then solved from its own sums alone. What runs in the
tasks is pickled by value, so executors need no copy of this package."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Places of the constant and of the label among the entries of a row.
CONSTANT, LABEL = -2, -1
#: Products that a task forms at once.
PRODUCTS = 2_000_000
#: Entries solved as one dense system; beyond, entries that never meet are eliminated first.
DENSE = 1_500
#: Directions whose share of the scaled moments is smaller count as absent.
RANK = 1e-10

COEF_SCHEMA = "class double, n long, intercept double, coefficients array<double>"


def vector_entries(features: str) -> tuple[Column, Column]:
    """Positions and values of a feature vector, dense or sparse."""
    v = F.unwrap_udt(features)
    return F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)), v["values"]


def _products(batches):
    """Columns class, label, positions, values -> (class, i, j, total), i <= j."""
    for b in batches:
        cls, label = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        sizes = np.asarray(b.column(2).value_lengths())
        at = np.cumsum(sizes) - sizes
        places, values = (b.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
        for k in np.unique(sizes):
            rows = np.flatnonzero(sizes == k)
            first, second = np.triu_indices(k + 2)
            step = max(1, PRODUCTS // len(first))
            for s in range(0, len(rows), step):
                mine = rows[s:s + step]
                take = at[mine][:, None] + np.arange(k)
                entry = np.hstack([np.tile([CONSTANT, LABEL], (len(mine), 1)), places[take]]).astype(np.int64)
                value = np.hstack([np.ones((len(mine), 1)), label[mine, None], values[take]])
                base = int(entry.max()) + 3
                classes, of = np.unique(cls[mine], return_inverse=True)
                key = ((of[:, None] * base + entry[:, first] + 2) * base + entry[:, second] + 2).ravel()
                found, inverse = np.unique(key, return_inverse=True)
                total = np.bincount(inverse, (value[:, first] * value[:, second]).ravel())
                yield pa.RecordBatch.from_arrays([
                    pa.array(classes[found // (base * base)], pa.float64()), pa.array(found // base % base - 2, pa.int64()),
                    pa.array(found % base - 2, pa.int64()), pa.array(total, pa.float64())], names=["class", "i", "j", "total"])


def class_moments(df: DataFrame, class_col: str, features: str, label: str) -> DataFrame:
    """``class``, ``i``, ``j``, ``total``: the sums of products of the entries
    ``i <= j`` of each class's rows (-2 is the constant, -1 the label)."""
    places, values = vector_entries(features)
    rows = df.where(F.col(class_col).isNotNull() & F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        F.col(class_col).cast("double").alias("class"), F.col(label).cast("double").alias("label"),
        places.cast("array<long>").alias("places"), values.alias("values"))
    parts = rows.mapInArrow(_products, "class double, i long, j long, total double")
    return parts.groupBy("class", "i", "j").agg(F.sum("total").alias("total"))


def _apart(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """Entries no two of which occur together, those with fewest partners first."""
    partners = np.bincount(np.concatenate([i, j]), minlength=size)
    near: list[list[int]] = [[] for _ in range(size)]
    for a, b in zip(i.tolist(), j.tolist()):
        near[a].append(b)
        near[b].append(a)
    free, chosen = np.ones(size, bool), np.zeros(size, bool)
    free[0] = False  # the constant meets every entry
    for e in np.argsort(partners, kind="stable"):
        if free[e]:
            chosen[e] = True
            free[near[e]] = False
    return chosen


def solve_moments(i: np.ndarray, j: np.ndarray, total: np.ndarray, ridge: float = 0.0):
    """(n, intercept, coefficients) from the sums of one class. Columns are
    scaled to length 1; a singular system gives the shortest solution in that
    scale (of the part that is solved as a whole). ``ridge`` is per row and
    leaves the intercept alone."""
    n = float(total[(i == CONSTANT) & (j == CONSTANT)][0])
    width = int(max(j.max(), -1)) + 1
    right = np.zeros(width + 1)  # entry e at e + 1, the constant at 0
    at_label = (i == LABEL) & (j >= 0)
    right[j[at_label] + 1] = total[at_label]
    right[0] = total[(i == CONSTANT) & (j == LABEL)][0]
    inner = (j >= 0) & ((i >= 0) | (i == CONSTANT))
    a, b, t = np.where(i[inner] < 0, 0, i[inner] + 1), j[inner] + 1, total[inner]
    own = np.zeros(width + 1)
    own[b[a == b]] = t[a == b] + ridge * n
    own[0] = n
    used = np.flatnonzero(own > 0)
    place = np.full(width + 1, -1)
    place[used] = np.arange(len(used))
    length = np.sqrt(own[used])
    cross = (a != b) & (place[a] >= 0) & (place[b] >= 0)
    a, b, t = place[a[cross]], place[b[cross]], t[cross]
    t = t / (length[a] * length[b])
    a, b, t = a[t != 0], b[t != 0], t[t != 0]
    y = right[used] / length
    alone = _apart(a, b, len(used)) if len(used) > DENSE else np.zeros(len(used), bool)
    kept, gone = np.flatnonzero(~alone), np.flatnonzero(alone)
    row = np.zeros(len(used), np.int64)
    row[kept], row[gone] = np.arange(len(kept)), np.arange(len(gone))
    matrix = np.eye(len(kept))
    both = ~alone[a] & ~alone[b]
    matrix[row[a[both]], row[b[both]]] = t[both]
    matrix[row[b[both]], row[a[both]]] = t[both]
    one = alone[a] != alone[b]
    out, stay = np.where(alone[a[one]], a[one], b[one]), np.where(alone[a[one]], b[one], a[one])
    meeting = np.zeros((len(gone), len(kept)))
    meeting[row[out], row[stay]] = t[one]
    beta = np.zeros(len(used))
    if len(kept):
        beta[kept] = np.linalg.lstsq(matrix - meeting.T @ meeting, y[kept] - meeting.T @ y[gone], rcond=RANK)[0]
    beta[gone] = y[gone] - meeting @ beta[kept]
    full = np.zeros(width + 1)
    full[used] = beta / length
    return int(round(n)), float(full[0]), full[1:]


def fit_vector_regressions(df: DataFrame, class_col: str, features: str, label: str, ridge: float = 0.0) -> DataFrame:
    """M04 on a feature vector, any number of classes: ``class``, ``n``,
    ``intercept`` and ``coefficients`` of a least-squares fit per class, from one
    aggregation of sparse moments (:func:`class_moments`) and one small solve per
    class where its sums are. Rows without class, label or vector don't count;
    a class of one row gets its value. A class's sums are bounded by the pairs
    of features, not by its rows."""
    def solve(key, sums):
        n, intercept, beta = solve_moments(sums["i"].to_numpy(), sums["j"].to_numpy(), sums["total"].to_numpy(), ridge)
        return pd.DataFrame([(key[0], n, intercept, beta.tolist())], columns=["class", "n", "intercept", "coefficients"])
    return class_moments(df, class_col, features, label).groupBy("class").applyInPandas(solve, COEF_SCHEMA)


def predict_vector_regressions(coefficients: DataFrame, df: DataFrame, class_col: str, features: str = "features",
                               out: str = "predicted_value") -> DataFrame:
    """Each row scored by the regression of its class (a plain join on the
    class); NULL where there is none. Entries beyond a fit's last count nothing."""
    places, values = vector_entries(features)
    c = coefficients.select(F.col("class").alias("_cls"), F.col("intercept").alias("_b0"), F.col("coefficients").alias("_b"))
    joined = df.join(c, F.col(class_col).cast("double") == F.col("_cls"), "left")
    terms = F.zip_with(places, values, lambda i, v: F.coalesce(F.get(F.col("_b"), i.cast("int")), F.lit(0.0)) * v)
    score = F.col("_b0") + F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return joined.withColumn(out, score).drop("_cls", "_b0", "_b")


def score_equations(df: DataFrame, group: Column, residual: Column, features: str) -> DataFrame:
    """How far a fit is from solving its score equations: per ``group`` the
    rows ``n`` and the largest, over the constant and every feature, of
    ``|mean(residual * x)| / root mean square of x``. At the optimum of a
    linear or logistic model with an intercept all of them are 0."""
    places, values = vector_entries(features)
    entries = F.concat(F.array(F.struct(F.lit(-1).alias("place"), F.lit(1.0).alias("x"))),
                       F.zip_with(places, values, lambda i, v: F.struct(i.cast("int").alias("place"), v.alias("x"))))
    rows = df.select(group.alias("group"), residual.alias("_r"), F.explode(entries).alias("_e"))
    sums = rows.groupBy("group", "_e.place").agg(F.sum(F.col("_r") * F.col("_e.x")).alias("_s"), F.sum(F.col("_e.x") * F.col("_e.x")).alias("_q"),
                                                 F.count_if(F.col("_e.place") == -1).alias("_n"))
    per = sums.groupBy("group").agg(F.max("_n").alias("n"), F.collect_list(F.struct("_s", "_q")).alias("_all"))
    size = F.sqrt(F.col("n").cast("double"))
    worst = F.array_max(F.transform("_all", lambda e: F.when(e["_q"] > 0, F.abs(e["_s"]) / (F.sqrt(e["_q"]) * size)).otherwise(F.lit(0.0))))
    return per.select("group", "n", worst.alias("score"))
