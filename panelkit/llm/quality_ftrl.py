"""Quality classifier: hashed word n-grams, logistic regression, FTRL.

A text is cut into words and single punctuation marks. Its features are the
hashed single tokens and pairs of neighbours, and the same over token shapes
(lower, Title, CAPS, digits, mark, repeat of the token before), each with its
share of the text's features as value: the score is a sparse dot product put
through the logistic function. Weights are trained by follow the regularised
leader (per-coordinate rates, L1 and L2), and a fixed number of shards of the
training rows are trained side by side, each in its own task, and averaged.

Training reads a bounded sample of labelled rows (``max_rows``, a parameter):
those first in the order of a hash of the id. Scoring reads every whole text.
The weights are one array of ``2 ** BITS`` numbers.

Null and empty texts have no features and get the score of the bias alone.
Labels that are null, or that have a null id, are not learned from; texts
with several labels are learned from once for each. With no labels at all, or
of one class only, the score still exists (0.5 without any row). Repeated
rows, extra columns and empty tables need no care.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 18
SIZE = 1 << BITS
TOKEN = re.compile(r"\w+|[^\w\s]")
KNOWN = 400_000
#: Feature values are shares of the text times this.
SCALE = 32.0
LOWER, TITLE, CAPS, DIGITS, MARK, REPEAT = range(6)


def shape_of(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return MARK
    if token.isdigit():
        return DIGITS
    if len(token) > 1 and token.isupper():
        return CAPS
    return TITLE if token[0].isupper() else LOWER


class _Tokens(dict):
    """Hash and shape of each token, packed in one number."""

    def __missing__(self, token):
        if len(self) >= KNOWN:
            self.clear()
        self[token] = out = (zlib.crc32(token.lower().encode(errors="replace")) << 3) | shape_of(token)
        return out


def features(text: str | None, tokens: _Tokens) -> np.ndarray:
    """Buckets of all n-grams of a text, repeated as often as they occur."""
    packed = np.array(list(map(tokens.__getitem__, TOKEN.findall(text or ""))), np.uint64)
    if not len(packed):
        return np.zeros(0, np.int64)
    word, shape = packed >> np.uint64(3), packed & np.uint64(7)
    shape[1:][word[1:] == word[:-1]] = REPEAT
    def spread(x, salt):
        x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate([
        spread(word, 1), spread((word[:-1] << np.uint64(20)) ^ word[1:], 2),
        spread(shape, 3), spread(shape[:-1] * np.uint64(8) + shape[1:], 4)])


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def train(rows: list[tuple[np.ndarray, int]], epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL-proximal over sparse rows; the last weight is the bias."""
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    compact = []
    for buckets, label in rows:
        at, count = np.unique(buckets, return_counts=True)
        compact.append((np.append(at, SIZE), np.append(count * (SCALE / max(1, len(buckets))), 1.0), label))
    for _ in range(epochs):
        for at, x, label in compact:
            w = weights(at)
            g = (_sigmoid(w @ x) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(np.arange(SIZE + 1))


def _shard_trainer(params: dict):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        tokens = _Tokens()
        group = group.sort_values(["order", "label", "text"], kind="stable")
        w = train([(features(t, tokens), int(y)) for t, y in zip(group["text"], group["label"])], **params)
        at = np.flatnonzero(w)
        return pd.DataFrame({"bucket": at.astype(np.int64), "weight": w[at], "rows": np.full(len(at), len(group), np.int64)})
    return fit


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = 12_000, shards: int = 6, epochs: int = 3, alpha: float = 0.3,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> np.ndarray:
    """Weights (the last one is the bias) from the labelled rows whose id is ``learnable``."""
    order = F.xxhash64(F.col("id"))
    chosen = (labels.select(F.col(id_col).alias(id_col), F.col(label_col).cast("int").alias("label")).dropna()
              .where(learnable).select(F.col(id_col).alias("id"), "label").withColumn("order", order)
              .orderBy("order", "id", "label").limit(max_rows))
    # max_rows rows at most: a proven bound
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "id").select(F.pmod("order", F.lit(shards)).alias("shard"), "order", "label", "text"))
    params = {"epochs": epochs, "alpha": alpha, "beta": beta, "l1": l1, "l2": l2}
    found = (rows.groupBy("shard").applyInPandas(_shard_trainer(params), "bucket long, weight double, rows long")
             .groupBy("bucket").agg(F.sum(F.col("weight") * F.col("rows")).alias("weight"), F.max("rows"),
                                    F.sum("rows").alias("rows")).collect())  # SIZE + 1 rows at most
    w = np.zeros(SIZE + 1)
    total = max((r["rows"] for r in found if r.bucket == SIZE), default=0) or max((r["rows"] for r in found), default=1)
    for r in found:
        w[r.bucket] = r.weight / total
    return w


def _scorer(weights: np.ndarray):
    def score(batches):
        tokens, w, bias = _Tokens(), weights[:-1], weights[-1]
        for b in batches:
            z = []
            for t in b.column(1).to_pylist():
                f = features(t, tokens)
                z.append(bias + (SCALE * w[f].mean() if len(f) else 0.0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_sigmoid(np.array(z, float)), pa.float64())],
                                             names=["id", "score"])
    return score


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` (0 to 1; higher: label 1 likelier) of every row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([src.schema.fields[0], T.StructField("score", T.DoubleType())])
    return src.mapInArrow(_scorer(weights.astype(np.float64)), schema)
