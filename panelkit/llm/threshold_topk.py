"""Exact top-k inner-product search by the threshold algorithm.

Vectors are dealt over blocks of bounded size, and each block keeps, for
every dimension, its rows sorted by that component. For one query the lists
are read in parallel, each from the end that adds most to the score (from the
top where the query's component is positive, from the bottom where it is
negative; dimensions with 0 are not read). Every row met is scored exactly.
The bound is the score that a row not met yet could reach at most: the sum of
the products at the places reached. Reading stops once the bound is below the
k-th best score; on equality it goes on, since an unseen row could tie with a
smaller id.

Two rounds: first each query searches the block of its own row, which gives
a k-th score to start from; then all other blocks are searched with that score
as the one to beat. Queries are dealt over groups of bounded size too, so a task
holds one block and one group of queries, at any input size.

Vectors that are null, or hold a null or non-finite component, and rows with
a null id take no part. A vector only meets vectors of its own length. Rows
that share a query's id count as its own row; of several rows with a query's
id the first stored one asks. Scores are exact 64-bit integers (float32 or
float64 arithmetic is used only where it is exact). Extra columns and empty
tables need no care.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._tables import stored

FOUND = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``id`` and ``v`` = floor(scale * x) of every usable vector."""
    x = F.col(vector_col)
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & usable)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


class SortedLists:
    """One block: its rows as a matrix and, for each dimension, the row
    numbers and components in ascending order."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, largest_query: int):
        self.ids = ids
        reach = rows.shape[1] * int(np.abs(rows).max(initial=0)) * largest_query
        kind = np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else np.int64
        self.rows = rows.astype(kind)
        self.order = np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.sort(self.rows, axis=0).T

    def top(self, query_id: int, q: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best rows, best first; rows below ``floor`` may be left out."""
        n = len(self.ids)
        q = q.astype(self.rows.dtype)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        met = np.zeros(n, bool)
        best_score, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step, done = 0, 8, not n
        while not done:
            end = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[up, n - end:n - depth].ravel()] = True
            fresh[self.order[down, depth:end].ravel()] = True
            done = end == n
            if done:  # rows met in no list only differ in dimensions where the query is 0
                fresh[:] = True
            fresh &= ~met
            new = np.flatnonzero(fresh)
            if len(new):
                met |= fresh
                score = ((self.rows @ q)[new] if 2 * len(new) > n else self.rows[new] @ q).astype(np.int64)
                bar = best_score[k - 1] if len(best_score) >= k else floor
                use = self.ids[new] != query_id
                if bar is not None:
                    use &= score >= bar
                best_score = np.concatenate([best_score, score[use]])
                best_id = np.concatenate([best_id, self.ids[new][use]])
                keep = np.lexsort((best_id, -best_score))[:k]
                best_score, best_id = best_score[keep], best_id[keep]
            bound = int((q[up] * self.values[up, n - end]).sum() + (q[down] * self.values[down, end - 1]).sum())
            kth = best_score[k - 1] if len(best_score) >= k else floor
            done = done or met.all() or (kth is not None and bound < kth)
            depth, step = end, step * 2
        return list(zip(best_score.tolist(), best_id.tolist()))


def _searcher(k: int):
    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        width, asked = block["v"].map(len).to_numpy(), queries["v"].map(len).to_numpy()
        for d in np.intersect1d(width, asked):
            mine, own = block[width == d], queries[asked == d]
            matrix = np.array(own["v"].tolist(), np.int64).reshape(len(own), d)
            lists = SortedLists(mine["id"].to_numpy(np.int64), np.array(mine["v"].tolist(), np.int64).reshape(len(mine), d),
                                int(np.abs(matrix).max(initial=0)))
            for i, q, floor in zip(own["id"].tolist(), matrix, own["floor"].tolist()):
                out += [(i, j, s) for s, j in lists.top(i, q, k, None if pd.isna(floor) else int(floor))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return search


def top_k(vectors: DataFrame, asks: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, block_rows: int = 8_192, group_queries: int = 2_048) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k``
    best other rows of every row for which ``asks`` (over ``id``) holds."""
    rows = integer_vectors(vectors, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "topk-vectors")
    blocks = max(1, -(-rows.count() // block_rows))
    data = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    first = Window.partitionBy("id").orderBy("row")
    queries = stored(data.where(asks).withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth"), "topk-queries")
    search = _searcher(k)
    # round 1: each query in its own block
    own = (data.groupBy("block").cogroup(queries.withColumn("floor", F.lit(None).cast("string")).groupBy("block"))
           .applyInPandas(search, FOUND))
    own = stored(own, "topk-own")
    start = own.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("string").alias("floor"))
    queries = queries.join(start, queries["id"] == start["query_id"], "left").drop("query_id")
    # round 2: all other blocks, groups of queries against blocks
    groups = max(1, -(-queries.count() // group_queries))
    grid = F.sequence(F.lit(0), F.lit(groups - 1))
    asked = (queries.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).withColumnRenamed("block", "home")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where("block <> home"))
    others = (data.withColumn("grp", F.explode(grid)).groupBy("grp", "block")
              .cogroup(asked.groupBy("grp", "block")).applyInPandas(search, FOUND))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (own.unionByName(others).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
