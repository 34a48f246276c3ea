"""Connected components of links between long ids, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._tables import stored
from panelkit.stages import releasing


def _followed(hooked: DataFrame) -> DataFrame:
    """``hooked`` (node, to) with every target followed to the last one, by
    pointer doubling: a chain of n nodes takes log2(n) rounds."""
    while True:
        ahead = hooked.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = stored(hooked.join(ahead, "to", "left").select("node", F.coalesce("next", "to").alias("to"),
                                                                F.coalesce(F.col("next") != F.col("to"), F.lit(False)).alias("moved")), "hooks")
        hooked = jumped.select("node", "to")
        if jumped.where("moved").isEmpty():
            return hooked


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node
    of ``links`` (a, b).

    Each round hooks every node to the smallest of itself and its neighbours,
    follows the hooks to their ends (:func:`_followed`), replaces the ends of all
    links by those, and drops links that became loops or repeats. Only nodes
    smaller than all their neighbours are left, so an ordered path of any length
    takes one round, and a star two. A hub costs no more than its links: minima
    are taken before the shuffle. Tables of earlier rounds go."""
    with releasing(links.sparkSession) as step:
        links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        labels = None
        while not links.isEmpty():
            ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            hooked = stored(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).select(F.col("a").alias("node"), "to"), "hooks")
            hooked = _followed(hooked)
            if labels is None:
                labels = hooked.withColumnRenamed("to", "component")
            else:
                onward = hooked.withColumnRenamed("node", "component")
                labels = stored(labels.join(onward, "component", "left")
                                .select("node", F.coalesce("to", "component").alias("component")), "labels")
            moved = (links.join(hooked.withColumnRenamed("node", "a"), "a").select(F.col("to").alias("x"), "b")
                     .join(hooked.withColumnRenamed("node", "b"), "b").select("x", F.col("to").alias("y")))
            links = stored(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
            step.release(links, labels)
        if labels is None:
            labels = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return step.keep(labels)
