"""Mixing sources to target weights by Pareto order sampling.

Sources, in code-point order with null last, weigh 1, 2, 3, repeating, and
share the words of all documents by weight. A source's target stops at
``most`` times its own words; the excess is reshared by weight until no source
is above.

Inside a source each document expects ``c = min(most, rate * propensity)``
copies, the rate being the one at which the expected words meet the target.
The whole copies are certain. The rest ``p = c - floor(c)`` is an inclusion
probability, unequal between documents: each draws ``u`` from a hash of its id,
and documents are ranked by ``(u / (1 - u)) / (p / (1 - p))``, their random odds
by their inclusion odds. The sample is the first of that order, up to the
fixed size in words that the certain copies left (the document at the border
is taken if that comes nearer). The ranking value used is that ratio ``q`` as
``q / (1 + q)``, which has the same order and lies between 0 and 1.

No source is ever sorted in one task: the border is found by two histograms of
1,024 bins over the ranking value, the second inside the border bin of the
first, and only the documents in the border's last bin (about a millionth of a
source) are sorted. Propensities are rounded down to powers of two, so that the
rate of a source comes from a table of few rows.

Null texts have size 0, null sources are a source. Documents of size 0 take 0
words. Draws come from a hash of id and seed, so reruns agree; rows with a
repeated or null id draw the same ``u`` and are ranked by size. An empty table
gives an empty mix. Extra columns need no care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._tables import stored
from panelkit.operators.keys import number_rows

WORD = r"[^\x20\x09-\x0D]+"
BINS = 1024
#: Propensities are 2 ** 0 down to 2 ** -LOWEST.
LOWEST = 16


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) with 52 random bits, from id and seed."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << 52)


def size_propensity(size: Column) -> Column:
    """1 for documents of 64 words or more, a half from 16 words on, else a quarter."""
    return F.when(size >= 64, 1.0).when(size >= 16, 0.5).otherwise(0.25)


def source_targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``sizes`` (key, source, source_size) with ``target``. Each pass fixes the
    sources that are above their stop and reshares the rest, until none is."""
    weighed = number_rows(sizes, [F.col("source").asc_nulls_last()], "nth")
    weighed = stored(weighed.select("key", "source_size", (F.col("nth") % 3 + 1).alias("weight")), "mix-sources")
    total, share = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    rate = total / share if share else 0.0
    while share:
        above = most * F.col("source_size") < F.lit(rate) * F.col("weight")
        fixed, left = weighed.agg(F.sum(F.when(above, most * F.col("source_size")).otherwise(0)),
                                  F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not left or (total - fixed) / left == rate:
            break
        rate = (total - fixed) / left
    return weighed.select("key", "source_size",
                          F.least(F.lit(rate) * F.col("weight"), (most * F.col("source_size")).cast("double")).alias("target"))


def source_rates(docs: DataFrame, targets: DataFrame, most: int = 3) -> DataFrame:
    """``key``, ``propensity`` and ``expected`` copies: the classes of highest
    propensity stop at ``most`` first, the rate is what the others then need."""
    classes = docs.groupBy("key", "propensity").agg(F.sum("size").alias("words")).join(targets, "key")
    before = Window.partitionBy("key").orderBy(F.desc("propensity")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("key").orderBy(F.desc("propensity")).rowsBetween(0, Window.unboundedFollowing)
    rate = F.try_divide(F.col("target") - most * F.coalesce(F.sum("words").over(before), F.lit(0)),
                        F.sum(F.col("propensity") * F.col("words")).over(rest))
    classes = classes.withColumn("rate", rate)
    own = Window.partitionBy("key")
    fits = F.max(F.when(F.col("rate") * F.col("propensity") <= most, F.struct("propensity", "rate"))).over(own)["rate"]
    return classes.select("key", "propensity", "source_size", "target",
                          F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.coalesce(fits, F.lit(float("inf"))) * F.col("propensity"))).alias("expected"))


def _border(rows: DataFrame, start: DataFrame) -> DataFrame:
    """The first ``bin`` of each key at which the words pass the budget, and
    the words ``before`` it; ``start`` has key, budget and the words so far."""
    bins = rows.groupBy("key", "bin").agg(F.sum("size").alias("words")).join(start, "key")
    upto = F.col("so_far") + F.sum("words").over(Window.partitionBy("key").orderBy("bin"))
    return (bins.withColumn("upto", upto).where(F.col("upto") > F.col("budget"))
            .groupBy("key", "budget").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("at"))
            .select("key", "budget", "at.bin", F.col("at.before").alias("so_far")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = 3,
        propensity=size_propensity, seed: str = "mix", payload: bool = False) -> DataFrame:
    """``id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of
    every row; with ``payload`` the row as struct ``row``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = F.col(source_col).cast("string")
    cols = [F.col(id_col).alias("id"), source.alias("source"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.monotonically_increasing_id().alias("row_no")]
    if payload:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = stored(docs.select(*cols), "mix-documents")
    halvings = F.least(F.lit(LOWEST), F.greatest(F.lit(0), F.ceil(-F.log2(propensity(F.col("size"))))))
    slim = whole.select("id", "key", "size", "row_no", uniform(F.col("id"), seed).alias("u"),
                        F.pow(F.lit(2.0), -halvings).alias("propensity"))
    targets = source_targets(whole.groupBy("key", "source").agg(F.sum("size").alias("source_size")), most)
    rates = source_rates(slim, targets, most)
    p = F.col("expected") - F.floor("expected")
    value = F.col("u") * (1 - p) / (F.col("u") * (1 - p) + (1 - F.col("u")) * p)
    ranked = slim.join(rates, ["key", "propensity"]).select(
        "id", "key", "size", "row_no", "source_size", "target", F.floor("expected").cast("long").alias("certain"), value.alias("value"))
    ranked = stored(ranked.withColumn("bin", F.floor(F.col("value") * BINS).cast("long"))
                    .withColumn("fine", F.floor(F.col("value") * BINS * BINS).cast("long")), "mix-ranked")
    budget = ranked.groupBy("key").agg((F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("budget"),
                                       F.lit(0).cast("long").alias("so_far"))
    coarse = stored(_border(ranked, budget), "mix-border")
    inside = ranked.join(coarse.select("key", "bin"), ["key", "bin"], "left_semi")
    fine = stored(_border(inside.withColumn("bin", F.col("fine")), coarse.drop("bin")), "mix-border")
    at_border = ranked.join(fine.withColumnRenamed("bin", "fine"), ["key", "fine"])
    upto = F.sum("size").over(Window.partitionBy("key").orderBy("value", "id", "size", "row_no").rowsBetween(Window.unboundedPreceding, -1))
    taken_there = (at_border.withColumn("before", F.col("so_far") + F.coalesce(upto, F.lit(0)))
                   .where(F.col("before") + F.col("size") / 2 <= F.col("budget")).select("row_no", F.lit(1).alias("border")))
    last = fine.select("key", F.col("bin").alias("last_bin"))
    decided = (ranked.join(last, "key", "left").join(taken_there, "row_no", "left")
               .withColumn("drawn", (F.col("value") < 1) & (F.col("last_bin").isNull() | (F.col("fine") < F.col("last_bin"))
                                                            | F.col("border").isNotNull()))
               .select("id", "size", "source_size", "target", "row_no", (F.col("certain") + F.col("drawn").cast("long")).alias("copies")))
    decided = decided.withColumn("taken", F.col("copies") * F.col("size"))
    if payload:
        decided = decided.join(whole.select("row_no", "row"), "row_no")
    return decided.drop("row_no")


def repeat_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs``, whole, as often as it was taken."""
    mixed = mix(docs, payload=True, **options).where("copies > 0")
    return mixed.select(F.explode(F.array_repeat(F.col("row"), F.col("copies").cast("int"))).alias("row")).select("row.*")
