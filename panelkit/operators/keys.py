"""Keys: deterministic dedup (D01), distinct values (D02), hash split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions._util import as_col
from panelkit.stages import releasing, store_stage


def dedup_by_key(df: DataFrame, keys, order_by=(), keep: str = "first") -> DataFrame:
    """One row per key.

    The winner is the smallest (``keep='first'``) or largest (``'last'``) row
    ordered by ``order_by`` and then by every remaining column: a total order,
    so the result does not depend on partitioning or arrival order.

    Planned as ``min``/``max`` of a struct in a grouped aggregate, which has a
    map-side partial step: a key holding a third of all rows is reduced to one
    row per input task before the shuffle, instead of being sorted in one task
    as a window would be."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    pick = F.min if keep == "first" else F.max
    out = df.groupBy(*keys).agg(pick(packed).alias("_winner"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col("_winner").getField(c).alias(c) for c in order + rest]).select(*df.columns)


def dedup_within_key(df: DataFrame, key: str, within: str, values, order_by=(), keep: str = "first") -> DataFrame:
    """D01 on (``key``, ``within``) for the listed ``values`` of ``within``, laid
    out by ``key``: the winners are those of :func:`dedup_by_key` and rows with
    other values go.

    One grouped aggregate by ``key`` holds a winner per value, so the rows that
    come out are partitioned by ``key`` alone: windows and joins on it need no
    further exchange. The partial step reduces a key with a third of all rows
    to a row per input task, so the layout costs no hot task."""
    values = list(dict.fromkeys(values))
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in (key, within) and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    pick = F.min if keep == "first" else F.max
    if not values:
        return df.limit(0)
    wide = df.where(F.col(within).isin(values)).groupBy(key).agg(
        *[pick(F.when(F.col(within) == F.lit(v), packed)).alias(f"_winner{i}") for i, v in enumerate(values)])
    found = F.array(*[F.struct(F.lit(v).alias(within), F.col(f"_winner{i}").alias("_row")) for i, v in enumerate(values)])
    rows = wide.select(key, F.explode(found).alias("_one")).where(F.col("_one._row").isNotNull())
    return rows.select(key, F.col(f"_one.{within}").alias(within),
                       *[F.col("_one._row").getField(c).alias(c) for c in order + rest]).select(*df.columns)


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Distinct values of one or more columns (partial + final aggregate)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct()


def number_rows(df: DataFrame, order: list[Column], name: str = "idx", with_count: bool = False):
    """``df`` with ``name`` = 0, 1, 2, ... in the order of ``order`` (and, with
    ``with_count``, the number of rows beside it), as a finished table.

    For any number of rows: they are dealt over tasks by range, sorted there,
    and each row's place in its range is noted as it is written (the low bits
    of ``monotonically_increasing_id``). The number of rows in the ranges before
    it is added in a second pass over the written rows, so a reader scans the
    numbers and repeats nothing: no window, no sort, no join. The driver sees
    one count per range."""
    spark = df.sparkSession
    with releasing(spark) as step:
        placed = store_stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                             .withColumn("_place", F.monotonically_increasing_id()), "placed")
        piece = F.shiftright("_place", 33)
        before, total = [], 0
        for found, n in sorted(placed.groupBy(piece).count().collect()):
            before.append((found, total))
            total += n
        starts = spark.createDataFrame(before, "_piece long, _before long")
        place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
        numbered = (placed.withColumn("_piece", piece).join(starts, "_piece")
                    .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + place).alias(name)))
        out = step.keep(store_stage(numbered, "numbered"))
    return (out, total) if with_count else out


def hash_bucket(*cols, buckets: int = 10000) -> Column:
    """Stable bucket in [0, buckets) from the md5 of the key text; the same
    row lands in the same bucket on every run and every partitioning."""
    key = F.concat_ws("|", *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def split_label(key_cols, fractions=(0.6, 0.4), names=("train", "test"), buckets: int = 10000) -> Column:
    """The part a row belongs to under :func:`hash_split`."""
    if len(fractions) != len(names):
        raise ValueError("one name per fraction")
    total = float(sum(fractions))
    b = hash_bucket(*key_cols, buckets=buckets)
    edges, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f / total
        edges.append(int(round(acc * buckets)))
    expr = None
    for edge, name in zip(edges, names[:-1]):
        expr = F.when(b < F.lit(edge), F.lit(name)) if expr is None else expr.when(b < F.lit(edge), F.lit(name))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def hash_split(df: DataFrame, key_cols, fractions=(0.6, 0.4), buckets: int = 10000) -> list[DataFrame]:
    """Deterministic split by key hash. Parts are disjoint and cover
    the input; include the class in ``key_cols`` for a per-class split."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    names = [f"part{i}" for i in range(len(fractions))]
    label = split_label(key_cols, fractions, names, buckets)
    return [df.where(label == F.lit(n)) for n in names]
