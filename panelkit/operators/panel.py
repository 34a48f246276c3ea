"""Panel operators: fills, prior values, attribute backfill, stacking
(P05, P07, J01, J02, U01, U02)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions._util import text
from panelkit.operators.keys import dedup_by_key

PRIOR_PAIRS = {"preVal": "curVal", "preImpVal": "curImpVal"}


def fill_from(df: DataFrame, target: str, source: str, derive) -> DataFrame:
    """Where ``target`` is empty (or NULL) take ``derive(source)``."""
    return df.withColumn(target, F.when(text(target) == "", derive(F.col(source))).otherwise(F.col(target)))


def impute_prior(df: DataFrame, pairs: dict = PRIOR_PAIRS, factor: float = 0.99) -> DataFrame:
    """Prior value := ``factor`` x current value (for the first year,
    which has no prior). Bad number text gives NULL."""
    for pre, cur in pairs.items():
        df = df.withColumn(pre, F.col(cur).try_cast("double") * F.lit(factor))
    return df


def backfill_attribute(df: DataFrame, donor: DataFrame, key: str = "PID", attrs=("zoneCat",),
                       order_by=("year",), how: str = "inner") -> DataFrame:
    """Take ``attrs`` from ``donor`` by ``key``.

    The donor is first reduced to one row per key (its latest row by
    ``order_by``), so the join cannot multiply rows and no dedup is needed
    after it. ``how='inner'`` drops rows without a donor (old behaviour)."""
    attrs = [attrs] if isinstance(attrs, str) else list(attrs)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    one = dedup_by_key(donor.select(key, *order, *attrs), [key], order_by=order, keep="last").select(key, *attrs)
    left = df.drop(*[a for a in attrs if a in df.columns])
    joined = left.join(one, key, how)
    return joined.select(*[c for c in df.columns] + [a for a in attrs if a not in df.columns])


def prior_value(df: DataFrame, key: str = "PID", year: str = "year", pairs: dict = PRIOR_PAIRS,
                mode: str = "previous_year", base_year: int | None = None, how: str = "inner",
                first_factor: float | None = None) -> DataFrame:
    """Prior-period values.

    ``previous_year``: each ``pre`` column := the same key's ``cur`` value of
    ``year - 1`` (a ``lag`` guarded by ``lag(year) = year - 1``). The input must
    hold one row per key and year: a window group is then bounded by the number
    of years, and the same window raises where a key has two rows of one year.
    Rows laid out by ``key`` (:func:`dedup_within_key`) need no exchange.
    ``first_factor`` (P05): the rows of ``base_year``, which have no prior, stay
    with ``first_factor`` x current. ``base_year``: ``pre`` := the key's ``cur``
    in ``base_year``, for the rows of the other years.

    ``how='inner'`` drops rows that have no prior row (old behaviour)."""
    if mode == "previous_year":
        w = Window.partitionBy(key).orderBy(year)
        before = F.lag(F.col(year)).over(w)
        twice = F.concat(F.lit(f"two rows of one {year} for {key} "), F.col(key).cast("string"), F.lit(", "), F.col(year).cast("string"))
        follows = (F.when(before.isNotNull() & (before == F.col(year)), F.raise_error(twice).cast("boolean"))
                   .otherwise(F.coalesce(before == F.col(year) - F.lit(1), F.lit(False))))
        priors = [F.lag(F.col(cur)).over(w).alias(f"_prior_{pre}") for pre, cur in pairs.items()]
        out = df.select("*", follows.alias("_has_prior"), *priors)
        first = F.lit(False)
        if first_factor is not None:
            if base_year is None:
                raise ValueError("first_factor needs base_year")
            first = F.coalesce(F.col(year) == F.lit(base_year), F.lit(False))
        if how == "inner":
            out = out.where(F.col("_has_prior") | first)
        fill = {}
        for pre, cur in pairs.items():
            prior = F.when(F.col("_has_prior"), F.col(f"_prior_{pre}"))
            fill[pre] = prior if first_factor is None else \
                F.when(first, F.col(cur).try_cast("double") * F.lit(first_factor)).otherwise(prior)
        return out.withColumns(fill).select(*_ordered(df, pairs))
    if mode == "base_year":
        if base_year is None:
            raise ValueError("base_year mode needs base_year")
        base = df.where(F.col(year) == F.lit(base_year)).select(
            key, *[F.col(cur).alias("_b_" + pre) for pre, cur in pairs.items()])
        rest = df.where(F.col(year) != F.lit(base_year)).drop(*[p for p in pairs if p in df.columns])
        out = rest.join(base, key, how)
        for pre in pairs:
            out = out.withColumnRenamed("_b_" + pre, pre)
        out = out.select(*_ordered(df, pairs))
        if first_factor is None:
            return out
        return out.unionByName(impute_prior(df.where(F.col(year) == F.lit(base_year)), pairs, first_factor).select(*_ordered(df, pairs)))
    raise ValueError("mode must be 'previous_year' or 'base_year'")


def _ordered(df: DataFrame, pairs: dict) -> list[str]:
    return list(df.columns) + [p for p in pairs if p not in df.columns]


def stack_years(dfs, numeric=()) -> DataFrame:
    """Bag union by column name; ``numeric`` columns are cast to
    double (bad text -> NULL) on every input first, so text and double inputs
    stack without an implicit, failing cast."""
    dfs = list(dfs)
    cols = dfs[0].columns

    def norm(d: DataFrame) -> DataFrame:
        return d.select(*[F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in cols])

    return reduce(DataFrame.unionByName, [norm(d) for d in dfs])
