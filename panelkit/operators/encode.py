"""Value maps and category encoders."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions._util import as_col
from panelkit.functions.text import onehot_text
from panelkit.operators.keys import number_rows

# Zone category names and the code each one stands for.
ZONE_NAMES = ("One Family Dwelling", "Two Family Dwelling", "Multiple Family Dwelling",
              "Limited Agricultural", "Commercial", "Comprehensive Development",
              "Light Industrial", "Industrial", "Historic Area")
ZONE_CODES = ("RS", "RT", "RM", "RA", "C", "CD", "IC", "M", "HA")
# Legal types, in one-hot order.
LEGAL_TYPES = ("LAND", "STRATA", "OTHER")


def onehot_strings(n: int) -> list[str]:
    """The n one-hot texts of width n, position i set for the i-th."""
    return ["0" * i + "1" + "0" * (n - i - 1) for i in range(n)]


def map_values_expr(c, mapping: dict) -> Column:
    """P08 as an expression: every value is looked up once in the original
    text (A->B, B->C gives B for A: no chaining); unmapped values and NULL
    stay as they are."""
    c = as_col(c)
    if not mapping:
        return c
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(lookup, c), c)


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """P08 on a DataFrame column. For dictionaries fitted on data use
    :func:`encode_categories` (a join)."""
    return df.withColumn(out or col, map_values_expr(col, mapping))


def fit_categories(df: DataFrame, col: str) -> DataFrame:
    """F01 fit: dictionary ``(value, idx, width)`` of the distinct non-NULL
    values, numbered in alphabetical order (repeatable); ``width`` is their
    number. Any number of values: they are numbered range by range
    (:func:`number_rows`), never sorted in one task. The one-hot text is only
    made where it is used (:func:`category_codes`, :func:`encode_categories`)."""
    values = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    numbered, n = number_rows(values, [F.col("value")], with_count=True)
    return numbered.select("value", F.col("idx").cast("int").alias("idx"), F.lit(n).cast("int").alias("width"))


def category_codes(dictionary: DataFrame) -> DataFrame:
    """The dictionary as ``(value, idx, code)`` with the one-hot texts."""
    return dictionary.select("value", "idx", onehot_text(F.col("idx"), F.col("width")).alias("code"))


def encode_categories(df: DataFrame, col: str, dictionary: DataFrame, unseen: str = "null",
                      out: str | None = None, value: str = "code", raw: str | None = None) -> DataFrame:
    """F01 apply: replace ``col`` by its dictionary ``code`` (or ``idx``); with
    ``raw`` the text that was there is kept in a column of that name.

    ``unseen``: ``'null'`` (default), ``'keep'`` (raw value stays, the old
    behaviour) or ``'error'``. A plain left join: adaptive execution broadcasts
    the dictionary when its measured size allows, and otherwise splits the
    partitions of hot values."""
    if unseen not in ("null", "keep", "error"):
        raise ValueError("unseen must be 'null', 'keep' or 'error'")
    d = dictionary.select("value", "idx", "width").toDF("_dict_key", "_idx", "_width")
    joined = df.join(d, F.col(col) == F.col("_dict_key"), "left")
    code = onehot_text(F.col("_idx"), F.col("_width")) if value == "code" else F.col("_idx").cast("string")
    if unseen == "keep":
        code = F.coalesce(code, F.col(col).cast("string"))
    elif unseen == "error":
        code = F.when(code.isNull() & F.col(col).isNotNull(),
                      F.raise_error(F.concat(F.lit(f"unseen value in '{col}': "), F.col(col).cast("string")))
                      ).otherwise(code)
    target = out or col
    cols = [code.alias(target) if c == target else F.col(c) for c in df.columns]
    if target not in df.columns:
        cols.append(code.alias(target))
    if raw:
        cols.append(F.col(col).alias(raw))
    return joined.select(*cols)


def zone_mapping(names=ZONE_NAMES, codes=ZONE_CODES) -> dict:
    """F02 as one composed map: name -> one-hot and code -> one-hot."""
    hot = onehot_strings(len(codes))
    mapping = dict(zip(codes, hot))
    mapping.update({n: hot[codes.index(c)] for n, c in zip(names, codes)})
    return mapping


def encode_zone(df: DataFrame, col: str = "zoneCat", names=ZONE_NAMES, codes=ZONE_CODES) -> DataFrame:
    """zone names and codes to the one-hot of their code; other values
    stay as they are."""
    return map_values(df, col, zone_mapping(names, codes))


def encode_legal(df: DataFrame, col: str = "legalType", values=LEGAL_TYPES) -> DataFrame:
    """fixed one-hot of the legal type (LAND 100, STRATA 010, OTHER 001)."""
    return map_values(df, col, dict(zip(values, onehot_strings(len(values)))))
