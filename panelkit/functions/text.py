"""Text and code helpers (T01-T04, T11-T14) as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions._util import as_col

# Value-band lower bounds (inclusive) and labels '1'..'6'.
BAND_BOUNDS = (300000, 700000, 1000000, 1400000, 1600000)


def prefix_before(c, sep: str, missing: str | None = None, strip: bool = False) -> Column:
    """Text before the first ``sep``.

    T01 (``sep=' '``, ``strip=True``): trimmed postcode to its first part; a
    code with no separator gives NULL (the old code raised).
    T02 (``sep='-'``, ``missing='CD'``): zone name to category; no separator
    (also empty text) gives ``missing``."""
    s = F.trim(as_col(c)) if strip else as_col(c)
    found = F.instr(s, sep) > 0
    fallback = F.lit(missing) if missing is not None else F.lit(None).cast("string")
    return F.when(s.isNull(), F.lit(None).cast("string")) \
            .when(found, F.substring_index(s, sep, 1)) \
            .otherwise(fallback)


def onehot_text(i, n) -> Column:
    """Width-``n`` text of zeros with a '1' at 0-based position ``i``."""
    i = F.lit(i) if isinstance(i, int) else as_col(i)
    n = F.lit(n) if isinstance(n, int) else as_col(n)
    return F.concat(F.repeat(F.lit("0"), i), F.lit("1"), F.repeat(F.lit("0"), n - i - 1))


def concat_codes(*cols, sep: str | None = None) -> Column:
    """T11 (plain ``concat``) and T12 (``concat_ws(sep, ...)``)."""
    cs = [as_col(c) for c in cols]
    return F.concat(*cs) if sep is None else F.concat_ws(sep, *cs)


def code_to_array(code, *numbers, width: int | None = None) -> Column:
    """One-hot text to its digits as doubles, followed by the numbers.
    A code of the wrong width gives an empty array (the old behaviour)."""
    code = as_col(code)
    digits = F.transform(F.regexp_extract_all(code, F.lit("."), F.lit(0)), lambda x: x.try_cast("double"))
    out = F.concat(digits, F.array(*[as_col(x).try_cast("double") for x in numbers])) if numbers else digits
    if width is None:
        return out
    return F.when(F.length(code) == F.lit(width), out).otherwise(F.array().cast("array<double>"))


def band_value(c, bounds=BAND_BOUNDS) -> Column:
    """Value band label '1'..str(len(bounds)+1); lower bound inclusive,
    NULL stays NULL."""
    v = as_col(c)
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for k in range(len(bounds), 0, -1):
        expr = expr.when(v >= F.lit(bounds[k - 1]), F.lit(str(k + 1)))
    return expr.otherwise(F.lit("1"))


def band_index(c, bounds=BAND_BOUNDS) -> Column:
    """T14 for fitting: 0-based class index as double (label 1 -> 0.0)."""
    return band_value(c, bounds).cast("int").cast("double") - F.lit(1.0)
