"""Column expressions. Every function returns a ``pyspark.sql.Column`` built
from Spark's native functions: no Python UDF sits in a hot path."""

from panelkit.functions.buckets import month_bucket, split_bucket, year_bucket
from panelkit.functions.predicates import (
    all_not_null, as_date, date_between, date_from, drop_sentinel, exclude_year,
    has_key, has_length, has_value, not_null, numeric_prefix, valid_code, valid_onehot,
    valid_vector,
)
from panelkit.functions.text import (
    BAND_BOUNDS, band_index, band_value, code_to_array, concat_codes, onehot_text,
    prefix_before,
)

__all__ = [n for n in dir() if not n.startswith("_")]
