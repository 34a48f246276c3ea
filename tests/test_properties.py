"""Property tests: Spark expressions against plain-Python statements of the
same rules, on generated values (one DataFrame per example batch)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.functions import band_value, has_length, onehot_text, prefix_before
from panelkit.operators import map_values

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXT = st.one_of(st.none(), st.text(alphabet="AB -1", max_size=8))


def py_prefix(s, sep, missing):
    if s is None:
        return None
    return s.split(sep, 1)[0] if sep in s else missing


def py_band(v):
    if v is None:
        return None
    for k, b in reversed(list(enumerate((300000, 700000, 1000000, 1400000, 1600000)))):
        if v >= b:
            return str(k + 2)
    return "1"


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_prefix_and_length(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    out = df.select(prefix_before("s", "-", missing="CD").alias("p"), has_length("s", 3).alias("n")).collect()
    assert [r.p for r in out] == [py_prefix(v, "-", "CD") for v in values]
    assert [r.n for r in out] == [v is not None and len(v.strip(" ")) == 3 for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=0, max_value=3e6, allow_nan=False)), min_size=1, max_size=20))
def test_bands(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.b for r in df.select(band_value("v").alias("b")).collect()] == [py_band(v) for v in values]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=20), st.integers(min_value=41, max_value=60))
def test_onehot(spark, positions, width):
    df = spark.createDataFrame([(p,) for p in positions], "i int")
    codes = [r.c for r in df.select(onehot_text(F.col("i"), width).alias("c")).collect()]
    assert codes == ["0" * p + "1" + "0" * (width - p - 1) for p in positions]


@SETTINGS
@given(st.dictionaries(st.sampled_from("abcde"), st.sampled_from("abcdeXY"), max_size=5),
       st.lists(st.one_of(st.none(), st.sampled_from("abcdefg")), min_size=1, max_size=20))
def test_map_values_is_one_simultaneous_lookup(spark, mapping, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.v for r in map_values(df, "v", mapping).collect()]
    assert got == [mapping.get(v, v) if v is not None else None for v in values]
