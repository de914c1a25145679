"""Property checks for lenient parsing (many generated strings in one Spark job)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from trackline.operators.clean import coerce_types

numbers = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False, width=64).map(repr),
    st.integers(min_value=-10**12, max_value=10**12).map(str),
    st.decimals(allow_nan=False, allow_infinity=False, places=4, min_value=-1000, max_value=1000).map(str),
)
junk = st.text(alphabet="0123456789.,-+eEdx NA", min_size=0, max_size=8)


def _expected(text):
    t = text.strip()
    if "_" in t:  # Python accepts digit separators; a CSV number never has them
        return None
    try:
        return float(t)
    except ValueError:
        return None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(numbers, junk), min_size=1, max_size=40))
def test_to_double_agrees_with_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "latitude string")
    got = [r["latitude"] for r in coerce_types(df).collect()]
    for text, g in zip(values, got):
        e = _expected(text)
        if e is None:
            assert g is None, text
        elif math.isnan(e):
            assert g != g, text
        else:
            assert g == e, (text, g, e)
