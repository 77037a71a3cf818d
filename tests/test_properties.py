"""Property tests (Hypothesis): the number parser against a plain-Python statement of the rule."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyfig.functions.columns import parse_number

SENTINELS = {"..", ":", "", "<NA>", "nan"}
NUMBER = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?")


def expected(text: str, comma: bool):
    t = text.strip(" ")
    if comma:
        t = t.replace(",", ".")
    if t in SENTINELS or not NUMBER.fullmatch(t):
        return None
    return float(t)


texts = st.one_of(
    st.sampled_from(["..", ":", "", "<NA>", "nan", " 12 ", "12d", "1,5", "-0.25", "1e3", ".5", "5."]),
    st.from_regex(r"\A[ ]?[+-]?[0-9]{1,6}([.,][0-9]{0,4})?[ ]?\Z"),
    st.text(alphabet="0123456789.,-+eE :dn", max_size=8))


@settings(max_examples=5, deadline=None)
@given(st.lists(texts, min_size=1, max_size=200), st.booleans())
def test_parse_number_matches_rule(spark, values, comma):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(parse_number(F.col("v"), decimal_comma=comma)).collect()]
    assert got == [expected(v, comma) for v in values]
