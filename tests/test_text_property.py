"""Property: name cleaning equals Python ``str.strip().title()``."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockyard.functions.text import clean_name

# Letters (ASCII, accented, Greek, CJK), digits, punctuation and several kinds of white space.
ALPHABET = "aZbYqQéÉöÖσΣ中文1 9'-#.&_ \t\n\xa0 　"


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=1, max_size=40))
def test_clean_name_matches_python(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r.c for r in df.select(clean_name(F.col("s")).alias("c")).collect()]
    assert got == [w.strip().title() for w in words]
