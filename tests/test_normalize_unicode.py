"""P4 over random assigned Unicode text against properties of normalized text.

Unassigned code points are left out: the JVM's ICU tables follow a newer
Unicode version than this Python, and the two differ only there."""
from hypothesis import given, settings, strategies as st

from corpusflow.functions import text as T
from test_text import assert_normal


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cn", "Co")), max_size=20),
                min_size=1, max_size=10))
def test_normalize_any_text(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    for r in df.select("i", T.normalize_text("s").alias("n")).collect():
        assert_normal(texts[r.i], r.n)
