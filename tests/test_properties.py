"""Property checks: Spark-side rules against plain-Python statements of them."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tidemark.functions.stats import percent_1dp
from tidemark.functions.text import query_terms, tokens

TEXT = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=24)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=40, max_size=60))
def test_a_name_matches_itself_as_keyword(spark, texts):
    # index side and query side share one tokenizer: searching for a name
    # finds it whenever the name has any term at all
    from tidemark.operators.search import keyword_filter
    df = spark.createDataFrame([(t,) for t in texts], "sku_name string")
    for t in set(texts[:8]):
        hit = df.where((F.col("sku_name") == t) & keyword_filter(t)).count() > 0
        assert hit == (len(query_terms(t)) > 0)
    got = [r[0] for r in df.select(tokens("sku_name")).collect()]
    assert got == [query_terms(t) for t in texts]


def _java_round_share(n, total):
    if total == 0:
        return 0.0
    return math.floor(n * 1000.0 / total + 0.5) / 10.0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=10_000).flatmap(
    lambda t: st.tuples(st.integers(min_value=0, max_value=t), st.just(t))), min_size=20, max_size=40))
def test_percent_matches_half_up_rule(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, total long")
    got = [r[0] for r in df.select(percent_1dp("n", "total")).collect()]
    assert got == [_java_round_share(n, t) for n, t in pairs]
