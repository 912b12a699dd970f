import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.functions import (
    bucket_of,
    index_stopwords,
    is_question,
    is_short_query,
    query_stopwords,
    remove_stopwords,
    term_bucket,
    tokenize,
)
from lodestone.operators import queries as qs

# The same token rule in Python's own regular expressions.
WORD = re.compile(r"[#@\w](?:['\-]?\w){2,24}", re.UNICODE)


def python_tokens(text):
    return [m.group() for m in WORD.finditer(text.lower())]


def spark_tokens(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", tokenize("text").alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


def test_tokenize_cases(spark):
    texts = [
        "", "ab", "abc", "It's a well-known fact", "#hash @user x#y", "Straße ÉCOLE naïve",
        "a" * 60, "rock'n'roll -- ''quoted''", "x² 12½ 2021-08", "日本語テキスト", "étude",
    ]
    assert spark_tokens(spark, texts) == [python_tokens(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="abcéß'-#@ _9½\nXYZ日", max_size=60), min_size=1, max_size=40))
def test_tokenize_agrees_with_python(spark, texts):
    assert spark_tokens(spark, texts) == [python_tokens(t) for t in texts]


def test_tokenize_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    rows = docs.select("text", tokenize("text").alias("t")).collect()
    assert all(r["t"] == python_tokens(r["text"]) for r in rows)


def test_stopword_lists_differ():
    assert "history" in index_stopwords() and "history" not in query_stopwords()
    assert "extenal" in query_stopwords() and "external" not in query_stopwords()
    assert index_stopwords(["foo"])[:2] == ["also", "became"]


def test_remove_stopwords_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(["b", "a", "the", "b"],)], "t array<string>")
    assert df.select(remove_stopwords("t", ["the"]).alias("t")).first()["t"] == ["b", "a", "b"]


def test_bucket_is_the_same_on_driver_and_cluster(spark):
    terms = ["alpha", "straße", "日本語", "x"]
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    found = {r["term"]: r["b"] for r in df.select("term", term_bucket("term").alias("b")).collect()}
    assert found == {t: bucket_of(t) for t in terms}
    assert all(0 <= b < 124 for b in found.values())


def test_query_predicates(spark):
    rows = [("abc",), ("ab?",), ("Who is it",), ("long query?",)]
    df = spark.createDataFrame(rows, "query string").select(
        is_question("query").alias("q"), is_question("query", True).alias("qw"),
        is_short_query("query").alias("s"))
    assert [tuple(r) for r in df.collect()] == [
        (False, False, True), (True, True, False), (False, True, False), (True, True, False)]


def test_query_terms_positions_and_weights(spark):
    df = spark.createDataFrame(
        [(1, "the Cat sat, the cat?"), (2, ""), (3, "the of"), (4, "cat")],
        "query_id bigint, query string")
    terms = {(r.query_id, r.term): (r.qtf, r.pos) for r in qs.query_term_counts(df).collect()}
    assert terms == {(1, "cat"): (2, 0), (1, "sat"): (1, 1), (4, "cat"): (1, 0)}
    assert sorted(r.query_id for r in qs.query_nonempty(df).collect()) == [1, 4]
    weights = {r.query_id: (r.x, r.y) for r in qs.query_weights(df).collect()}
    assert weights[1] == (1304.4103830767667, 5.193904691848007)
    assert weights[4] == (149.15920831630416, 59.41622193605568)
    assert df.select(F.max("query_id")).first()[0] == 4


def test_buckets_of_any_number(spark):
    """For powers of two the last digits of the hash decide; they are all that is converted."""
    terms = spark.createDataFrame([(t,) for t in ("tion", "étude", "", "日本語", "a" * 40)], "term string")
    for n in (1, 2, 8, 16, 64, 100, 124, 1024, 4096):
        rows = terms.select("term", term_bucket("term", n).alias("b")).collect()
        assert all(r["b"] == bucket_of(r["term"], n) for r in rows)
    assert "10, 1)" in str(term_bucket("term", 8)._jc.toString())
