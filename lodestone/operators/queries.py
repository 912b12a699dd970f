"""Turning a batch of query strings into terms."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import DEFAULT_WEIGHTS, Weights
from ..functions.stopwords import query_stopwords
from ..functions.text import is_question, is_short_query, remove_stopwords, tokenize


def query_nonempty(queries: DataFrame, stopwords=None) -> DataFrame:
    """Queries that are not empty and keep at least one token."""
    words = query_stopwords() if stopwords is None else stopwords
    return queries.where(
        (F.length("query") > 0) & (F.size(remove_stopwords(tokenize("query"), words)) > 0)
    )


def tokenize_query(queries: DataFrame, stopwords=None) -> DataFrame:
    """Add the array ``tokens``: the query's tokens without query stopwords."""
    words = query_stopwords() if stopwords is None else stopwords
    return queries.withColumn("tokens", remove_stopwords(tokenize("query"), words))


def query_term_counts(queries: DataFrame, stopwords=None) -> DataFrame:
    """(query_id, term, qtf, pos): multiplicity and first position of each term."""
    words = query_stopwords() if stopwords is None else stopwords
    tokens = tokenize_query(queries, words)
    return (
        tokens.select("query_id", F.posexplode("tokens").alias("at", "term"))
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf"), F.min("at").alias("pos"))
    )


def query_weights(queries: DataFrame, weights: Weights = DEFAULT_WEIGHTS,
                  question_words: bool = False) -> DataFrame:
    """(query_id, x, y): rank weight and title bonus of each query."""
    return queries.select(
        "query_id",
        F.when(is_question("query", question_words), F.lit(weights.rank_decay_question))
        .otherwise(F.lit(weights.rank_decay)).alias("x"),
        F.when(is_short_query("query"), F.lit(weights.title_bonus_short))
        .otherwise(F.lit(weights.title_bonus)).alias("y"),
    )
