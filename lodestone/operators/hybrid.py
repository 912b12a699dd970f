"""Hybrid search: BM25 rank, title and anchor hits, PageRank and page views."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import DEFAULT_WEIGHTS, Weights, pagerank_factor, pageview_factor
from ..plans.ranking import top_k_per_query
from ..plans.sizing import QueryBatch
from .indexing import Index
from .queries import query_weights
from .retrieval import bm25_top, matching_postings, query_words, with_titles


@dataclass(frozen=True)
class Indexes:
    """What a hybrid search reads: three indexes, corpus size and mean length."""

    body: Index
    title: Index
    anchor: Index
    n: object
    avgdl: object


def reciprocal_rank_score(df: DataFrame, x) -> DataFrame:
    """Add ``score`` = x / rank."""
    return df.withColumn("score", x / F.col("rank"))


def membership_bonus(df: DataFrame, y) -> DataFrame:
    """Add ``score`` = y, whatever the rank."""
    return df.withColumn("score", F.lit(y) if not hasattr(y, "alias") else y)


def prior_boost(df: DataFrame) -> DataFrame:
    """Add the factors ``pr`` and ``pv`` of (pagerank, views)."""
    return df.withColumns({
        "pr": pagerank_factor(F.col("pagerank")), "pv": pageview_factor(F.col("views")),
    })


def fusion_features(queries, indexes: Indexes, titles: DataFrame, pagerank: DataFrame,
                    pageviews: DataFrame, depth=100) -> DataFrame:
    """One row per candidate (query_id, doc_id) with all that the fusion needs.

    The three sources are stacked as raw matches and grouped once. Partitioning
    by document serves the grouping and every join that follows.
    """
    batch = QueryBatch.of(queries)
    none = F.lit(None)
    body = bm25_top(batch, indexes.body, indexes.n, indexes.avgdl, k=depth).select(
        "query_id", "doc_id", F.col("rank").alias("bm25_rank"),
        none.cast("string").alias("title_word"), none.cast("string").alias("anchor_word"),
    )
    words = query_words(batch)
    title = matching_postings(batch, words, indexes.title).select(
        "query_id", "doc_id", none.cast("int").alias("bm25_rank"),
        F.col("term").alias("title_word"), none.cast("string").alias("anchor_word"),
    )
    anchor = matching_postings(batch, words, indexes.anchor).select(
        "query_id", "doc_id", none.cast("int").alias("bm25_rank"),
        none.cast("string").alias("title_word"), F.col("term").alias("anchor_word"),
    )
    grouped = (
        body.unionByName(title).unionByName(anchor)
        .repartition("doc_id")
        .groupBy("query_id", "doc_id")
        .agg(
            F.max("bm25_rank").alias("bm25_rank"),
            F.count("title_word").alias("title_words"),
            F.min("title_word").alias("title_first"),
            F.count("anchor_word").alias("anchor_words"),
            F.min("anchor_word").alias("anchor_first"),
        )
    )
    return prior_boost(
        grouped.join(titles.select("doc_id"), "doc_id", "left_semi")
        .join(pagerank, "doc_id", "left")
        .join(pageviews, "doc_id", "left")
    )


def fusion_score(x, y, anchor_bonus, pagerank_scale, pageview_scale):
    """Fused score of a feature row."""
    zero = F.lit(0.0)
    fused = (
        F.coalesce(x / F.col("bm25_rank"), zero)
        + F.when(F.col("title_words") > 0, y).otherwise(zero)
        + F.when(F.col("anchor_words") > 0, anchor_bonus).otherwise(zero)
    )
    return fused * pagerank_scale * F.col("pr") * pageview_scale * F.col("pv")


def fusion_order():
    """Score first; ties in the order BM25 hits, title hits, anchor hits were found."""
    in_title = F.col("title_words") > 0
    return [
        F.desc(F.round("score", 9)),
        F.asc_nulls_last("bm25_rank"),
        F.desc("title_words"),
        F.asc_nulls_last("title_first"),
        F.asc_nulls_last(F.when(in_title, F.col("doc_id"))),
        F.desc("anchor_words"),
        F.asc_nulls_last("anchor_first"),
        F.asc("doc_id"),
    ]


def search(queries, indexes: Indexes, titles: DataFrame, pagerank: DataFrame,
           pageviews: DataFrame, weights: Weights = DEFAULT_WEIGHTS,
           question_words=False, k=100) -> DataFrame:
    """Hybrid ranking of a batch of queries.

    A query ending in '?' trusts the BM25 rank more, a query of under four
    characters its title hits.
    """
    batch = QueryBatch.of(queries)
    features = fusion_features(batch, indexes, titles, pagerank, pageviews)
    per_query = query_weights(batch.queries, weights, question_words)
    scored = features.join(batch.broadcast_terms(per_query), "query_id").withColumn(
        "score",
        fusion_score(F.col("x"), F.col("y"), F.lit(weights.anchor_bonus),
                     F.lit(weights.pagerank_scale), F.lit(weights.pageview_scale)),
    )
    top = top_k_per_query(scored, k, fusion_order(), lead=F.round("score", 9))
    return with_titles(batch, top, titles, k)
