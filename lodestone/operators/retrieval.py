"""Ranking documents for a batch of queries.

Every search takes ``queries`` (query_id, query), answers all of them in one job
and returns (query_id, rank, doc_id, title, score).
"""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import (
    BM25_B,
    BM25_K1,
    BM25_K2,
    bm25_idf,
    bm25_term_score,
    cosine_idf,
)
from ..functions.text import term_bucket
from ..plans.ranking import doc_cuts, rank_all_per_query, top_k_per_query
from ..plans.runtime import stored_table
from ..plans.sizing import TASK_ROWS, QueryBatch
from ..plans.skew import salted_join
from .indexing import Index, title_lookup
from .pruning import pruned_bm25
from .queries import query_term_counts

RESULT = ["query_id", "rank", "doc_id", "title", "score"]


def known_terms(batch: QueryBatch, terms: DataFrame, index: Index) -> DataFrame:
    """The rows of (query_id, term, ...) whose term is above the threshold, with df and bucket."""
    if index.n_buckets:
        terms = terms.withColumn("bucket", term_bucket("term", index.n_buckets))
    terms = batch.broadcast_terms(terms)
    if index.increments is None:
        known = index.terms.select("term", "df")
    else:
        known = index.statistics_of(terms).where(F.col("df") > index.min_df).select("term", "df")
    return known.join(terms, "term")


def matching_postings(batch: QueryBatch, terms: DataFrame, index: Index) -> DataFrame:
    """Postings of the queries' terms, with the columns of ``terms`` and ``df``.

    ``terms`` is (query_id, term, ...). It meets the term statistics first, which
    drops unknown and rare terms; what is left picks bucket folders and postings.
    A batch too large to broadcast is joined with salted terms.
    """
    known = known_terms(batch, terms, index)
    keys = ["bucket", "term"] if index.n_buckets else ["term"]
    if not batch.terms_fit:
        return salted_join(index.postings, known, keys, "doc_id")
    return index.postings.join(batch.broadcast_terms(known), keys)


def dealt_postings(batch: QueryBatch, terms: DataFrame, index: Index, facts: DataFrame) -> DataFrame:
    """As ``matching_postings``, joined with the documents' ``facts`` and dealt by document.

    Postings are shuffled once each, however many queries share a term, and meet the queries
    behind the shuffle. The document frequencies add up to the rows that come out; they set the
    number of partitions, so a task's share of (query, document) doesn't grow with the index.
    """
    if not batch.terms_fit:
        return matching_postings(batch, terms, index).join(facts, "doc_id")
    known = stored_table(known_terms(batch, terms, index), "known")
    keys = ["bucket", "term"] if index.n_buckets else ["term"]
    rows = known.agg(F.sum("df")).first()[0] or 0
    parts = max(batch.queries.sparkSession.sparkContext.defaultParallelism, ceil(rows / TASK_ROWS))
    # Spark prunes folders at run time only by a side with a filter of its own.
    wanted = known.where("df > 0").select(*keys).distinct()
    found = index.postings.join(F.broadcast(wanted), keys, "left_semi").select("term", "doc_id", "tf")
    return (
        found.repartition(parts, "doc_id")
        .join(facts.repartition(parts, "doc_id").hint("shuffle_hash"), "doc_id")
        .join(F.broadcast(known.drop("bucket")), "term")
    )


def matching_documents(queries, index: Index) -> DataFrame:
    """Distinct (query_id, doc_id) where the document has a term of the query."""
    batch = QueryBatch.of(queries)
    terms = query_term_counts(batch.queries).select("query_id", "term")
    return matching_postings(batch, terms, index).select("query_id", "doc_id").distinct()


def with_titles(batch: QueryBatch, results: DataFrame, titles: DataFrame, k: int) -> DataFrame:
    return title_lookup(batch.broadcast_results(results, k), titles).select(*RESULT)


def _relevance_order():
    # Rounded, so that the order of summation cannot swap near-ties.
    return [F.desc(F.round("score", 9)), F.asc("pos"), F.asc("doc_id")]


def bm25_top(batch: QueryBatch, body: Index, n, avgdl, k1=BM25_K1, b=BM25_B, k2=BM25_K2,
             k=100) -> DataFrame:
    """(query_id, rank, doc_id, score): best k documents of each query by BM25.

    Postings are dealt by document and stay so through the sum per (query, document)
    (``dealt_postings``). If the index has block bounds, blocks of
    documents that cannot reach a query's k-th score are left out; the result is the same.
    """
    if body.bounds is not None:
        known = known_terms(batch, query_term_counts(batch.queries), body)
        top = pruned_bm25(batch, known, body, n, avgdl, k1, b, k2, k, _relevance_order())
        return top.select("query_id", "rank", "doc_id", "score")
    facts = body.doc_stats.select("doc_id", "dl")
    idf = bm25_idf(F.col("df"), n)
    score = bm25_term_score(idf, F.col("tf"), F.col("dl"), avgdl, k1, b, k2)
    scored = (
        dealt_postings(batch, query_term_counts(batch.queries), body, facts)
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("qtf") * score).alias("score"), F.min("pos").alias("pos"))
    )
    return top_k_per_query(scored, k, _relevance_order(), lead=F.round("score", 9)).select(
        "query_id", "rank", "doc_id", "score"
    )


def search_bm25(queries, body: Index, titles: DataFrame, n, avgdl, k1=BM25_K1, b=BM25_B,
                k2=BM25_K2, k=100) -> DataFrame:
    """BM25 over body text.

    ``n`` is the corpus size and ``avgdl`` the average document length, as
    numbers or as one-value columns (``DataFrame.scalar()``). A repeated query
    word counts each time.
    """
    batch = QueryBatch.of(queries)
    return with_titles(batch, bm25_top(batch, body, n, avgdl, k1, b, k2, k), titles, k)


def search_body(queries, body: Index, titles: DataFrame, k=100) -> DataFrame:
    """TF-IDF cosine over body text.

    A query word occurring m times weighs m squared: each occurrence adds its
    weight times m. The query norm spans all its tokens, indexed or not.
    """
    batch = QueryBatch.of(queries)
    terms = query_term_counts(batch.queries)
    norms = terms.groupBy("query_id").agg(
        F.sqrt(F.sum(F.col("qtf") * F.col("qtf"))).alias("query_norm")
    )
    indexed = body.doc_stats.agg(F.count("*")).scalar()
    weight = F.col("tf") / F.col("dl") * cosine_idf(F.col("df"), indexed)
    scored = (
        dealt_postings(batch, terms, body, body.doc_stats)
        .groupBy("query_id", "doc_id")
        .agg(
            F.sum(weight * F.col("qtf") * F.col("qtf")).alias("dot"),
            F.min("pos").alias("pos"),
            F.first("nf").alias("nf"),
        )
        .join(batch.broadcast_terms(norms), "query_id")
        .select("query_id", "doc_id", "pos",
                (F.col("dot") / F.col("query_norm") / F.sqrt("nf")).alias("score"))
    )
    top = top_k_per_query(scored, k, _relevance_order(), lead=F.round("score", 9))
    return with_titles(batch, top, titles, k)


def query_words(batch: QueryBatch) -> DataFrame:
    """Distinct (query_id, term)."""
    return query_term_counts(batch.queries).select("query_id", "term")


def word_hits(queries, index: Index) -> DataFrame:
    """(query_id, doc_id, score, first_word): distinct query words per document.

    ``first_word`` is the least matching word, which decides ties before doc_id.
    """
    batch = QueryBatch.of(queries)
    return (
        matching_postings(batch, query_words(batch), index)
        .groupBy("query_id", "doc_id")
        .agg(F.count("*").alias("score"), F.min("term").alias("first_word"))
    )


def _cuts(index: Index, cuts) -> list:
    """The given cuts, those that a stored index keeps, or new ones."""
    for known in (cuts, index.cuts):
        if known is not None:
            return known
    return doc_cuts(index.doc_stats)


def search_title(queries, title_index: Index, titles: DataFrame, cuts=None) -> DataFrame:
    """All documents with a query word in the title, by number of distinct words.

    ``cuts`` are document ids that split the ranking work (see ``doc_cuts``),
    taken from the index if not given.
    """
    hits = word_hits(queries, title_index)
    return title_lookup(rank_all_per_query(hits, _cuts(title_index, cuts)), titles).select(*RESULT)


def search_anchor(queries, anchor_index: Index, titles: DataFrame, cuts=None) -> DataFrame:
    """All documents with a query word in incoming link text, by number of distinct words.

    Link targets without a title drop out before ranking.
    """
    hits = title_lookup(word_hits(queries, anchor_index), titles)
    return rank_all_per_query(hits, _cuts(anchor_index, cuts)).select(*RESULT)


def get_pagerank(requests: DataFrame, pagerank: DataFrame) -> DataFrame:
    """Rank of each requested id of (request_id, ids); unknown ids are skipped.

    Order and repeats of a request are kept in ``pos``.
    """
    wanted = requests.select("request_id", F.posexplode("ids").alias("pos", "doc_id"))
    return (
        wanted.join(pagerank, "doc_id")
        .select("request_id", "pos", "doc_id", "pagerank")
        .orderBy("request_id", "pos")
    )


def get_pageview(requests: DataFrame, pageviews: DataFrame) -> DataFrame:
    """Views of each requested id of (request_id, ids); 0 for unknown ids."""
    wanted = requests.select("request_id", F.posexplode("ids").alias("pos", "doc_id"))
    return (
        wanted.join(pageviews, "doc_id", "left")
        .select("request_id", "pos", "doc_id", F.coalesce("views", F.lit(0)).alias("views"))
        .orderBy("request_id", "pos")
    )
