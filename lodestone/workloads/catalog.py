"""Every operator as a query over the test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources as io
from ..functions.stopwords import index_stopwords, query_stopwords
from ..functions.text import (
    is_question,
    is_short_query,
    remove_stopwords,
    term_bucket,
    tokenize,
)
from ..operators import evaluation as ev
from ..operators import graph as gr
from ..operators import hybrid as hy
from ..operators import indexing as ix
from ..operators import queries as qs
from ..operators import retrieval as rt
from ..plans.ranking import top_k_per_query
from ..plans.runtime import hadoop_path
from ..plans.sizing import QueryBatch
from . import fixtures as fx
from .fixtures import (
    BODY_MIN_DF,
    LOOKED_UP,
    N_BUCKETS,
    TITLE_MIN_DF,
    TUNED,
    Workspace,
    table,
)

SPAN = 256
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def _documents(spark, sf):
    """Ids and texts of the stored corpus, which lies in several files."""
    return Workspace(spark, sf).corpus.select(F.col("id").alias("doc_id"), "text")


def _rounded(df: DataFrame, *columns, digits=6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Scans, sources and sinks


def _mixed_corpus(spark, sf, name, below=""):
    """The stored corpus next to files that do not belong to it."""
    work = Workspace(spark, sf)
    root = work.folder(name, lambda path: (
        work.corpus.write.mode("overwrite").parquet(f"{path}/articles"),
        work.corpus.write.mode("overwrite").parquet(f"{path}/pr_old"),
        table(spark, sf, "labels").write.mode("overwrite").parquet(f"{path}/postings_title"),
    ))
    corpus = io.read_corpus(spark, root + below, exclude=["pr*", "postings_*", "*/_SUCCESS"])
    ids = F.transform("anchor_text", lambda a: a["id"].cast("string"))
    return corpus.select("id", "title", "text", F.array_join(ids, " ").alias("targets"))


@query
def read_corpus(spark, sf):
    return _mixed_corpus(spark, sf, "mixed")


@query
def read_corpus_glob(spark, sf):
    """The same through a wildcard, below a folder with a blank in its name."""
    return _mixed_corpus(spark, sf, "mixed files", "/*")


@query
def corpus_count(spark, sf):
    return io.corpus_count(Workspace(spark, sf).corpus)


@query
def project_field(spark, sf):
    return io.project_field(Workspace(spark, sf).corpus, "title")


@query
def read_pageview_dump(spark, sf):
    return io.read_pageview_dump(spark, _dump(spark, sf)).groupBy("value").agg(
        F.count("*").alias("n"))


def _dump(spark, sf):
    return Workspace(spark, sf).folder("dump", lambda path: (
        fx.pageview_lines(spark, sf).write.mode("overwrite")
        .option("compression", "bzip2").text(path)))


@query
def write_rank_csv(spark, sf):
    work = Workspace(spark, sf)
    path = work.folder("rank_csv", lambda p: io.write_rank_csv(work.pagerank, p))
    return _rounded(io.read_rank_csv(spark, path), "pagerank")


@query
def read_rank_csv(spark, sf):
    """Number and total of the ranks read back, and those of documents above 1."""
    work = Workspace(spark, sf)
    path = work.folder("rank_csv", lambda p: io.write_rank_csv(work.pagerank, p))
    ranks = io.read_rank_csv(spark, path)
    return _rounded(ranks.agg(
        F.count("*").alias("n"), F.sum("pagerank").alias("total"),
        F.count_if(F.col("pagerank") > 1).alias("above")), "total", digits=4)


def _stored_views(spark, sf):
    work = Workspace(spark, sf)
    return work.folder("views", lambda p: io.write_pageviews(work.pageviews, p))


@query
def write_pageviews(spark, sf):
    return io.read_pageviews(spark, _stored_views(spark, sf))


@query
def read_pageviews(spark, sf):
    views = io.read_pageviews(spark, _stored_views(spark, sf))
    return views.agg(F.count("*").alias("articles"), F.sum("views").alias("views"))


@query
def read_qrels(spark, sf):
    work = Workspace(spark, sf)
    judged = work.qrels.join(work.queries, "query_id").select("query", "doc_id")
    path = work.folder("qrels_json", lambda p: io.write_qrels(judged, p, SPAN))
    return io.read_qrels(spark, path)


@query
def write_index(spark, sf):
    return Workspace(spark, sf).body.retained.select("term", "doc_id", "tf")


def _index_rows(index):
    """All three tables of an index, one kind of row each."""
    postings = index.retained.select(
        F.lit("posting").alias("kind"), F.col("term").alias("name"), "doc_id",
        F.col("tf").alias("first"), F.lit(None).cast("bigint").alias("second"))
    none = F.lit(None)
    terms = index.terms.select(F.lit("term"), "term", none.cast("bigint"), "df", "cf")
    docs = index.doc_stats.select(F.lit("doc"), none.cast("string"), "doc_id", "dl", "nf")
    return postings.union(terms).union(docs)


@query
def read_index(spark, sf):
    return _index_rows(Workspace(spark, sf).title)


def _statistics(index):
    terms = index.terms.select(
        F.lit("term").alias("kind"), F.col("term").alias("name"),
        F.col("df").alias("first"), F.col("cf").alias("second"))
    docs = index.doc_stats.select(
        F.lit("doc"), F.col("doc_id").cast("string"), "dl", "nf")
    return terms.union(docs)


@query
def save_global_stats(spark, sf):
    return _statistics(Workspace(spark, sf).body)


@query
def delete_index(spark, sf):
    """Stores a second title index, counts its postings, deletes it, counts what is left."""
    work = Workspace(spark, sf)
    path = work.path + "/title_copy"
    stored = io.write_index(
        ix.Index(work.title.postings, None, None, work.title.min_df), path, N_BUCKETS)
    counted = stored.retained.agg(F.count("*").alias("postings")).checkpoint()
    io.delete_index(spark, path)
    folder, files = hadoop_path(spark, path)
    left = files.exists(folder)
    return counted.withColumn("left_over", F.lit(int(left)).cast("bigint"))


def _as_text(blocks):
    entries = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"], p["tf"]))
    return blocks.select("term", "block", F.array_join(entries, " ").alias("postings"))


@query
def scan_postings(spark, sf):
    return _as_text(ix.scan_postings(Workspace(spark, sf).body, SPAN))


@query
def lookup_postings(spark, sf):
    work = Workspace(spark, sf)
    return ix.lookup_postings(work.body, qs.query_term_counts(work.queries))


@query
def lookup_postings_list(spark, sf):
    """The literal form: some frequent words, a rare one and one that no text has."""
    return ix.lookup_postings(Workspace(spark, sf).body, LOOKED_UP)


@query
def show_top_ranks(spark, sf):
    ranks = Workspace(spark, sf).pagerank.withColumn("pagerank", F.round("pagerank", 9))
    return _rounded(io.show_top_ranks(ranks), "pagerank")


# Text and queries


def _token_rows(spark, sf):
    return _documents(spark, sf).select("doc_id", F.explode(tokenize("text")).alias("term"))


@query
def tokenize_text(spark, sf):
    """Counts per (term, document) first, so that a term found everywhere is not gathered."""
    per_doc = _token_rows(spark, sf).groupBy("term", "doc_id").agg(F.count("*").alias("tf"))
    return per_doc.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("docs"))


REGISTRY["tokenize"] = REGISTRY.pop("tokenize_text")


def _stopword_counts(spark, sf, words):
    return (
        _token_rows(spark, sf).where(F.col("term").isin(words))
        .groupBy("term").agg(F.count("*").alias("n"))
    )


REGISTRY["index_stopwords"] = lambda spark, sf: _stopword_counts(spark, sf, index_stopwords())
REGISTRY["query_stopwords"] = lambda spark, sf: _stopword_counts(spark, sf, query_stopwords())


def _remove_stopwords(spark, sf):
    return _documents(spark, sf).withColumn("tokens", tokenize("text")).select(
        "doc_id",
        F.size(remove_stopwords("tokens", index_stopwords())).alias("kept"),
        F.size("tokens").alias("total"))


REGISTRY["remove_stopwords"] = _remove_stopwords


@query
def tokenize_query(spark, sf):
    return qs.tokenize_query(fx.queries(spark, sf)).select(
        "query_id", F.posexplode("tokens").alias("pos", "token"))


@query
def query_term_counts(spark, sf):
    return qs.query_term_counts(fx.queries(spark, sf))


def _term_bucket(spark, sf):
    return ix.term_occurrences(_documents(spark, sf)).select("term").distinct().withColumn(
        "bucket", term_bucket("term"))


REGISTRY["term_bucket"] = _term_bucket


@query
def parse_pageview_line(spark, sf):
    return io.parse_pageview_line(io.read_pageview_dump(spark, _dump(spark, sf)))


def _is_question(spark, sf):
    return fx.queries(spark, sf).select(
        "query_id", is_question("query").alias("question"), is_short_query("query").alias("short"))


REGISTRY["is_question"] = _is_question


@query
def is_question_words(spark, sf):
    """Questions by their first word as well, and the weights that follow."""
    asked = fx.worded_questions(spark, sf)
    weights = qs.query_weights(asked, question_words=True)
    return asked.select(
        "query_id", is_question("query", question_words=True).alias("question")
    ).join(weights, "query_id")


def _is_short_query(spark, sf):
    return fx.queries(spark, sf).where(is_short_query("query"))


REGISTRY["is_short_query"] = _is_short_query


@query
def query_nonempty(spark, sf):
    return qs.query_nonempty(fx.queries(spark, sf))


# Index construction


@query
def term_frequencies(spark, sf):
    return ix.term_frequencies(_documents(spark, sf))


@query
def posting_lists(spark, sf):
    return _as_text(ix.posting_lists(ix.term_frequencies(_documents(spark, sf)), SPAN))


@query
def prune_rare_terms(spark, sf):
    return ix.prune_rare_terms(ix.term_frequencies(_documents(spark, sf)), BODY_MIN_DF)


@query
def document_frequency(spark, sf):
    return ix.document_frequency(ix.term_frequencies(_documents(spark, sf)))


@query
def partition_postings(spark, sf):
    return ix.partition_postings(Workspace(spark, sf).body.retained)


@query
def doc_length(spark, sf):
    return ix.doc_length(Workspace(spark, sf).body.retained)


@query
def doc_norm(spark, sf):
    return ix.doc_norm(Workspace(spark, sf).body.retained)


@query
def collection_frequency(spark, sf):
    return ix.collection_frequency(ix.term_frequencies(_documents(spark, sf)))


@query
def raw_doc_length(spark, sf):
    return ix.raw_doc_length(_documents(spark, sf).withColumn("tokens", tokenize("text")))


@query
def index_from_tokens(spark, sf):
    """Whitespace-separated words as given tokens."""
    words = F.split(F.trim(F.lower("text")), r"\s+")
    docs = _documents(spark, sf).select("doc_id", words.alias("tokens"))
    return _index_rows(ix.index_from_tokens(docs, TITLE_MIN_DF))


def _labelled_first(spark, sf, name):
    """A stored index of the labelled documents, and all others as a batch to add."""
    work = Workspace(spark, sf)
    docs = _documents(spark, sf).withColumn(
        "tokens", remove_stopwords(tokenize("text"), index_stopwords()))
    labelled = table(spark, sf, "labels").select("doc_id")
    first = ix.index_from_tokens(docs.join(labelled, "doc_id", "left_semi"), BODY_MIN_DF)
    path = work.folder(name, lambda p: io.write_index(first, p, N_BUCKETS))
    return path, docs.join(labelled, "doc_id", "left_anti")


@query
def add_documents(spark, sf):
    path, rest = _labelled_first(spark, sf, "labelled")
    return _statistics(ix.add_documents(io.read_index(spark, path), rest))


@query
def append_index(spark, sf):
    """The same, added to the stored index; its postings and statistics as read back."""
    work = Workspace(spark, sf)

    def build(path):
        first, rest = _labelled_first(spark, sf, "labelled")
        old = io.read_index(spark, first)
        io.write_index(ix.Index(old.postings, None, None, old.min_df), path, N_BUCKETS)
        io.append_index(spark, path, rest)

    return _index_rows(io.read_index(spark, work.folder("appended", build)))


@query
def compact_index(spark, sf):
    """The same in three additions, then merged into one segment."""
    work = Workspace(spark, sf)

    def build(path):
        first, rest = _labelled_first(spark, sf, "labelled")
        old = io.read_index(spark, first)
        io.write_index(ix.Index(old.postings, None, None, old.min_df), path, N_BUCKETS)
        for part in range(3):
            io.append_index(spark, path, rest.where(F.pmod("doc_id", F.lit(3)) == part))
        io.compact_index(spark, path)

    return _index_rows(io.read_index(spark, work.folder("compacted", build)))


@query
def avg_doc_length(spark, sf):
    work = Workspace(spark, sf)
    return _rounded(ix.avg_doc_length(work.body, work.title, work.anchor, work.n), "avgdl")


@query
def title_lookup(spark, sf):
    work = Workspace(spark, sf)
    return ix.title_lookup(work.body.doc_stats.select("doc_id", "dl"), work.titles)


@query
def explode_anchors(spark, sf):
    return ix.explode_anchors(Workspace(spark, sf).corpus)


@query
def anchor_documents(spark, sf):
    return ix.anchor_documents(Workspace(spark, sf).corpus)


# Ranking and lookup


@query
def search_bm25(spark, sf):
    work = Workspace(spark, sf)
    return _rounded(
        rt.search_bm25(work.queries, work.body, work.titles, work.n, work.avgdl), "score")


@query
def search_bm25_blocks(spark, sf):
    """The same over an index with bounds for blocks of 32 documents."""
    work = Workspace(spark, sf)

    def build(path):
        io.index_documents(fx.bodies(work.corpus), path, BODY_MIN_DF, n_buckets=N_BUCKETS)
        io.write_bounds(spark, path, bits=5)

    body = io.read_index(spark, work.folder("body_blocks", build))
    return _rounded(
        rt.search_bm25(work.queries, body, work.titles, work.n, work.avgdl), "score")


@query
def search_bm25_tuned(spark, sf):
    """Other constants than the customary ones, and a shorter list."""
    work = Workspace(spark, sf)
    found = rt.search_bm25(work.queries, work.body, work.titles, work.n, work.avgdl, k=20, **TUNED)
    return _rounded(found, "score")


@query
def search_body(spark, sf):
    work = Workspace(spark, sf)
    return _rounded(rt.search_body(work.queries, work.body, work.titles), "score")


@query
def search_title(spark, sf):
    work = Workspace(spark, sf)
    return rt.search_title(work.queries, work.title, work.titles)


@query
def search_anchor(spark, sf):
    work = Workspace(spark, sf)
    return rt.search_anchor(work.queries, work.anchor, work.titles)


@query
def search(spark, sf):
    work = Workspace(spark, sf)
    return _rounded(hy.search(
        work.queries, work.indexes, work.titles, work.pagerank, work.pageviews), "score")


@query
def query_weights(spark, sf):
    return qs.query_weights(fx.queries(spark, sf))


@query
def prior_boost(spark, sf):
    work = Workspace(spark, sf)
    priors = work.pagerank.join(work.pageviews, "doc_id", "left")
    return _rounded(hy.prior_boost(priors), "pr").select("doc_id", "pr", "pv")


def _top_k_per_query(spark, sf):
    work = Workspace(spark, sf)
    hits = rt.word_hits(work.queries, work.title)
    order = [F.desc("score"), F.asc("first_word"), F.asc("doc_id")]
    return top_k_per_query(hits, 10, order).select("query_id", "doc_id", "rank")


REGISTRY["top_k_per_query"] = _top_k_per_query


@query
def top_k_per_query_5000(spark, sf):
    """A list longer than Spark's own limit per task."""
    work = Workspace(spark, sf)
    hits = rt.word_hits(work.queries, work.body)
    order = [F.desc("score"), F.asc("first_word"), F.asc("doc_id")]
    return top_k_per_query(hits, 5000, order, lead=F.col("score")).select("query_id", "doc_id", "rank")


@query
def reciprocal_rank_score(spark, sf):
    work = Workspace(spark, sf)
    batch = QueryBatch(work.queries)
    top = rt.bm25_top(batch, work.body, work.n, work.avgdl).join(
        batch.broadcast_terms(qs.query_weights(batch.queries)), "query_id")
    return _rounded(hy.reciprocal_rank_score(top, F.col("x")), "score").select(
        "query_id", "doc_id", "score")


@query
def membership_bonus(spark, sf):
    work = Workspace(spark, sf)
    batch = QueryBatch(work.queries)
    hits = rt.word_hits(batch, work.title).join(
        batch.broadcast_terms(qs.query_weights(batch.queries)), "query_id")
    return hy.membership_bonus(hits, F.col("y")).select("query_id", "doc_id", "score")


def _requests(work):
    """The link targets of each article, an unknown id, and the article itself twice."""
    targets = F.transform("anchor_text", lambda a: a["id"])
    return work.corpus.select(
        F.col("id").alias("request_id"),
        F.concat(targets, F.array(F.lit(-1).cast("bigint"), "id", "id")).alias("ids"))


@query
def get_pagerank(spark, sf):
    work = Workspace(spark, sf)
    return _rounded(rt.get_pagerank(_requests(work), work.pagerank), "pagerank")


@query
def get_pageview(spark, sf):
    work = Workspace(spark, sf)
    return rt.get_pageview(_requests(work), work.pageviews)


@query
def matching_documents(spark, sf):
    work = Workspace(spark, sf)
    return rt.matching_documents(work.queries, work.body)


# Link graph and page views


@query
def link_edges(spark, sf):
    return gr.link_edges(Workspace(spark, sf).corpus)


@query
def link_vertices(spark, sf):
    return gr.link_vertices(Workspace(spark, sf).corpus)


@query
def link_graph(spark, sf):
    edges, vertices = gr.link_graph(Workspace(spark, sf).corpus)
    none = F.lit(None).cast("bigint").alias("dst")
    return edges.select(F.lit("edge").alias("kind"), "src", "dst").union(
        vertices.select(F.lit("vertex"), "id", none))


@query
def pagerank(spark, sf):
    return _rounded(gr.pagerank(*gr.link_graph(Workspace(spark, sf).corpus)), "pagerank")


@query
def pagerank_10(spark, sf):
    return _rounded(
        gr.pagerank(*gr.link_graph(Workspace(spark, sf).corpus), iters=10), "pagerank")


@query
def pagerank_purchases(spark, sf):
    return _rounded(gr.pagerank(fx.purchase_graph(spark, sf)), "pagerank")


@query
def partition_graph(spark, sf):
    return gr.partition_graph(fx.purchase_graph(spark, sf), 8)


@query
def sort_ranks(spark, sf):
    ranks = Workspace(spark, sf).pagerank.withColumnRenamed("doc_id", "id")
    return _rounded(gr.sort_ranks(ranks), "pagerank")


@query
def pageviews_by_article(spark, sf):
    lines = io.read_pageview_dump(spark, _dump(spark, sf))
    return io.pageviews_by_article(io.parse_pageview_line(lines))


# Evaluation


def _evaluated(work):
    return ev.evaluate_queries(work.queries, work.qrels, work.indexes, work.titles,
                               work.pagerank, work.pageviews)


@query
def average_precision(spark, sf):
    work = Workspace(spark, sf)
    batch = QueryBatch(work.queries)
    results = hy.search(batch, work.indexes, work.titles, work.pagerank, work.pageviews)
    return ev.average_precision(results, work.qrels, batch.queries)


@query
def mean_average_precision(spark, sf):
    return _rounded(ev.mean_average_precision(_evaluated(Workspace(spark, sf))), "map")


@query
def evaluate_queries(spark, sf):
    return _evaluated(Workspace(spark, sf))


def _sweep(work, params):
    return _rounded(
        ev.parameter_sweep(work.features, work.queries, work.qrels, params), "total_ap")


@query
def parameter_sweep(spark, sf):
    return _sweep(Workspace(spark, sf), ev.random_parameters(spark, 100, 7, end_points=True))


@query
def random_parameters(spark, sf):
    params = ev.random_parameters(spark, 20, 7)
    names = [c for c in params.columns if c != "param_id"]
    return _rounded(_sweep(Workspace(spark, sf), params).join(params, "param_id"), *names)


@query
def parameter_starts(spark, sf):
    return _sweep(Workspace(spark, sf), ev.parameter_starts(spark))


@query
def best_parameters(spark, sf):
    params = ev.random_parameters(spark, 100, 7, end_points=True)
    return ev.best_parameters(_sweep(Workspace(spark, sf), params))
