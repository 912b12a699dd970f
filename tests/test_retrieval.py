import pytest
from pyspark.sql import functions as F

from lodestone.operators import hybrid, indexing, retrieval
from lodestone.plans import QueryBatch, rank_all_per_query
from lodestone.sources import read_index, write_index

from . import micro
from .plans import metric, steps


@pytest.fixture(scope="module", params=["derived", "stored"])
def world(request, spark, tmp_path_factory):
    corpus = micro.corpus(spark)
    body = indexing.build_index(corpus.select(F.col("id").alias("doc_id"), "text"), 1)
    title = indexing.build_index(
        corpus.select(F.col("id").alias("doc_id"), F.col("title").alias("text")), 0)
    anchor = indexing.Index.from_postings(indexing.anchor_documents(corpus))
    if request.param == "stored":
        root = tmp_path_factory.mktemp("index")
        stored = []
        for name, index in (("body", body), ("title", title), ("anchor", anchor)):
            write_index(index, f"{root}/{name}", 3)
            stored.append(read_index(spark, f"{root}/{name}"))
        body, title, anchor = stored
    engine = micro.Engine(min_df=1)
    return {
        "body": body, "title": title, "anchor": anchor, "engine": engine,
        "titles": indexing.project_titles(corpus),
        "queries": spark.createDataFrame(micro.QUERIES, "query_id bigint, query string"),
        "pagerank": spark.createDataFrame(micro.PAGERANK, "doc_id bigint, pagerank double"),
        "pageviews": spark.createDataFrame(micro.PAGEVIEWS, "doc_id bigint, views bigint"),
    }


def listed(results):
    out = {}
    for r in sorted(results.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.query_id])
        assert r.title == dict((a[0], a[1]) for a in micro.ARTICLES)[r.doc_id]
    return out


def check(results, expected):
    found = listed(results)
    wanted = {q: expected(text) for q, text in micro.QUERIES}
    assert found.keys() == {q for q, hits in wanted.items() if hits}
    for q, hits in found.items():
        assert [d for d, _ in hits] == [d for d, _ in wanted[q]], q
        assert [s for _, s in hits] == pytest.approx([s for _, s in wanted[q]], abs=1e-9)


def test_bm25(world):
    e = world["engine"]
    check(retrieval.search_bm25(world["queries"], world["body"], world["titles"], e.n, e.avgdl), e.bm25)


def test_body(world):
    check(retrieval.search_body(world["queries"], world["body"], world["titles"]), world["engine"].cosine)


@pytest.mark.parametrize("cuts", [None, [], [2.0, 4.0]])
def test_title(world, cuts):
    e = world["engine"]
    check(retrieval.search_title(world["queries"], world["title"], world["titles"], cuts),
          lambda q: e.matches(q, e.title))


def test_anchor(world):
    e = world["engine"]
    check(retrieval.search_anchor(world["queries"], world["anchor"], world["titles"]),
          lambda q: e.matches(q, e.anchor, titled=True))


def indexes(world):
    e = world["engine"]
    return hybrid.Indexes(world["body"], world["title"], world["anchor"], e.n, e.avgdl)


def test_hybrid(world):
    check(hybrid.search(world["queries"], indexes(world), world["titles"], world["pagerank"],
                        world["pageviews"]), world["engine"].hybrid)


def test_average_length(world):
    avg = indexing.avg_doc_length(world["body"], world["title"], world["anchor"], 7)
    assert avg.first()["avgdl"] == pytest.approx(world["engine"].avgdl)


def test_batch_equals_single_queries(world):
    e = world["engine"]
    args = (world["body"], world["titles"], e.n, e.avgdl)
    together = listed(retrieval.search_bm25(world["queries"], *args))
    for q in (1, 7):
        alone = listed(retrieval.search_bm25(world["queries"].where(f"query_id = {q}"), *args))
        assert [d for d, _ in alone[q]] == [d for d, _ in together[q]]
        assert [s for _, s in alone[q]] == pytest.approx([s for _, s in together[q]])


def test_unbounded_batches_are_not_broadcast(world):
    """Above the size limit the same results come from shuffled joins."""
    e = world["engine"]
    batch = QueryBatch(world["queries"], max_rows=1)
    assert not batch.terms_fit
    check(retrieval.search_bm25(batch, world["body"], world["titles"], e.n, e.avgdl), e.bm25)
    check(hybrid.search(batch, indexes(world), world["titles"], world["pagerank"],
                        world["pageviews"]), e.hybrid)


def test_batches_are_measured_in_tokens(spark):
    """Two million short queries have too many terms for a broadcast, whatever their letters."""
    many = spark.range(2_000_000).select(
        F.col("id").alias("query_id"), F.concat(F.lit("tea "), F.col("id").cast("string")).alias("query"))
    assert not QueryBatch(many).terms_fit
    long = spark.createDataFrame([(1, "tea " * 600), (2, None)], "query_id bigint, query string")
    assert QueryBatch(long, max_rows=600).terms_fit and not QueryBatch(long, max_rows=599).terms_fit


def test_scores_worked_out_by_hand(world):
    """Query 8, "cherry unknownword": cherry is once in documents 1 and 3, each 5 words long.

    The mean length is 26 / 7 (longest fields 5, 5, 5, 3, 3 and 5 words over 7 articles).
    BM25: ln(1 + 5.5 / 2.5) = 1.163151 times the length-normalised tf. Cosine: 1 / 5 * log2(6 / 2)
    over the query's norm, the root of 2, and the documents' norms, the roots of 11 and 7.
    """
    e = world["engine"]
    assert e.avgdl == pytest.approx(26 / 7)
    bm25 = listed(retrieval.search_bm25(world["queries"], world["body"], world["titles"], e.n, e.avgdl))
    assert bm25[8] == [(1, pytest.approx(1.006387, abs=1e-6)), (3, pytest.approx(1.006387, abs=1e-6))]
    body = listed(retrieval.search_body(world["queries"], world["body"], world["titles"]))
    assert body[8] == [(3, pytest.approx(0.084720, abs=1e-6)), (1, pytest.approx(0.067583, abs=1e-6))]


def test_matching_documents(world):
    rows = retrieval.matching_documents(world["queries"], world["body"]).collect()
    assert sorted(r.doc_id for r in rows if r.query_id == 1) == [1, 3, 5]


def test_id_lookups(spark, world):
    requests = spark.createDataFrame([(1, [5, 1, 99, 1]), (2, [])], "request_id int, ids array<bigint>")
    ranks = retrieval.get_pagerank(requests, world["pagerank"]).collect()
    assert [(r.pos, r.doc_id, r.pagerank) for r in ranks] == [(0, 5, 0.9), (1, 1, 0.4), (3, 1, 0.4)]
    views = retrieval.get_pageview(requests, world["pageviews"]).collect()
    assert [(r.doc_id, r.views) for r in views] == [(5, 0), (1, 1), (99, 0), (1, 1)]


def test_rank_all_blocks_do_not_change_ranks(spark):
    hits = spark.range(2000).select(
        F.lit(1).alias("query_id"), (F.col("id") * 7919 % 100003).alias("doc_id"),
        (F.col("id") % 3).alias("score"),
        F.concat(F.lit("w"), (F.col("id") % 5).cast("string")).alias("first_word"))
    key = lambda r: (-r.score, r.first_word, r.doc_id)
    expected = {r.doc_id: i + 1 for i, r in enumerate(sorted(hits.collect(), key=key))}
    for cuts in ([], [100.0, 5000.0, 5001.0, 90000.0]):
        ranked = rank_all_per_query(hits, cuts).collect()
        assert {r.doc_id: r.rank for r in ranked} == expected


def test_prior_factors(spark):
    rows = [(None, None), (0.3, 0), (1.0, 1), (5.0, 2), (10.0, 3), (1000.0, 1024), (99.9, 2047)]
    df = hybrid.prior_boost(spark.createDataFrame(rows, "pagerank double, views bigint"))
    assert [(r.pr, r.pv) for r in df.collect()] == [
        (1.0, 2.0), (0.3, 2.0), (1.0, 1.0), (0.0, 1.0), (1.0, 1.0), (3.0, 10.0), (1.0, 10.0)]


def test_hot_term_is_split_in_a_shuffled_join(spark):
    """A term with 80 % of the postings, met by a batch too large to broadcast."""
    postings = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("term"), "id")).alias("term"),
        F.col("id").alias("doc_id"), F.lit(1).cast("bigint").alias("tf")).repartition(8)
    index = indexing.Index.from_postings(postings, 1)
    batch = QueryBatch(spark.createDataFrame(
        [(1, "hot term9"), (2, "term19 cold")], "query_id bigint, query string"), max_rows=1)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for found in (
            retrieval.matching_postings(batch, retrieval.query_words(batch), index),
            index.retained,
            indexing.prune_rare_terms(postings, 1),
        ):
            sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 160_000
            assert len(sizes) > 4 and max(sizes) < 80_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["bm25", "cosine"])
def test_postings_are_dealt_once_however_many_queries_share_a_term(spark, kind, monkeypatch):
    """A task's pairs are bounded by its partition, whose number follows the document frequencies."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.lit("common"), F.concat(F.lit("other"), F.col("id") % 2),
        F.array_join(F.array_repeat(F.lit("filler"), (F.col("id") % 7).cast("int")), " ")).alias("text"))
    index = indexing.build_index(docs, 1)
    queries = spark.range(60).select(F.col("id").alias("query_id"), F.lit("common other1 filler").alias("query"))
    monkeypatch.setattr(retrieval, "TASK_ROWS", 5000)
    titles = docs.select("doc_id", F.lit("t").alias("title"))
    found = (retrieval.search_bm25(queries, index, titles, 400, 3.0, k=5) if kind == "bm25"
             else retrieval.search_body(queries, index, titles, k=5))
    rows = found.collect()
    assert len(rows) == 300 and len({(r.rank, r.doc_id, r.score) for r in rows}) == 5
    # 400 "common", 200 "other1" and 342 "filler" postings, 60 queries each: 56,520 rows.
    dealt = [s for s in steps(found, "ShuffleExchangeExec") if "BY_NUM" in s.shuffleOrigin().toString()]
    assert max(metric(s, "shuffleRecordsWritten") for s in dealt) == 942
    assert {s.numPartitions() for s in dealt} == {12}
    assert all(metric(s, "shuffleRecordsWritten") < 60 * 400 for s in steps(found, "ShuffleExchangeExec"))
