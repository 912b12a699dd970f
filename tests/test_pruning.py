"""Searches that leave out blocks: the same rows from fewer postings."""

import pytest
from pyspark.sql import functions as F

from lodestone.operators import pruning, retrieval
from lodestone.plans import QueryBatch, scratch_scope
from lodestone.plans.runtime import stored_table
from lodestone.sources import append_index, index_documents, read_index, write_bounds

from .plans import metric, shuffled_rows, steps

PAGE_ROWS = "parquet.page.row.count.limit"
N = 24_000


def documents(spark, low=0, high=N):
    """Every text has the word "common", at a frequency and in a company that vary."""
    i = F.col("id")
    own = F.array_repeat(F.lit("common"), (1 + F.pmod(F.xxhash64(i), F.lit(97)) % 5).cast("int"))
    rest = F.transform(F.sequence(F.lit(1), (5 + F.pmod(F.xxhash64(i + 1), F.lit(400))).cast("int")),
                       lambda k: F.concat(F.lit("filler"), (k * i) % 50))
    some = F.when(i % 40 == 7, F.array(F.lit("seldom"))).otherwise(F.array().cast("array<string>"))
    twice = F.when(i % 900 == 1, F.array_repeat(F.lit("common"), 30)).otherwise(F.array().cast("array<string>"))
    return spark.range(low, high).select(i.alias("doc_id"), F.concat(own, rest, some, twice).alias("tokens"))


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(PAGE_ROWS, "256")
    try:
        path = f"{tmp_path_factory.mktemp('pruned')}/i"
        index_documents(documents(spark), path, 3, n_buckets=4)
        write_bounds(spark, path, bits=8)
        yield path
    finally:
        conf.unset(PAGE_ROWS)


def plain(index):
    return type(index)(**{**index.__dict__, "bounds": None, "block_bits": None})


QUERIES = [(1, "common"), (2, "common seldom"), (3, "seldom seldom filler7"), (4, "nothing"), (5, ""),
           (6, "common common seldom filler1 filler2 filler3"), (7, "filler11")]


@pytest.mark.parametrize("constants", [{}, {"k1": 2.0, "b": 0.0, "k2": 0.5}, {"k": 3}, {"k": 30_000}])
def test_pruned_search_equals_the_whole(spark, path, constants):
    index = read_index(spark, path)
    batch = QueryBatch.of(spark.createDataFrame(QUERIES, "query_id bigint, query string"))
    k = constants.get("k", 100)
    options = {"k1": 1.0, "b": 0.9, "k2": 10.0, **constants, "k": k}

    def found(index):
        return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 9))
                      for r in retrieval.bm25_top(batch, index, N, 200.0, **options).collect())

    whole = found(plain(index))
    assert found(index) == whole and {q for q, *_ in whole} == {1, 2, 3, 6, 7}


def test_frequent_words_are_partly_read(spark, path):
    index = read_index(spark, path)
    batch = QueryBatch.of(spark.createDataFrame([(1, "common")], "query_id bigint, query string"))
    top = retrieval.bm25_top(batch, index, N, 200.0, k=10)
    assert len(top.collect()) == 10
    read = [metric(s, "numOutputRows") for s in steps(top, "FileSourceScanExec")
            if "postings" in s.toString() or "batch" in s.toString()]
    assert read and 10 <= max(read) < N / 3, read


def test_bounds_hold_for_every_posting(spark, path):
    index = read_index(spark, path)
    assert index.block_bits == 8
    shapes = {(r["term"], r["block"]): r for r in index.bounds.collect()}
    counted = {}
    for r in index.retained.join(index.doc_stats, "doc_id").where("pmod(doc_id, 7) = 0").collect():
        found = shapes[r["term"], r["doc_id"] >> 8]["shapes"]
        assert any(s["tf"] >= r["tf"] and s["dl"] <= r["dl"] for s in found)
        counted[r["term"], r["doc_id"] >> 8] = 1
    assert sum(r["n"] for r in shapes.values()) == index.retained.count()
    assert max(len(r["shapes"]) for r in shapes.values()) <= 9


def test_bounds_shuffle_postings_once(spark, path, request):
    index = read_index(spark, path)
    rows = index.retained.count()
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    request.addfinalizer(lambda: spark.conf.set(threshold, before))
    bounds = pruning.block_bounds(index, bits=5)
    assert bounds.agg(F.sum("n")).first()[0] == rows
    bounds.collect()
    assert shuffled_rows(bounds) == [rows]


def test_sums_of_bounds_are_stored_per_query_and_block(spark, path, monkeypatch):
    """Words of a query share the row of a block, and postings of other words are not shuffled."""
    index = read_index(spark, path)
    stored = {}

    def kept(df, name):
        stored[name] = stored_table(df, name)
        return stored[name]

    monkeypatch.setattr(pruning, "stored_table", kept)
    monkeypatch.setattr(pruning, "LITERAL_RUNS", 0)
    monkeypatch.setattr(pruning, "broadcast_if_bounded", lambda df, rows: df)
    batch = QueryBatch.of(spark.createDataFrame([(1, "seldom filler7 filler8")], "query_id bigint, query string"))
    top = retrieval.bm25_top(batch, index, N, 200.0, k=20)
    assert len(top.collect()) == 20
    assert not {"term", "bucket"} & {c for name in stored if name != "known" for c in stored[name].columns}
    blocks = index.bounds.where(F.col("term").isin("seldom", "filler7", "filler8")).select("block").distinct()
    assert stored["blocks"].count() == blocks.count()
    found = index.postings.where(F.col("term").isin("seldom", "filler7", "filler8")).count()
    assert max(shuffled_rows(top)) <= max(found, N)


def test_many_runs_are_joined_instead(spark, path, monkeypatch):
    index = read_index(spark, path)
    batch = QueryBatch.of(spark.createDataFrame([(1, "common seldom")], "query_id bigint, query string"))
    few = [tuple(r) for r in retrieval.bm25_top(batch, index, N, 200.0, k=20).orderBy("rank").collect()]
    monkeypatch.setattr(pruning, "LITERAL_RUNS", 1)
    assert [tuple(r) for r in retrieval.bm25_top(batch, index, N, 200.0, k=20).orderBy("rank").collect()] == few


def test_an_addition_has_no_bounds_until_they_are_written(spark, tmp_path):
    path = f"{tmp_path}/i"
    index_documents(documents(spark, 0, 600), path, 2, n_buckets=2)
    assert write_bounds(spark, path, bits=5).bounds is not None
    assert append_index(spark, path, documents(spark, 600, 700)).bounds is None
    index = write_bounds(spark, path, bits=5)
    batch = QueryBatch.of(spark.createDataFrame([(1, "common seldom")], "query_id bigint, query string"))
    with scratch_scope(spark):
        whole = retrieval.bm25_top(batch, plain(index), 700, 200.0, k=7).orderBy("rank").collect()
        assert retrieval.bm25_top(batch, index, 700, 200.0, k=7).orderBy("rank").collect() == whole


def test_runs_of_blocks_become_one_flat_condition(spark):
    """As many runs as are allowed, of several words; the condition must stay within the stack."""
    wanted = spark.range(0, 200, 2).select(
        F.lit(1).cast("bigint").alias("bucket"), F.concat(F.lit("w"), F.col("id") % 3).alias("term"),
        F.col("id").alias("block"))
    wanted = wanted.unionByName(wanted.where("block = 0").withColumn("block", F.lit(1).cast("bigint")))
    kept = pruning._literal_runs(wanted, 4)
    postings = spark.range(0, 3200).select(
        F.col("id").alias("doc_id"), F.lit(1).cast("bigint").alias("bucket"),
        F.explode(F.array(*[F.lit(f"w{k}") for k in range(4)])).alias("term"))
    assert postings.where(kept).count() == wanted.count() * 16
    many = spark.range(0, 202, 2).select(
        F.lit(1).cast("bigint").alias("bucket"), F.lit("w").alias("term"), F.col("id").alias("block"))
    assert pruning._literal_runs(many, 4) is None
    assert postings.where(pruning._literal_runs(many.limit(0), 4)).count() == 0
