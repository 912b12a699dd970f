from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.operators import indexing as ix
from lodestone.plans import cluster_by_bucket, doc_cuts
from lodestone.plans.ranking import top_k_per_query
from lodestone.sources import append_index, delete_index, read_index, write_index
from lodestone.sources.index_store import crossing_postings

from . import micro
from .plans import steps

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def postings(spark):
    frame = ix.term_frequencies(spark.read.parquet(DOCS).select("doc_id", "text")).cache()
    yield frame
    frame.unpersist()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_micro_postings_and_statistics(spark):
    corpus = micro.corpus(spark).select(F.col("id").alias("doc_id"), "text")
    field = micro.Field([(a[0], a[2]) for a in micro.ARTICLES], 1)
    index = ix.build_index(corpus, 1)
    expected = sorted((t, d, f) for t, c in field.lists.items() for d, f in c.items())
    assert rows(index.retained.select("term", "doc_id", "tf")) == expected
    assert rows(index.terms.select("term", "df")) == sorted((t, len(c)) for t, c in field.lists.items())
    assert rows(index.doc_stats.select("doc_id", "dl", "nf")) == sorted(
        (d, field.dl[d], field.nf[d]) for d in field.dl)


def test_totals(spark, postings):
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    assert postings.agg(F.sum("tf")).first()[0] == ix.term_occurrences(docs).count()
    assert ix.document_frequency(postings).agg(F.sum("df")).first()[0] == postings.count()
    assert (ix.collection_frequency(postings).agg(F.sum("cf")).first()
            == ix.doc_length(postings).agg(F.sum("dl")).first())


def test_threshold_is_strict(postings):
    kept = ix.prune_rare_terms(postings, 5)
    df = {r.term: r.df for r in ix.document_frequency(postings).collect()}
    terms = {r.term for r in kept.select("term").distinct().collect()}
    assert terms == {t for t, n in df.items() if n > 5}
    assert 5 in df.values()


def test_blocks_concatenate_to_sorted_lists(postings):
    lists = {}
    for r in sorted(ix.posting_lists(postings, 16).collect(), key=lambda r: (r.term, r.block)):
        assert len(r.postings) <= 16
        lists.setdefault(r.term, []).extend((p.doc_id, p.tf) for p in r.postings)
    expected = {}
    for r in postings.collect():
        expected.setdefault(r.term, []).append((r.doc_id, r.tf))
    assert lists == {t: sorted(p) for t, p in expected.items()}


def test_stored_index(spark, postings, tmp_path):
    path = f"{tmp_path}/body"
    stored = write_index(ix.Index.from_postings(postings, 5), path, 4)
    again = read_index(spark, path)
    assert again.min_df == 5 and again.n_buckets == 4
    assert rows(stored.retained.select("term", "doc_id", "tf")) == rows(ix.prune_rare_terms(postings, 5))
    terms = [r.term for r in again.terms.orderBy("term").limit(7).collect()] + ["nosuchterm"]
    by_scan = [r for r in rows(again.retained.select("term", "doc_id", "tf")) if r[0] in terms]
    literal = ix.lookup_postings(again, terms)
    table = ix.lookup_postings(again, spark.createDataFrame([(t,) for t in terms], "term string"))
    assert rows(literal) == rows(table) == by_scan
    plan = literal._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    delete_index(spark, path)
    with pytest.raises(FileNotFoundError):
        delete_index(spark, path)


def test_files_are_sorted_within_buckets(spark, postings, tmp_path):
    cluster_by_bucket(postings, 4).write.partitionBy("bucket").parquet(f"{tmp_path}/p")
    import glob

    import pyarrow.parquet as pq
    files = glob.glob(f"{tmp_path}/p/bucket=*/*.parquet")
    assert files
    for f in files:
        data = pq.ParquetFile(f).read(columns=["term", "doc_id"]).to_pylist()
        keys = [(r["term"].encode(), r["doc_id"]) for r in data]
        assert keys == sorted(keys)


def test_hot_term_spreads_over_files(spark, tmp_path):
    """One term with most postings must not end up in one task."""
    hot = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("t"), "id")).alias("term"),
        F.col("id").alias("doc_id"), F.lit(1).cast("bigint").alias("tf"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        cluster_by_bucket(hot.repartition(8), 4).write.partitionBy("bucket").parquet(f"{tmp_path}/p")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = (spark.read.parquet(f"{tmp_path}/p").where("term = 'hot'")
             .groupBy(F.input_file_name()).count().collect())
    assert len(files) > 2
    assert max(r["count"] for r in files) < 100_000
    assert sum(r["count"] for r in files) == 160_000


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["aa", "bb", "cc", "dd"]), max_size=6), min_size=2, max_size=8),
       st.integers(0, 2))
def test_adding_documents_equals_building_at_once(spark, docs, min_df):
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, tokens array<string>")
    split = len(docs) // 2
    whole = ix.index_from_tokens(table, min_df)
    first = ix.index_from_tokens(table.where(f"doc_id < {split}"), min_df)
    added = ix.add_documents(first, table.where(f"doc_id >= {split}"))
    for part in ("retained", "terms", "doc_stats"):
        a, b = getattr(whole, part), getattr(added, part)
        assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(b.columns)))
    counts = Counter(t for d in docs for t in d)
    assert {r.term: r.cf for r in added.term_stats.collect()} == counts
    raw = {r.doc_id: r.dl for r in ix.raw_doc_length(table).collect()}
    assert raw == {i: len(d) for i, d in enumerate(docs)}


def test_anchor_documents(spark):
    field = micro.Field([(d, t) for a in micro.ARTICLES for d, t in a[3]])
    expected = sorted((t, d, f) for t, c in field.lists.items() for d, f in c.items())
    assert rows(ix.anchor_documents(micro.corpus(spark))) == expected


def test_doc_cuts(spark):
    assert doc_cuts(spark.range(10).withColumnRenamed("id", "doc_id")) == []
    cuts = doc_cuts(spark.range(1000).withColumnRenamed("id", "doc_id"), block_rows=100)
    assert len(cuts) == 9
    assert all(abs(c - 100 * (i + 1)) < 20 for i, c in enumerate(cuts))


def test_documents_are_added_once(spark):
    tokens = "doc_id bigint, tokens array<string>"
    twice = spark.createDataFrame([(1, ["green"]), (2, ["tea"]), (1, ["green"])], tokens)
    for build in (ix.index_from_tokens, lambda d: ix.build_index(d.select("doc_id", F.array_join("tokens", " ").alias("text")))):
        with pytest.raises(ValueError, match="1"):
            build(twice)
    index = ix.index_from_tokens(twice.dropDuplicates(["doc_id"]))
    with pytest.raises(ValueError, match="2"):
        ix.add_documents(index, spark.createDataFrame([(2, ["tea"]), (3, ["new"])], tokens))


def index_tables(index):
    return {part: rows(getattr(index, part).select(*columns)) for part, columns in (
        ("retained", ["term", "doc_id", "tf"]), ("terms", ["term", "df", "cf"]),
        ("doc_stats", ["doc_id", "dl", "nf"]), ("doc_ids", ["doc_id"]))}


def test_appended_index_equals_one_build(spark, tmp_path):
    docs = spark.read.parquet(DOCS).select("doc_id", F.split("text", " ").alias("tokens"))
    whole = ix.index_from_tokens(docs, 5)
    path = f"{tmp_path}/i"
    write_index(ix.index_from_tokens(docs.where("doc_id % 4 = 0"), 5), path, 4)
    for part in (1, 2):
        append_index(spark, path, docs.where(f"doc_id % 4 = {part}"))
    before = index_tables(read_index(spark, path))
    with pytest.raises(ValueError):
        append_index(spark, path, docs.where("doc_id = 8"))
    # An addition that dies before its settings are written is not seen, and is replaced.
    docs.where("doc_id % 4 = 3").limit(3).select(
        F.lit("junk").alias("term"), "doc_id", F.lit(1).cast("bigint").alias("tf"), F.lit(0).alias("bucket")
    ).write.partitionBy("bucket").parquet(f"{path}/postings/batch=3")
    assert index_tables(read_index(spark, path)) == before
    append_index(spark, path, docs.where("doc_id % 4 = 3"))
    assert index_tables(read_index(spark, path)) == index_tables(whole)


def test_append_reads_old_postings_of_crossing_terms_only(spark, tmp_path):
    tokens = "doc_id bigint, tokens array<string>"
    many = [(i, [f"t{i % 50}", "rare"] if i == 0 else [f"t{i % 50}"]) for i in range(200)]
    path = f"{tmp_path}/i"
    index = write_index(ix.index_from_tokens(spark.createDataFrame(many, tokens), 1), path, 64)
    stats = index.term_stats.where("term = 'rare'").select("term", F.lit(2).cast("bigint").alias("df"))
    old = crossing_postings(index, stats)
    assert rows(old) == [("rare", 0, 1)]
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "hashpartitioning" not in plan


def test_lookup_prunes_folders_without_a_shuffle(spark, postings, tmp_path):
    stored = write_index(ix.Index.from_postings(postings, 0), f"{tmp_path}/b", 16)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = spark.createDataFrame([("tion",), ("thre",)], "term string")
        found = ix.lookup_postings(stored, wanted)
        assert {r.term for r in found.collect()} == {"tion", "thre"}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert "BroadcastHashJoin" in plan and "dynamicpruning" in plan and "hashpartitioning" not in plan


def test_many_terms_are_looked_up_with_salts(spark, postings, monkeypatch):
    index = ix.Index.from_postings(postings, 5)
    wanted = index.terms.select("term").limit(20)
    few = rows(ix.lookup_postings(index, wanted.cache()))
    monkeypatch.setattr(ix, "MAX_BROADCAST_ROWS", 3)
    assert rows(ix.lookup_postings(index, wanted)) == few
    assert rows(ix.prune_rare_terms(postings, 5)) == rows(index.retained.select("term", "doc_id", "tf"))


def test_long_lists_are_cut_in_groups(spark):
    """k above Spark's limit: equal to plain sorting, and no step before the last sees a whole query."""
    hits = spark.range(60_000).select(
        F.floor(F.col("id") % 10 / 9).alias("query_id"), F.col("id").alias("doc_id"),
        (F.col("id") * 7919 % 1009).alias("score"))
    order = [F.desc("score"), F.asc("doc_id")]
    found = {}
    for r in top_k_per_query(hits, 1500, order).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = r.doc_id
    for q in (0, 1):
        best = sorted((-(i * 7919 % 1009), i) for i in range(60_000) if i % 10 // 9 == q)[:1500]
        assert [found[q][k + 1] for k in range(len(best))] == [i for _, i in best]
    plan = top_k_per_query(hits, 1500, order)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "salt" in plan


def test_added_documents_are_counted_once(spark):
    """What add_documents returns reads the stored postings of the batch; only the old tokens are counted again."""
    tokens = "doc_id bigint, tokens array<string>"
    first = ix.index_from_tokens(spark.createDataFrame([(1, ["tea", "tea"]), (2, ["tea", "pot"])], tokens), 1)
    both = ix.add_documents(first, spark.createDataFrame([(3, ["pot", "pot", "cup"]), (4, [])], tokens))
    assert rows(both.terms.select("term", "df", "cf")) == [("pot", 2, 3), ("tea", 2, 3)]
    assert rows(both.doc_stats) == [(1, 2, 4), (2, 2, 2), (3, 2, 4)]
    batch = both.postings.where("doc_id > 2")
    assert rows(batch) == [("cup", 3, 1), ("pot", 3, 2)]
    both.term_stats.collect()
    both.postings.collect()
    assert steps(both.term_stats, "GenerateExec") == []
    assert len(steps(both.postings, "GenerateExec")) == 1


def test_postings_leave_documents_through_compiled_steps(spark):
    """No lambda runs per posting, and counts, lengths and norms are those of plain Python."""
    docs = [(1, ["b", "a", "b", "b"]), (2, []), (3, None), (4, ["c"]), (5, ["x"] * 30 + ["y"])]
    postings = ix.count_tokens(spark.createDataFrame(docs, "doc_id bigint, tokens array<string>"), marked=True)
    found = postings.collect()
    counts = {d: Counter(words or []) for d, words in docs}
    assert {(r["doc_id"], r["term"]): r["tf"] for r in found} == {
        (d, w): n for d, count in counts.items() for w, n in count.items()}
    assert {r["doc_id"]: tuple(r["head"]) for r in found if r["head"]} == {
        d: (sum(count.values()), sum(n * n for n in count.values())) for d, count in counts.items() if count}
    generate, = steps(postings, "GenerateExec")
    assert "lambda" not in generate.simpleString(10_000)
