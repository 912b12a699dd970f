"""Stored indexes as segments: what is written, what is merged, what is removed."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestone.functions import bucket_of, remove_stopwords, term_bucket, tokenize
from lodestone.operators import indexing as ix
from lodestone.plans.runtime import clear_scratch, scratch_path, scratch_scope, stored_table
from lodestone.sources import append_index, compact_index, index_documents, read_index, write_index
from lodestone.sources import index_store as store

from .plans import shuffled_rows

DOCS = "/root/testdata/sf0.001/documents.parquet"
TOKENS = "doc_id bigint, tokens array<string>"


def rows(df):
    return sorted(map(tuple, df.collect()))


def tables(index):
    return {part: rows(getattr(index, part).select(*columns)) for part, columns in (
        ("retained", ["term", "doc_id", "tf"]), ("terms", ["term", "df", "cf"]),
        ("doc_stats", ["doc_id", "dl", "nf"]), ("doc_ids", ["doc_id"]))}


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def segments(spark, path):
    return [s["batch"] for s in store._settings(spark, path)["segments"]]


def numbered_docs(spark, low, high, words=30):
    """Documents whose words are partly common, partly their own."""
    return spark.range(low, high).select(F.col("id").alias("doc_id"), F.concat(
        F.transform(F.sequence(F.lit(1), F.lit(words)), lambda k: F.concat(F.lit("w"), (k * F.col("id")) % 211)),
        F.array(F.concat(F.lit("own"), "id"))).alias("tokens"))


def test_documents_index_equals_write_index(spark, tmp_path):
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    plain = write_index(ix.build_index(docs, 5), f"{tmp_path}/a", 4)
    direct = index_documents(docs, f"{tmp_path}/b", 5, n_buckets=4)
    assert tables(direct) == tables(plain)
    few = index_documents(docs, f"{tmp_path}/c", 5, stopwords=["tion"], n_buckets=4)
    assert few.postings.where("term = 'tion'").count() == 0 < direct.postings.where("term = 'tion'").count()


def test_one_small_shuffle_gives_all_document_facts(spark):
    """Of marked postings, one a document and those of rare terms are shuffled."""
    docs = spark.read.parquet(DOCS).select("doc_id", "text").repartition(4, "doc_id")
    postings = stored_table(store._counted(docs).sortWithinPartitions("term"), "counted")
    stats = stored_table(ix.term_statistics(postings), "terms")
    rare = stats.where("df <= 5").agg(F.sum("df")).first()[0]
    facts = ix.document_facts(postings, stats, 5)
    found = {r["doc_id"]: r for r in facts.collect()}
    exchanges = shuffled_rows(facts)
    assert len(exchanges) == 1 and exchanges[0] <= 4 * len(found) + rare < postings.count()
    kept = ix.retained_postings(postings, stats, 5)
    plain = {r["doc_id"]: r for r in ix.document_statistics(kept).collect()}
    for i, r in found.items():
        assert (r["dl"], r["nf"], r["rows"]) == ((plain[i]["dl"], plain[i]["nf"], 1) if i in plain else (0, 0, 1))
    assert plain.keys() <= found.keys()
    bare = ix.document_facts(postings.drop("head"), stats, 5)
    assert rows(bare) == rows(facts)


def test_postings_leave_the_count_in_stored_order(spark):
    """A batch's postings come by bucket, term and document, equal to those counted row by row."""
    texts = ["green tea den den Éclair", None, "", "the and of", "tea TEA leaf #tag", "ab x", "a'bcd den green"]
    docs = spark.createDataFrame(
        [(None if i % 7 == 3 else 90 - i // 2, f"{texts[i % 7] or ''} word{i % 11}" if i % 7 > 2 else texts[i % 7])
         for i in range(60)], "doc_id bigint, text string").coalesce(1)
    stop = ["the", "leaf"]
    plain = ix.count_tokens(docs.select("doc_id", remove_stopwords(tokenize("text"), stop).alias("tokens")), marked=True)
    plain = plain.withColumn("bucket", term_bucket("term", 5))
    counted = store._counted(docs, stop, 5).select(*plain.columns)
    whole = counted.collect()
    assert [r["bucket"] for r in whole] == sorted(r["bucket"] for r in whole)
    keys = [(r["bucket"], r["term"].encode(), r["doc_id"] or 0) for r in whole]
    assert keys == sorted(keys) and len(keys) > 100

    def heads(rows):
        return sorted((r["doc_id"] or 0, *r["head"]) for r in rows if r["head"])

    same = plain.drop("head").collect()
    assert Counter(r[:3] + r[4:] for r in whole) == Counter(map(tuple, same))
    assert heads(whole) == heads(plain.collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        parts = counted.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter(r[:3] + r[4:] for r in parts) == Counter(map(tuple, same))
    assert heads(parts) == heads(whole)


def test_repeated_ids_are_found_by_the_same_aggregate(spark, tmp_path):
    twice = spark.createDataFrame([(1, ["green"]), (2, ["tea"]), (1, ["leaf"]), (3, [])], TOKENS)
    with pytest.raises(ValueError, match="1"):
        index_documents(twice, f"{tmp_path}/i", 0)
    with pytest.raises(FileNotFoundError):
        read_index(spark, f"{tmp_path}/i")
    index = index_documents(twice.where("not array_contains(tokens, 'leaf')"), f"{tmp_path}/i", 0)
    assert rows(index.doc_ids) == [(1,), (2,)]
    for batch in ([(4, ["x"]), (4, ["y"])], [(2, ["again"])]):
        with pytest.raises(ValueError, match=str(batch[0][0])):
            append_index(spark, f"{tmp_path}/i", spark.createDataFrame(batch, TOKENS))
    assert rows(read_index(spark, f"{tmp_path}/i").doc_ids) == [(1,), (2,)]
    assert sorted(os.listdir(f"{tmp_path}/i/stats")) == ["0"]


def test_additions_write_what_they_bring(spark, tmp_path):
    path = f"{tmp_path}/i"
    index_documents(numbered_docs(spark, 0, 4000), path, 3, n_buckets=4)
    base, written = size_of(path), []
    for k in range(3):
        before = size_of(path)
        append_index(spark, path, numbered_docs(spark, 4000 + 10 * k, 4010 + 10 * k))
        written.append(size_of(path) - before)
    # File headers are most of it at this size; a copy of the old statistics alone would exceed it.
    assert max(written) < base / 4, (base, written)
    statistics = size_of(f"{path}/stats/0/doc_stats") + size_of(f"{path}/stats/0/term_stats")
    for batch in (1, 2, 3):
        added = [f"{path}/stats/{batch}/{name}" for name in ("doc_stats", "term_stats")]
        assert sum(map(size_of, added)) < statistics / 3
        assert spark.read.parquet(added[0]).count() == 10


def test_merged_segments_equal_one_build(spark, tmp_path):
    path, parts = f"{tmp_path}/i", 5
    index_documents(numbered_docs(spark, 0, 300), path, 20, n_buckets=4)
    counts = []
    for k in range(parts):
        index = append_index(spark, path, numbered_docs(spark, 300 + 7 * k, 307 + 7 * k))
        counts.append(len(segments(spark, path)))
    whole = tables(index_documents(numbered_docs(spark, 0, 300 + 7 * parts), f"{tmp_path}/w", 20, n_buckets=4))
    assert tables(index) == whole
    # Seven documents each: four of their segments become one.
    assert counts == [2, 3, 4, 2, 3]
    assert index.increments is not None
    wanted = spark.createDataFrame([("w1",), ("own305",), ("none",)], "term string")
    assert rows(index.statistics_of(wanted)) == rows(index.term_stats.join(wanted, "term", "left_semi"))
    merged = compact_index(spark, path)
    assert tables(merged) == whole and merged.increments is None and len(segments(spark, path)) == 1
    assert merged.cuts == index.cuts == []
    # What the version before needs is still there; the next commit removes it.
    assert tables(index) == whole
    append_index(spark, path, numbered_docs(spark, 9000, 9002))
    kept = {int(name) for name in os.listdir(f"{path}/stats")}
    assert kept == set(segments(spark, path)) and len(kept) == 2
    assert {int(n.removeprefix("batch=")) for n in os.listdir(f"{path}/postings") if n.startswith("batch=")} == kept


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/i"
    index_documents(numbered_docs(spark, 0, 20), path, 1, n_buckets=2)
    append_index(spark, path, numbered_docs(spark, 20, 30), compact=False)
    before = tables(read_index(spark, path))

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(store, "_commit", dies)
        with pytest.raises(OSError):
            compact_index(spark, path)
        with pytest.raises(OSError):
            append_index(spark, path, numbered_docs(spark, 30, 40))
    assert tables(read_index(spark, path)) == before
    assert tables(compact_index(spark, path)) == before


def test_an_index_may_be_rewritten_from_itself(spark, tmp_path):
    path = f"{tmp_path}/i"
    old = index_documents(numbered_docs(spark, 0, 50), path, 1, n_buckets=2)
    before = tables(old)
    new = write_index(ix.Index(old.postings.where("doc_id < 25"), None, None, 1), path, 2)
    assert tables(old) == before
    assert rows(new.doc_ids) == [(i,) for i in range(25)]
    assert tables(new) == tables(index_documents(numbered_docs(spark, 0, 25), f"{tmp_path}/j", 1, n_buckets=2))


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    def tables_left():
        root = scratch_path(spark).removeprefix("file:")
        return {d for d, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files)}

    before = tables_left()
    with scratch_scope(spark):
        outer = stored_table(spark.range(5), "outer")
        with scratch_scope(spark):
            inner = stored_table(outer.where("id > 1"), "inner")
            assert inner.count() == 3 and len(tables_left() - before) == 2
        assert outer.count() == 5 and len(tables_left() - before) == 1
        docs = spark.read.parquet(DOCS).select("doc_id", "text")
        kept = ix.prune_rare_terms(ix.term_frequencies(docs), 5)
        kept.write.parquet(f"{tmp_path}/kept")
    assert tables_left() == before
    # Writers clean up after themselves without a scope around them.
    index_documents(docs, f"{tmp_path}/i", 5)
    append_index(spark, f"{tmp_path}/i", spark.createDataFrame([(10**6, ["new"])], TOKENS))
    assert tables_left() == before
    assert spark.read.parquet(f"{tmp_path}/kept").count() > 0


def test_clear_scratch(spark, monkeypatch):
    from lodestone.plans import runtime

    base = runtime.scratch_path(spark, "own")
    monkeypatch.setattr(runtime, "scratch_path", lambda s, *parts: "/".join([base, *parts]))
    made = runtime.stored_table(spark.range(3), "x")
    assert made.count() == 3
    clear_scratch(spark)
    assert not os.path.exists(base.removeprefix("file:"))


def test_merge_keeps_stored_buckets(spark, tmp_path, monkeypatch):
    """Merging segments moves postings with the buckets they lie in; no term is hashed again."""
    path = f"{tmp_path}/ix"
    index_documents(numbered_docs(spark, 0, 40), path, 3, n_buckets=4)
    append_index(spark, path, numbered_docs(spark, 40, 60))
    before = tables(read_index(spark, path))

    def hashed(*_):
        raise AssertionError("terms are hashed again")

    monkeypatch.setattr("lodestone.plans.layout.term_bucket", hashed)
    merged = compact_index(spark, path)
    monkeypatch.undo()
    assert len(segments(spark, path)) == 1 and tables(merged) == before
    placed = merged.postings.select("term", "bucket").distinct().collect()
    assert all(r["bucket"] == bucket_of(r["term"], 4) for r in placed)
