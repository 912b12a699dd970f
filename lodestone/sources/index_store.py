"""Indexes stored as Parquet tables, in segments.

A stored index is a folder of numbered segments. ``postings/`` is partitioned by segment
(``batch``) and bucket and sorted by term and document; ``stats/<segment>/`` holds what the
segment adds to the statistics: ``term_stats/``, ``doc_stats/`` (0 for documents
without a frequent term) and the one-row ``settings/``. Settings are written last and commit
a version: they name the segments that it consists of. Readers take the newest settings and
add the segments up, so a writer that dies midway changes nothing they see.

An addition writes its own segment only. Segments of like size are merged four at a time, so
their number grows with the logarithm of the additions. What no version needs any more is
removed by the commit after the next, which leaves readers of the version before time to end.
"""

from contextlib import contextmanager
from math import log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stopwords import index_stopwords
from ..functions.text import term_bucket, tokenize
from ..operators.counting import placed_postings
from ..operators.indexing import (
    Index,
    count_tokens,
    document_facts,
    document_statistics,
    refuse,
    summed,
    term_statistics,
)
from ..operators.pruning import BLOCK_BITS, block_bounds
from ..plans.layout import cluster_by_bucket
from ..plans.ranking import doc_cuts
from ..plans.runtime import hadoop_path, remove_folder, scratch_scope, stored_table
from ..plans.sizing import MAX_BROADCAST_ROWS, broadcast_if_bounded
from ..plans.skew import salted_join
from ..schemas import BOUNDS, DOC_STATS, MARKED_POSTINGS, STORED_POSTINGS, TERM_STATS

SETTINGS = ("batch bigint, min_df bigint, n_buckets bigint, cuts array<double>, n_docs bigint, "
            "segments array<struct<batch: bigint, docs: bigint>>")
BLOCK_ROWS = 1_000_000
# So many segments of like size are merged, and sizes are alike within this factor.
FAN_IN = 4


# ---- versions


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, rising."""
    pattern, files = hadoop_path(spark, f"{path}/stats/*/settings/_SUCCESS")
    found = files.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getParent().getName()) for f in found)


def _settings_of(spark: SparkSession, path: str, version: int) -> dict:
    return spark.read.schema(SETTINGS).parquet(f"{path}/stats/{version}/settings").first().asDict(recursive=True)


def _settings(spark: SparkSession, path: str) -> dict | None:
    """The newest committed settings."""
    versions = _versions(spark, path)
    return _settings_of(spark, path, versions[-1]) if versions else None


def _commit(spark: SparkSession, path: str, settings: dict, before: dict | None) -> None:
    """Write a version's settings, then remove segments that neither it nor the one before needs."""
    row = tuple(settings[name] for name in ("batch", "min_df", "n_buckets", "cuts", "n_docs"))
    segments = [(s["batch"], s["docs"]) for s in settings["segments"]]
    spark.createDataFrame([(*row, segments)], SETTINGS).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/stats/{settings['batch']}/settings")
    needed = {settings["batch"]} | {s["batch"] for s in settings["segments"]}
    if before:
        needed |= {before["batch"]} | {s["batch"] for s in before["segments"]}
    for folder, prefix in ((f"{path}/stats", ""), (f"{path}/postings", "batch=")):
        found, files = hadoop_path(spark, folder)
        for entry in files.listStatus(found) if files.exists(found) else []:
            name = entry.getPath().getName()
            number = name.removeprefix(prefix)
            if number.isdigit() and int(number) < settings["batch"] and int(number) not in needed:
                remove_folder(spark, f"{folder}/{name}")


def _cuts(spark: SparkSession, path: str, segments: list, n_docs: int, before: dict | None) -> list:
    """The ids that split the documents into blocks; the old ones while the number of blocks stays."""
    if before and -(-before["n_docs"] // BLOCK_ROWS) == -(-n_docs // BLOCK_ROWS):
        return before["cuts"]
    if n_docs <= BLOCK_ROWS:
        return []
    return doc_cuts(_added_up(spark, path, segments, "doc_stats", DOC_STATS), BLOCK_ROWS)


@contextmanager
def _uncommitted(spark: SparkSession, path: str, batch: int):
    """Takes back what a refused batch has written; a writer that dies leaves it to the next."""
    try:
        yield
    except ValueError:
        for folder in (f"{path}/postings/batch={batch}", f"{path}/stats/{batch}"):
            remove_folder(spark, folder)
        raise


# ---- segments


def _write_postings(postings: DataFrame, path: str, batch: int, n_buckets: int | None) -> DataFrame:
    """Write a segment's postings and read them back, with ``head`` if they are marked.

    Without ``n_buckets`` they keep the buckets that they bring along.
    """
    columns = ["term", "doc_id", "tf", *(["head"] if "head" in postings.columns else [])]
    placed = ["bucket"] if n_buckets is None else []
    folder = f"{path}/postings/batch={batch}"
    (
        cluster_by_bucket(postings.select(*columns, *placed), n_buckets)
        .write.mode("overwrite").partitionBy("bucket").parquet(folder)
    )
    return postings.sparkSession.read.schema(MARKED_POSTINGS).parquet(folder).select(*columns, "bucket")


def _read_postings(spark: SparkSession, path: str, batches: list) -> DataFrame:
    """Postings of some segments; ``head`` is null throughout where they were not marked."""
    stored = spark.read.schema(STORED_POSTINGS).parquet(f"{path}/postings")
    return stored.where(F.col("batch").isin(batches)).drop("batch")


def _write_stats(df: DataFrame, path: str, batch: int, name: str, schema) -> DataFrame:
    """Write a segment's statistics and read them back: their written size decides on joins."""
    folder = f"{path}/stats/{batch}/{name}"
    df.select(*schema.names).write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)


def _increments(spark: SparkSession, path: str, batches: list, name: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/stats/{b}/{name}" for b in batches])


def _added_up(spark: SparkSession, path: str, batches: list, name: str, schema) -> DataFrame:
    rows = _increments(spark, path, batches, name, schema)
    key, *columns = schema.names
    return rows if len(batches) == 1 else summed(rows, key, *columns)


def save_global_stats(index: Index, path: str, batch: int = 0, before: dict | None = None) -> None:
    """Write the index's term and document statistics and commit them as a version of one segment.

    One aggregate over the postings gives the documents, their lengths and norms, and if the
    postings are marked also the documents that came twice, which are refused.
    """
    spark = index.postings.sparkSession
    terms = _write_stats(index.term_stats, path, batch, "term_stats", TERM_STATS)
    facts = document_facts(index.postings, terms, index.min_df)
    marked = "head" in index.postings.columns
    extended = T.StructType([*DOC_STATS.fields, T.StructField("rows", T.LongType())])
    written = _write_stats(facts, path, batch, "doc_stats", extended if marked else DOC_STATS)
    found = written.agg(F.count("*"), F.max("rows") if marked else F.lit(1)).first()
    if (found[1] or 0) > 1:
        refuse(written.where("rows > 1"))
    _commit(spark, path, {
        "batch": batch, "min_df": index.min_df, "n_buckets": index.n_buckets, "n_docs": found[0],
        "cuts": _cuts(spark, path, [batch], found[0], None),
        "segments": [{"batch": batch, "docs": found[0]}]}, before)


def write_index(index: Index, path: str, n_buckets: int = 124) -> Index:
    """Store an index and return the stored one.

    Postings are written first, unpruned, so that later additions can lift a term
    over the threshold; statistics come from the written table. An index that is there
    already is replaced by the commit, so the plan of the new one may read it. For
    (doc_id, text) use :func:`index_documents`, which shuffles less.
    """
    return _replace(index.postings.select("term", "doc_id", "tf"), path, index.min_df, n_buckets)


def index_documents(docs: DataFrame, path: str, min_df: int = 50, stopwords=None,
                    n_buckets: int = 124) -> Index:
    """Build and store the index of (doc_id, text) or (doc_id, tokens), one row per document.

    Texts are read once. Postings are shuffled once, into the stored layout; those of rare
    terms a second time, by document. Ids that come twice are refused.
    """
    return _replace(_counted(docs, stopwords, n_buckets), path, min_df, n_buckets)


def _counted(docs: DataFrame, stopwords=None, n_buckets: int = 1) -> DataFrame:
    """Marked postings of (doc_id, tokens) as they are, or of (doc_id, text) without stopwords, with buckets."""
    if "tokens" in docs.columns:
        return count_tokens(docs, marked=True)
    words = index_stopwords() if stopwords is None else stopwords
    return placed_postings(docs.select("doc_id", tokenize("text").alias("tokens")), n_buckets, words)


def _replace(postings: DataFrame, path: str, min_df: int, n_buckets: int) -> Index:
    spark = postings.sparkSession
    before = _settings(spark, path)
    batch = before["batch"] + 1 if before else 0
    with _uncommitted(spark, path, batch):
        placed = "bucket" in postings.columns
        written = _write_postings(postings, path, batch, None if placed else n_buckets)
        stored = Index(written, term_statistics(written), None, min_df, n_buckets)
        save_global_stats(stored, path, batch, before)
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    settings = _settings(spark, path)
    if settings is None:
        raise FileNotFoundError(f"no index at {path}")
    batches = [s["batch"] for s in settings["segments"]]
    documents = _added_up(spark, path, batches, "doc_stats", DOC_STATS)
    many = len(batches) > 1
    bounds, bits = _read_bounds(spark, path, settings["batch"])
    return Index(
        postings=_read_postings(spark, path, batches).drop("head"),
        term_stats=_added_up(spark, path, batches, "term_stats", TERM_STATS),
        doc_stats=documents.where("dl > 0"),
        min_df=settings["min_df"],
        n_buckets=settings["n_buckets"],
        documents=documents.select("doc_id"),
        cuts=settings["cuts"],
        increments=_increments(spark, path, batches, "term_stats", TERM_STATS) if many else None,
        bounds=bounds,
        block_bits=bits,
    )


def write_bounds(spark: SparkSession, path: str, bits: int = BLOCK_BITS) -> Index:
    """Store block bounds of a stored index and return it with them.

    They hold for the version at hand: an addition gives a version without bounds.
    """
    version = _versions(spark, path)
    if not version:
        raise FileNotFoundError(f"no index at {path}")
    bounds = block_bounds(read_index(spark, path), bits)
    bounds.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block").write.mode(
        "overwrite").partitionBy("bucket").parquet(f"{path}/stats/{version[-1]}/bounds")
    return read_index(spark, path)


def _read_bounds(spark: SparkSession, path: str, version: int):
    folder = f"{path}/stats/{version}/bounds"
    done, files = hadoop_path(spark, f"{folder}/_SUCCESS")
    if not files.exists(done):
        return None, None
    bounds = spark.read.schema(BOUNDS).parquet(folder)
    row = bounds.select("bits").first()
    return (bounds, row["bits"]) if row else (None, None)


def crossing_postings(index: Index, stats: DataFrame) -> DataFrame:
    """Old postings of the terms that ``stats`` lifts over the threshold.

    ``stats`` is (term, df, ...) after an addition. The terms are counted: few are
    broadcast and pick bucket folders at run time, many meet salted keys.
    """
    above = stats.where(F.col("df") > index.min_df).select("term")
    old = index.statistics_of(above).where(F.col("df") <= index.min_df)
    lifted = stored_table(old.select("term", term_bucket("term", index.n_buckets).alias("bucket")), "lifted")
    keys = ["bucket", "term"]
    if lifted.count() <= MAX_BROADCAST_ROWS:
        # Spark prunes folders at run time only by a side with a filter of its own.
        found = index.postings.join(F.broadcast(lifted.where("bucket >= 0")), keys, "left_semi")
    else:
        found = salted_join(index.postings, lifted, keys, "doc_id", "left_semi")
    return found.select("term", "doc_id", "tf")


def append_index(spark: SparkSession, path: str, docs: DataFrame, compact: bool = True) -> Index:
    """Add a batch of new (doc_id, tokens) to a stored index and return it.

    The batch becomes a segment: its postings, what it adds to the statistics of its terms
    and documents, and to those of old documents with a term that crosses the threshold;
    only such old postings are read. So what is written follows the batch, not the index.
    Ids that the index holds or that come twice are refused. An addition that failed is
    replaced by the next one. Unless ``compact`` is off, segments of like size are merged.
    """
    before = _settings(spark, path)
    index = read_index(spark, path)
    batch, n_buckets = before["batch"] + 1, before["n_buckets"]
    with scratch_scope(spark), _uncommitted(spark, path, batch):
        new = _write_postings(_counted(docs.select("doc_id", "tokens")), path, batch, n_buckets)
        ids = stored_table(new.where("head is not null").groupBy("doc_id").agg(F.count("*").alias("rows")), "ids")
        refuse(ids.where("rows > 1"))
        docs_added = ids.count()
        refuse(index.documents.join(broadcast_if_bounded(ids, docs_added), "doc_id", "left_semi"))
        terms = _write_stats(term_statistics(new), path, batch, "term_stats", TERM_STATS)
        wanted = broadcast_if_bounded(terms.select("term"), terms.count())
        totals = stored_table(summed(
            index.statistics_of(wanted).unionByName(terms), "term", "df", "cf"), "totals")
        facts = document_facts(new, totals, index.min_df).select(*DOC_STATS.names)
        lifted = document_statistics(crossing_postings(index, totals))
        _write_stats(facts.unionByName(lifted), path, batch, "doc_stats", DOC_STATS)
        segments = [*before["segments"], {"batch": batch, "docs": docs_added}]
        n_docs = before["n_docs"] + docs_added
        cuts = _cuts(spark, path, [s["batch"] for s in segments], n_docs, before)
        settings = {**before, "batch": batch, "segments": segments, "n_docs": n_docs, "cuts": cuts}
        _commit(spark, path, settings, before)
        while compact and (last := _like_sized(settings["segments"])):
            settings = _merge(spark, path, settings, last)
    return read_index(spark, path)


def _tier(docs: int) -> int:
    return int(log(max(1, docs), FAN_IN))


def _like_sized(segments: list) -> int:
    """How many of the newest segments to merge: those not above the newest one's tier, if there are enough."""
    newest, many = _tier(segments[-1]["docs"]), 0
    for segment in reversed(segments):
        if _tier(segment["docs"]) > newest:
            break
        many += 1
    return many if many >= FAN_IN else 0


def _merge(spark: SparkSession, path: str, settings: dict, last: int) -> dict:
    """Commit a version whose ``last`` newest segments are one; increments of a key are added up."""
    kept, merged = settings["segments"][:-last], settings["segments"][-last:]
    batches, batch = [s["batch"] for s in merged], settings["batch"] + 1
    _write_postings(_read_postings(spark, path, batches), path, batch, None)
    for name, schema in (("term_stats", TERM_STATS), ("doc_stats", DOC_STATS)):
        _write_stats(_added_up(spark, path, batches, name, schema), path, batch, name, schema)
    docs = sum(s["docs"] for s in merged)
    after = {**settings, "batch": batch, "segments": [*kept, {"batch": batch, "docs": docs}]}
    _commit(spark, path, after, settings)
    return after


def compact_index(spark: SparkSession, path: str) -> Index:
    """Merge all segments of a stored index into one, equal to an index built at once."""
    settings = _settings(spark, path)
    if settings is None:
        raise FileNotFoundError(f"no index at {path}")
    if len(settings["segments"]) > 1:
        _merge(spark, path, settings, len(settings["segments"]))
    return read_index(spark, path)


def delete_index(spark: SparkSession, path: str) -> bool:
    """Remove a stored index's folder through the file system that holds it."""
    if _settings(spark, path) is None:
        raise FileNotFoundError(f"no index at {path}")
    return remove_folder(spark, path)
