"""Top-k search that leaves out blocks of documents by bounds.

The documents of a term are cut into blocks of ids. For each block a stored table keeps the
pairs of frequency and length that can score highest: the largest frequency and the smallest
length of each class of frequencies (1, 2 to 3, 4 to 7, ...). They bound the term's score in the
block for any BM25 constants. A query's k blocks with the highest bounds are scored first; the
k-th best score found there is a floor, and of all other blocks only those are read whose bounds
add up to it. The result is that of scoring everything.
"""

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import bm25_idf, bm25_term_score
from ..plans.ranking import top_k_per_query
from ..plans.runtime import stored_table
from ..plans.sizing import TASK_ROWS, QueryBatch, broadcast_if_bounded
from ..plans.skew import salted_join
from .indexing import Index, with_terms

BLOCK_BITS = 12
# Bounds of a term are built in spans of 2^16 ids, so no task holds the rows of a whole term.
SPAN_BITS = 16
# So many runs of blocks become literals, by which a scan leaves out pages of its files.
LITERAL_RUNS = 100
# Bounds are sums in another order than scores; nobody is left out by less than this.
SLACK = 1e-6


def block_bounds(index: Index, bits: int = BLOCK_BITS) -> DataFrame:
    """(bucket, term, block, n, shapes, bits) of a stored index; a block spans 2^bits ids.

    Frequencies of one class keep their maximum and the least document length, so a row holds
    at most as many pairs as there are powers of two below the highest frequency. Postings are
    shuffled once, by term and span of ids, and both aggregates follow there.
    """
    lengths = index.doc_stats.select("doc_id", "dl")
    # Counted, as Spark shuffles all postings by term where the statistics' files are too large for it.
    retained = with_terms(index.postings, index.terms.select("term")) if index.min_df > 0 else index.postings
    placed = retained.join(broadcast_if_bounded(lengths, lengths.count()), "doc_id").select(
        "bucket", "term", "tf", "dl", F.shiftright("doc_id", bits).alias("block"))
    # Several operators of a task hold its rows at once, so it gets a quarter of the usual ones. A
    # term's rows stay together over spans of ids, which packs them better than blocks alone.
    placed = placed.withColumn("span", F.shiftright("block", max(0, SPAN_BITS - bits)))
    dealt = placed.repartition(4 * _tasks(index.terms), "term", "span")
    key = ["bucket", "term", "span", "block"]
    classes = dealt.groupBy(*key, F.floor(F.log2("tf")).alias("class")).agg(
        F.max("tf").alias("tf"), F.min("dl").alias("dl"), F.count("*").alias("n"))
    return classes.groupBy(*key).agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("tf", "dl")).alias("shapes")
    ).drop("span").withColumn("bits", F.lit(bits))


def _tasks(terms: DataFrame) -> int:
    """Number of partitions for the postings of (term, df)."""
    rows = terms.agg(F.sum("df")).first()[0] or 0
    return max(terms.sparkSession.sparkContext.defaultParallelism, ceil(rows / TASK_ROWS))


def _literal_runs(wanted: DataFrame, bits: int):
    """A filter for (bucket, term, block), neighbouring blocks taken together; None for too many.

    At most ``LITERAL_RUNS`` rows reach the driver.
    """
    starts = Window.partitionBy("bucket", "term").orderBy("block")
    runs = (
        wanted.withColumn("run", F.col("block") - F.row_number().over(starts))
        .groupBy("bucket", "term", "run").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    )
    found = runs.limit(LITERAL_RUNS + 1).collect()
    if len(found) > LITERAL_RUNS:
        return None
    kept = [(F.col("bucket") == r["bucket"]) & (F.col("term") == r["term"])
            & (F.col("doc_id") >= r["low"] << bits) & (F.col("doc_id") < (r["high"] + 1) << bits)
            for r in sorted(found, key=lambda r: (r["bucket"], r["term"], r["low"]))]
    # Joined two by two, so that the condition is no deeper than it must be.
    while len(kept) > 1:
        kept = [a | b for a, b in zip(kept[::2], kept[1::2])] + kept[len(kept) // 2 * 2 :]
    return kept[0] if kept else F.lit(False)


def _few_runs(pairs: DataFrame) -> bool:
    """Whether the blocks of (query_id, block) make so few runs that literals may serve."""
    starts = Window.partitionBy("query_id").orderBy("block")
    runs = pairs.select("query_id", (F.col("block") - F.row_number().over(starts)).alias("run")).distinct()
    return runs.limit(LITERAL_RUNS + 1).count() <= LITERAL_RUNS


def _scored(batch: QueryBatch, index: Index, known: DataFrame, pairs: DataFrame, parts: int, score) -> DataFrame:
    """(query_id, doc_id, score, pos) from the postings of ``known`` in the blocks of ``pairs`` alone.

    ``known`` (query_id, bucket, term, qtf, pos, df, idf, avgdl) and ``pairs`` (query_id, block) are
    stored tables. Postings are dealt by document and meet the queries behind the shuffle. With
    more pairs than may be broadcast, a query also scores the blocks that only others need.
    """
    bits, keys = index.block_bits, ["bucket", "term"]
    size = pairs.agg(F.count("*").alias("pairs"), F.count_distinct("block").alias("blocks")).first()
    postings = index.postings
    if _few_runs(pairs):
        blocks = pairs.join(known, "query_id").select(*keys, "block").distinct()
        runs = _literal_runs(blocks, bits)
        postings = postings if runs is None else postings.where(runs)
    # Spark prunes folders at run time only by a side with a filter of its own.
    terms = known.where("df > 0").select(*keys).distinct()
    block = F.shiftright("doc_id", bits)
    found = (
        postings.join(batch.broadcast_terms(terms), keys, "left_semi").withColumn("block", block)
        .join(broadcast_if_bounded(pairs.select("block").distinct(), size["blocks"]), "block", "left_semi")
        .select(*keys, "doc_id", "tf")
    )
    lengths = index.doc_stats.select("doc_id", "dl")
    if batch.terms_fit:
        met = (
            found.drop("bucket").repartition(parts, "doc_id")
            .join(lengths.repartition(parts, "doc_id").hint("shuffle_hash"), "doc_id")
            .join(F.broadcast(known.drop("bucket")), "term")
        )
    else:
        met = salted_join(found, known, keys, "doc_id").join(lengths, "doc_id")
    if size["pairs"] <= batch.max_rows:
        met = met.withColumn("block", block).join(F.broadcast(pairs), ["query_id", "block"], "left_semi")
    return met.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qtf") * score(F.col("tf"), F.col("dl"))).alias("score"), F.min("pos").alias("pos"))


def pruned_bm25(batch: QueryBatch, known: DataFrame, index: Index, n, avgdl, k1, b, k2, k, order) -> DataFrame:
    """(query_id, doc_id, score, pos, rank): the k best of each query.

    ``known`` is (query_id, bucket, term, qtf, pos, df), the terms of the queries that the index
    holds. Bounds of these terms are turned into one number each, dealt by block and summed
    per query there; one row per query and block is stored.
    """

    def score(tf, dl):
        return bm25_term_score(F.col("idf"), tf, dl, F.col("avgdl"), k1, b, k2)

    # As columns, since a function over an array may not hold a one-value query.
    known = stored_table(known.withColumns(
        {"idf": bm25_idf(F.col("df"), n), "avgdl": avgdl if isinstance(avgdl, Column) else F.lit(avgdl)}), "known")
    parts = _tasks(known)
    terms = known.where("df > 0").select("bucket", "term", "idf", "avgdl").distinct()
    highest = F.array_max(F.transform("shapes", lambda s: score(s["tf"], s["dl"])))
    ceilings = index.bounds.join(batch.broadcast_terms(terms), ["bucket", "term"]).select(
        "term", "block", highest.alias("highest"))
    asked = known.select("query_id", "term", "qtf")
    if batch.terms_fit:
        met = ceilings.repartition(parts, "block").join(F.broadcast(asked), "term")
    else:
        met = salted_join(ceilings, asked, ["term"], "block")
    keys = ["query_id", "block"]
    blocks = stored_table(met.groupBy(*keys).agg(F.sum(F.col("qtf") * F.col("highest")).alias("most")), "blocks")
    # The k best documents lie in k blocks at most, so as many are scored for the floor.
    first = top_k_per_query(blocks, k, [F.desc("most"), F.asc("block")])
    seeds = stored_table(first.select(*keys), "seeds")
    floors = (
        top_k_per_query(_scored(batch, index, known, seeds, parts, score), k, order).where(F.col("rank") == k)
        .select("query_id", F.col("score").alias("floor"))
    )
    needed = (
        blocks.join(batch.broadcast_rows(floors), "query_id", "left")
        .where(F.col("floor").isNull() | (F.col("most") >= F.col("floor") - SLACK)).select(*keys)
    )
    wanted = stored_table(needed, "wanted")
    return top_k_per_query(_scored(batch, index, known, wanted, parts, score), k, order)
