"""Ranking within each query."""

from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import stored_table
from .sizing import broadcast_if_bounded


def top_k_per_query(df: DataFrame, k: int, order, keys=("query_id",), salts: int = 32, lead=None) -> DataFrame:
    """The first k rows of each query under ``order``, with their 1-based rank.

    Up to ``spark.sql.window.group.limit.threshold`` Spark limits each task to k rows
    per query before the shuffle, so a query that matches most of the corpus ships
    only k rows per task. Beyond it, rows are first dealt to ``salts`` groups a query by
    their hash and each group is cut to k; the last step sees salts * k rows a query.
    With ``lead``, a number by which ``order`` sorts first, falling, rows that a histogram
    shows to lie beyond the k-th are left out before that, so what is shuffled follows k.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get("spark.sql.window.group.limit.threshold", "1000"))
    if k > limit:
        if lead is not None:
            df = _above_the_kth(stored_table(df, "hits"), k, lead, keys)
        dealt = df.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        inside = Window.partitionBy(*keys, "salt").orderBy(*order)
        df = dealt.withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= k)
        df = df.drop("salt", "rank")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _height(value):
    """A whole number that never falls as ``value`` rises: 64 steps an octave, about one percent each.

    Null is lowest and NaN highest, as in Spark's falling order. All doubles make under
    300,000 different numbers.
    """
    size = F.floor(F.least(F.log2(F.abs(value)) * 64, F.lit(90_000.0))) + 100_000
    return (
        F.when(value.isNull(), F.lit(-(1 << 40)))
        .when(F.isnan(value.cast("double")), F.lit(1 << 40))
        .when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)).cast("long")
    )


def _above_the_kth(hits: DataFrame, k: int, lead, keys) -> DataFrame:
    """Rows of a stored table that are among a query's k highest by ``lead``, or share the k-th one's step.

    Tasks count rows per step before the shuffle; a query's steps are added from the highest
    down to the one that holds the k-th row.
    """
    hits = hits.withColumn("step", _height(lead))
    sizes = hits.groupBy(*keys, "step").agg(F.count("*").alias("size"))
    above = Window.partitionBy(*keys).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    cuts = stored_table(
        sizes.withColumn("above", F.coalesce(F.sum("size").over(above), F.lit(0))).where(F.col("above") < k)
        .groupBy(*keys).agg(F.min("step").alias("last")), "cuts")
    names = {key: f"cut_{key}" for key in keys}
    cuts = broadcast_if_bounded(cuts.withColumnsRenamed(names), cuts.count())
    on = F.col("step") >= F.col("last")
    for key, name in names.items():
        on &= F.col(key).eqNullSafe(F.col(name))
    return hits.join(cuts, on).drop("step", "last", *names.values())


def doc_cuts(docs: DataFrame, block_rows: int = 1_000_000) -> list:
    """Document ids that cut ``docs`` (one row per doc_id) into blocks of about ``block_rows``.

    Empty for small tables. One number per block reaches the driver.
    """
    blocks = ceil(docs.count() / block_rows)
    if blocks <= 1:
        return []
    points = [i / blocks for i in range(1, blocks)]
    cuts = docs.stat.approxQuantile("doc_id", points, 0.1 / blocks)
    return sorted(set(cuts))


def rank_all_per_query(hits: DataFrame, cuts: list) -> DataFrame:
    """Rank every hit of each query by score desc, first_word asc, doc_id asc.

    ``hits`` is (query_id, doc_id, score, first_word, ...) with one row per document.
    Hits are numbered inside (query, score, word, document block); what precedes
    a block is a running total over block counts. A query matching a third of
    the corpus is thus ranked by many tasks, none holding more than one block.
    """
    columns = [c for c in hits.columns if c != "query_id"]
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        hits = hits.withColumn("doc_pos", F.col("doc_id").cast("double"))
        hits = Bucketizer(splits=splits, inputCol="doc_pos", outputCol="block").transform(hits)
        hits = hits.drop("doc_pos")
    else:
        hits = hits.withColumn("block", F.lit(0.0))
    group = ["query_id", "score", "first_word", "block"]
    sizes = hits.groupBy(*group).agg(F.count("*").alias("size"))
    before = (
        Window.partitionBy("query_id")
        .orderBy(F.desc("score"), F.asc("first_word"), F.asc("block"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *group, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy(*group).orderBy("doc_id")
    return (
        hits.withColumn("place", F.row_number().over(inside))
        .join(offsets, group)
        .select("query_id", (F.col("offset") + F.col("place")).alias("rank"),
                *columns)
    )
