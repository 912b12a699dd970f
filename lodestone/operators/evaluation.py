"""Relevance evaluation and the search for good fusion weights."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_question, is_short_query, text_hash
from ..plans.ranking import top_k_per_query
from ..plans.sizing import QueryBatch
from ..plans.skew import salted_join
from ..schemas import PARAMETERS
from .hybrid import Indexes, fusion_order, fusion_score, search

# Ranges of the uniform draws.
RANGES = {
    "b": (50.0, 150.0), "k1": (1000.0, 1500.0), "k3": (5.0, 10.0), "k4": (3.0, 5.0),
    "k5": (20.0, 40.0), "pr": (0.1, 0.7), "pv": (1.0, 2.0),
}

# Ranges whose end points are drawn.
END_POINTS = {
    "b": (50.0, 150.0), "k1": (500.0, 2000.0), "k3": (5.0, 30.0), "k4": (1.0, 16.0),
    "k5": (5.0, 60.0), "pr": (1.0, 2.0), "pv": (0.1, 0.7),
}

# Start points (b, k1, k3, k4, k5).
STARTS = [(90.0, 1350.0, 8.0, 4.5, 30.0), (80.0, 1250.0, 7.0, 4.0, 25.0),
          (100.0, 1450.0, 9.0, 5.0, 35.0)]

# The kinds of queries that settings treat differently: (question, short).
KINDS = [(False, False), (True, False), (False, True)]


def _query_precision(results: DataFrame, qrels: DataFrame, keys, k: int) -> DataFrame:
    """(keys, ap) of the queries with at least one hit in their first k results."""
    judged = qrels.select("query_id", "doc_id").distinct().withColumn("hit", F.lit(1))
    so_far = (
        Window.partitionBy(*keys).orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        results.where(F.col("rank") <= k)
        .join(judged, ["query_id", "doc_id"], "left")
        .withColumn("precision", F.sum("hit").over(so_far) / F.col("rank"))
        .where(F.col("hit") == 1)
        .groupBy(*keys).agg(F.round(F.avg("precision"), 3).alias("ap"))
    )


def average_precision(results: DataFrame, qrels: DataFrame, queries: DataFrame,
                      k: int = 40) -> DataFrame:
    """(query_id, ap): mean precision at the hits among the first k; 0 without hits.

    The mean is over hits found, not over all relevant documents.
    """
    found = _query_precision(results, qrels, ["query_id"], k)
    return queries.select("query_id").join(found, "query_id", "left").select(
        "query_id", F.coalesce("ap", F.lit(0.0)).alias("ap")
    )


def mean_average_precision(ap: DataFrame) -> DataFrame:
    return ap.agg((F.sum(F.coalesce("ap", F.lit(0.0))) / F.count("*")).alias("map"))


def evaluate_queries(queries, qrels: DataFrame, indexes: Indexes, titles: DataFrame,
                     pagerank: DataFrame, pageviews: DataFrame, k: int = 40,
                     **options) -> DataFrame:
    """(query_id, query, ap) of hybrid search over all judged queries."""
    batch = QueryBatch.of(queries)
    results = search(batch, indexes, titles, pagerank, pageviews, **options)
    ap = average_precision(results, qrels, batch.queries, k)
    return batch.queries.join(ap, "query_id").select("query_id", "query", "ap")


def random_parameters(spark: SparkSession, n: int = 100, seed: int = 0, ranges=None,
                      end_points: bool = False) -> DataFrame:
    """n settings drawn from ``ranges``, uniformly or from their end points.

    Draws are hashes of seed, name and number: the same on any cluster.
    """
    ranges = ranges or (END_POINTS if end_points else RANGES)
    columns = []
    for name, (low, high) in ranges.items():
        key = F.concat(F.lit(f"{seed}:{name}:"), F.col("param_id").cast("string"))
        unit = text_hash(key).cast("double") / F.lit(float(2**40))
        value = (
            F.when(unit < 0.5, F.lit(low)).otherwise(F.lit(high)) if end_points
            else low + (high - low) * unit
        )
        columns.append(value.alias(name))
    return spark.range(n).withColumnRenamed("id", "param_id").select("param_id", *columns)


def parameter_starts(spark: SparkSession) -> DataFrame:
    """The three fixed start points, with the default prior scales."""
    rows = [(i, *point, 1.5, 0.75) for i, point in enumerate(STARTS)]
    return spark.createDataFrame(rows, PARAMETERS)


def sweep_candidates(features: DataFrame, k: int, least_weight,
                     queries: QueryBatch | None = None) -> DataFrame:
    """The feature rows that can be among a query's first k under some setting.

    Rows outside the BM25 list fall into classes by where they matched: within
    one, all share the fused weight w >= ``least_weight`` and score w * pr * pv.
    Two exact cuts follow. A row k of whose class have the same priors and come
    earlier in the tie order never makes the list. Neither, if ``least_weight``
    (a number or a one-value column) is above 0, does one whose pr * pv is so far
    below the class's k-th that scores differ by more than their rounding. Priors
    closer than that stay, however many. The k-th priors, at most three rows a
    query, are broadcast if the measured ``queries`` bound them and met with
    salted keys otherwise, so no task holds the rows of one query.
    """
    kind = ["query_id", "in_title", "in_anchor"]
    least = F.lit(least_weight) if isinstance(least_weight, (int, float)) else least_weight
    ranked = features.where(F.col("bm25_rank").isNotNull())
    others = features.where(F.col("bm25_rank").isNull()).withColumns({
        "in_title": F.col("title_words") > 0,
        "in_anchor": F.col("anchor_words") > 0,
        "prior": F.col("pr") * F.col("pv"),
    })
    same_score = top_k_per_query(others, k, fusion_order()[1:], [*kind, "pr", "pv"]).drop("rank")
    margin = 2e-9 / F.when(least > 0, least)
    lowest = (
        top_k_per_query(others.select(*kind, "prior"), k, [F.desc("prior")], kind)
        .where(F.col("rank") == k)
        .select(*kind, (F.col("prior") * (1 - 1e-9) - margin).alias("lowest"))
    )
    if queries is not None and queries.rows * len(KINDS) <= queries.max_rows:
        met = same_score.join(F.broadcast(lowest), kind, "left")
    else:
        met = salted_join(same_score, lowest, kind, "doc_id", "left")
    kept = met.where(F.col("lowest").isNull() | (F.col("prior") >= F.col("lowest")))
    return ranked.unionByName(kept.select(*features.columns))


def effective_settings(params: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settings as each kind of query sees them.

    Returns the distinct (setting, question, short, x, y, k4, pr, pv), where
    ``setting`` is the smallest param_id that looks so, and for every param_id
    its settings (param_id, question, short, setting).
    """
    kinds = F.explode(F.array(*[
        F.struct(F.lit(q).alias("question"), F.lit(s).alias("short")) for q, s in KINDS]))
    seen = params.withColumn("kind", kinds).select(
        F.col("param_id").cast("bigint").alias("param_id"), "kind.question", "kind.short",
        F.when(F.col("kind.question"), F.col("k1")).otherwise(F.col("b")).alias("x"),
        F.when(F.col("kind.short"), F.col("k5")).otherwise(F.col("k3")).alias("y"),
        "k4", "pr", "pv",
    )
    look = ["question", "short", "x", "y", "k4", "pr", "pv"]
    distinct = seen.groupBy(*look).agg(F.min("param_id").alias("setting"))
    same = seen.join(distinct, look).select("param_id", "question", "short", "setting")
    return distinct, same


def parameter_sweep(features: DataFrame, queries: DataFrame, qrels: DataFrame,
                    params: DataFrame, k: int = 40) -> DataFrame:
    """(param_id, total_ap): summed average precision of hybrid search per setting.

    b weighs the BM25 rank, k1 that of questions, k3 a title hit, k5 that of
    short queries, k4 an anchor hit. pr and pv scale all scores alike and change
    no order. Features are computed once and cut to the rows that can matter
    (``sweep_candidates``). Settings stay a table of any size: a query's rows meet
    the distinct settings of its kind, which many settings share, through a
    broadcast if their measured count allows and a salted join otherwise. That
    product of candidates and distinct settings is the work of a sweep; all but
    the best k per query and setting are dropped in the task, before the shuffle.
    """
    weights = [F.col(name) for name in PARAMETERS.fieldNames()[1:]]
    least_weight = params.agg(F.coalesce(F.min(
        F.when(F.least(*weights) > 0, F.least("k3", "k4", "k5") * F.col("pr") * F.col("pv"))
        .otherwise(0.0)), F.lit(0.0))).scalar()
    batch = QueryBatch.of(queries)
    kinds = batch.queries.select(
        "query_id", is_question("query").alias("question"), is_short_query("query").alias("short")
    )
    settings, same = effective_settings(params)
    rows = sweep_candidates(features, k, least_weight, batch).join(
        batch.broadcast_rows(kinds), "query_id")
    points = settings.select("question", "short", "setting", "x", "y", "k4",
                             F.col("pr").alias("pr_scale"), F.col("pv").alias("pv_scale"))
    n = settings.count()
    met = (
        rows.join(F.broadcast(points), ["question", "short"])
        if n <= batch.max_rows else salted_join(rows, points, ["question", "short"], "doc_id")
    )
    scored = met.withColumn("score", fusion_score(
        F.col("x"), F.col("y"), F.col("k4"), F.col("pr_scale"), F.col("pv_scale")))
    kind = ["question", "short", "setting"]
    keys = [*kind, "query_id"]
    top = top_k_per_query(scored, k, fusion_order(), keys).select(*keys, "doc_id", "rank")
    totals = _query_precision(top, qrels, keys, k).groupBy(*kind).agg(F.sum("ap").alias("ap"))
    found = same.join(totals, kind).groupBy("param_id").agg(F.sum("ap").alias("total_ap"))
    every = params.select(F.col("param_id").cast("bigint").alias("param_id"))
    return every.join(found, "param_id", "left").select(
        "param_id", F.coalesce("total_ap", F.lit(0.0)).alias("total_ap")
    )


def best_parameters(totals: DataFrame) -> DataFrame:
    """The setting with the highest positive total, the first on ties."""
    return (
        totals.where(F.col("total_ap") > 0)
        .orderBy(F.desc(F.round("total_ap", 6)), "param_id").limit(1)
    )
