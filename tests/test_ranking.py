"""Long lists per query: cut by a histogram before they are shuffled."""

import math

import pytest
from pyspark.sql import functions as F

from lodestone.plans.ranking import _height, top_k_per_query

from .plans import shuffled_rows

N, K = 120_000, 1500


@pytest.mark.parametrize("score", ["uniform", "tied", "signed"])
def test_long_lists_ship_what_they_need(spark, score):
    """Query 1 has nine of ten hits; the result is that of sorting everything."""
    made = {
        "uniform": F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0,
        "tied": F.pmod(F.xxhash64("id"), F.lit(40)).cast("double"),
        "signed": F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1e12 - 9e-7,
    }[score]
    hits = spark.range(N).select(
        F.when(F.col("id") % 10 > 0, F.lit(1)).otherwise(F.lit(2)).alias("query_id"), F.col("id").alias("doc_id"),
        made.alias("score"))
    hits = hits.unionByName(spark.createDataFrame(
        [(3, 1, None), (3, 2, float("nan")), (3, 3, float("inf")), (3, 4, 0.0), (3, 5, -float("inf")), (None, 6, 1.0)],
        "query_id int, doc_id long, score double"))
    order = [F.desc("score"), F.asc("doc_id")]
    cut = top_k_per_query(hits, K, order, lead=F.col("score"))
    found = {}
    for r in cut.collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["doc_id"]
    wanted = {}
    for r in hits.collect():
        value = r["score"]
        height = -math.inf if value is None else math.inf if math.isnan(value) else value
        first = 2 if value is None else 0 if math.isnan(value) else 1
        wanted.setdefault(r["query_id"], []).append((first, -height, r["doc_id"]))
    assert {q: [d[k + 1] for k in range(len(d))] for q, d in found.items()} == {
        q: [h[2] for h in sorted(hs)[:K]] for q, hs in wanted.items()}
    if score != "tied":
        assert max(shuffled_rows(cut)) < 3 * K + N / 50
    else:
        # The step that holds the k-th hit is a fortieth of them all.
        assert max(shuffled_rows(cut)) < 2 * (K + N / 40)


def test_heights_follow_values(spark):
    values = [None, -float("inf"), -1e300, -5.0, -1e-320, 0.0, 5e-324, 1e-9, 0.5, 1.0, 1.011, 7.0, 1e308, float("inf"),
              float("nan")]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v double").select("i", _height(F.col("v")).alias("h"))
    heights = [r["h"] for r in rows.orderBy("i").collect()]
    assert heights == sorted(heights) and len(set(heights)) == len(heights)
    counts = spark.range(1, 2000).select("id", _height(F.col("id")).alias("h")).orderBy("id").collect()
    assert [r["h"] for r in counts] == sorted(r["h"] for r in counts)
