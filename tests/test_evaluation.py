import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import evaluation as ev
from lodestone.plans.sizing import QueryBatch


def python_ap(relevant, results, k=40):
    hits = []
    for i, doc in enumerate(results[:k]):
        if doc in relevant:
            hits.append((len(hits) + 1) / (i + 1))
    return round(sum(hits) / len(hits), 3) if hits else 0.0


def test_average_precision(spark):
    rng = random.Random(3)
    results, relevant = {}, {}
    for q in range(12):
        results[q] = rng.sample(range(200), 60 if q else 0)
        relevant[q] = set(rng.sample(range(200), 25 if q != 4 else 1))
    ranked = spark.createDataFrame(
        [(q, i + 1, d) for q, docs in results.items() for i, d in enumerate(docs)],
        "query_id bigint, rank int, doc_id bigint")
    qrels = spark.createDataFrame(
        [(q, d) for q, docs in relevant.items() for d in docs] * 2, "query_id bigint, doc_id bigint")
    queries = spark.range(13).withColumnRenamed("id", "query_id")
    ap = ev.average_precision(ranked, qrels, queries)
    found = {r.query_id: r.ap for r in ap.collect()}
    expected = {q: python_ap(relevant.get(q, ()), results.get(q, [])) for q in range(13)}
    assert found == pytest.approx(expected)
    mean = ev.mean_average_precision(ap).first()["map"]
    assert mean == pytest.approx(sum(expected.values()) / 13)


FEATURES = """query_id bigint, doc_id bigint, bm25_rank int, title_words bigint, title_first string,
    anchor_words bigint, anchor_first string, pr double, pv double"""


def make_features(seed, n):
    rng = random.Random(seed)
    rows = []
    for q in range(3):
        top = iter(range(1, 21))
        for d in rng.sample(range(10 * n), n):
            rank = next(top, None) if rng.random() < 0.1 else None
            title, anchor = rng.choice([(0, 1), (1, 0), (2, 0), (1, 1), (0, 2)])
            rows.append((
                q, d, rank, title, rng.choice("ab") if title else None,
                anchor, rng.choice("ab") if anchor else None,
                rng.choice([0.15, 0.15 + 1e-15, 0.3, 1.0, 0.0, rng.random()]),
                rng.choice([1.0, 2.0, 2.0, 5.0])))
    return rows


def python_sweep(rows, queries, relevant, params, k):
    totals = {}
    for i, p in params.items():
        total = 0
        for q, text in queries.items():
            x = p["k1"] if text.endswith("?") else p["b"]
            y = p["k5"] if len(text) < 4 and not text.endswith("?") else p["k3"]
            scored = []
            for r in rows:
                if r[0] != q:
                    continue
                s = (x / r[2] if r[2] else 0.0) + (y if r[3] else 0.0) + (p["k4"] if r[5] else 0.0)
                s = s * p["pr"] * r[7] * p["pv"] * r[8]
                none = (1, 0)
                scored.append((
                    -round(s, 9), (0, r[2]) if r[2] else none, -r[3], (0, r[4]) if r[3] else (1, ""),
                    (0, r[1]) if r[3] else none, -r[5], (0, r[6]) if r[5] else (1, ""), r[1]))
            total += python_ap(relevant[q], [e[-1] for e in sorted(scored)], k)
        totals[i] = total
    return totals


@pytest.mark.parametrize("seed", [1, 2])
def test_sweep_with_pruned_candidates(spark, seed):
    rows = make_features(seed, 400)
    texts = {0: "plain query", 1: "a question?", 2: "ab"}
    rng = random.Random(seed)
    relevant = {q: set(rng.sample([r[1] for r in rows if r[0] == q], 150)) for q in texts}
    features = spark.createDataFrame(rows, FEATURES)
    queries = spark.createDataFrame(list(texts.items()), "query_id bigint, query string")
    qrels = spark.createDataFrame(
        [(q, d) for q, ids in relevant.items() for d in ids], "query_id bigint, doc_id bigint")
    params = ev.random_parameters(spark, 12, seed, end_points=True).unionByName(
        ev.random_parameters(spark, 5, seed).withColumn("param_id", F.col("param_id") + 100))
    settings = {r.param_id: r.asDict() for r in params.collect()}
    for k in (3, 10):
        totals = ev.parameter_sweep(features, queries, qrels, params, k)
        found = {r.param_id: r.total_ap for r in totals.collect()}
        assert found == pytest.approx(python_sweep(rows, texts, relevant, settings, k))
        assert ev.sweep_candidates(features, k, 0.5).count() < len(rows)
    # Without positive weights only rows behind k of equal priors go, and totals stay exact.
    assert ev.sweep_candidates(features, 3, 0.5).count() <= ev.sweep_candidates(features, 3, 0.0).count()
    none = params.withColumn("k3", F.lit(0.0)).withColumn("k4", F.lit(-1.0))
    settings = {r.param_id: r.asDict() for r in none.collect()}
    found = {r.param_id: r.total_ap for r in ev.parameter_sweep(features, queries, qrels, none, 3).collect()}
    assert found == pytest.approx(python_sweep(rows, texts, relevant, settings, 3))


def test_sweep_takes_any_number_of_settings(spark):
    """20,000 settings, few of them distinct, and the same through the salted join."""
    rows = make_features(5, 60)
    texts = {0: "plain query", 1: "a question?", 2: "ab"}
    relevant = {q: {r[1] for r in rows if r[0] == q and r[1] % 2} for q in texts}
    features = spark.createDataFrame(rows, FEATURES)
    queries = spark.createDataFrame(list(texts.items()), "query_id bigint, query string")
    qrels = spark.createDataFrame(
        [(q, d) for q, ids in relevant.items() for d in ids], "query_id bigint, doc_id bigint")
    params = ev.random_parameters(spark, 20_000, 3, end_points=True)
    totals = {r.param_id: r.total_ap for r in ev.parameter_sweep(features, queries, qrels, params, 5).collect()}
    some = {r.param_id: r.asDict() for r in params.where("param_id % 1999 = 0").collect()}
    expected = python_sweep(rows, texts, relevant, some, 5)
    assert len(totals) == 20_000 and {i: totals[i] for i in some} == pytest.approx(expected)
    small = params.where("param_id % 1999 = 0")
    batch = QueryBatch(queries, max_rows=1)
    salted = {r.param_id: r.total_ap for r in ev.parameter_sweep(features, batch, qrels, small, 5).collect()}
    assert salted == pytest.approx(expected)


def test_sweep_splits_a_query_with_most_rows(spark):
    """Distinct priors, one query with 80 % of the rows, nothing broadcast: no task holds them."""
    n = 100_000
    features = spark.range(n).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id")).cast("bigint").alias("query_id"),
        F.col("id").alias("doc_id"), F.lit(None).cast("int").alias("bm25_rank"),
        F.lit(1).cast("bigint").alias("title_words"), F.lit("a").alias("title_first"),
        F.lit(0).cast("bigint").alias("anchor_words"), F.lit(None).cast("string").alias("anchor_first"),
        (0.5 + F.col("id") * 1e-14).alias("pr"), F.lit(1.0).alias("pv"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = ev.sweep_candidates(features, 40, 0.5)
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) > 0.8 * n and max(sizes) < 0.4 * n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_parameters(spark):
    drawn = ev.random_parameters(spark, 50, 9).collect()
    for r in drawn:
        for name, (low, high) in ev.RANGES.items():
            assert low <= r[name] <= high
    assert drawn == ev.random_parameters(spark, 50, 9).collect()
    assert drawn != ev.random_parameters(spark, 50, 10).collect()
    ends = ev.random_parameters(spark, 50, 9, end_points=True)
    assert {r["k1"] for r in ends.collect()} == {500.0, 2000.0}
    assert [r.b for r in ev.parameter_starts(spark).orderBy("param_id").collect()] == [90, 80, 100]
    totals = spark.createDataFrame([(1, 2.0), (2, 3.5), (3, 3.5), (4, 0.0)], "param_id bigint, total_ap double")
    assert ev.best_parameters(totals).first()["param_id"] == 2
    assert ev.best_parameters(totals.where("total_ap = 0")).count() == 0
