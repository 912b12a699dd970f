"""Link graph and PageRank."""

from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.runtime import stored_table
from ..plans.sizing import MAX_BROADCAST_ROWS
from .indexing import explode_anchors


EDGES_A_PARTITION = 5_000_000


def link_edges(corpus: DataFrame) -> DataFrame:
    """Distinct (src, dst) of all links; self-links stay."""
    return explode_anchors(corpus).select("src", "dst").distinct()


def link_vertices(corpus: DataFrame) -> DataFrame:
    """Distinct ids of articles and link targets, in the corpus or not."""
    targets = explode_anchors(corpus).select(F.col("dst").alias("id"))
    return corpus.select("id").unionByName(targets).distinct()


def link_graph(corpus: DataFrame):
    """Edges and vertices."""
    return link_edges(corpus), link_vertices(corpus)


def edge_vertices(edges: DataFrame) -> DataFrame:
    """Distinct ids on either side of an edge."""
    sources = edges.select(F.col("src").alias("id"))
    return sources.unionByName(edges.select(F.col("dst").alias("id"))).distinct()


def partition_graph(edges: DataFrame, n: int = 124) -> DataFrame:
    """Edges hash-partitioned by source."""
    return edges.repartition(n, "src")


def pagerank(edges: DataFrame, vertices: DataFrame | None = None, reset=0.15, iters=6,
             partitions=None, heavy_degree=1_000_000, checkpoint_every=3) -> DataFrame:
    """(id, pagerank) after a fixed number of iterations.

    Without ``vertices`` the vertices are the ends of the edges.

    Partitions follow the number of edges if not given. Ranks start at 1; each round sets r = reset + (1 - reset) * sum of the
    in-neighbours' r / out-degree. Pages without links pass nothing on. At the
    end ranks are scaled to sum to the number of vertices.

    Edges are partitioned and sorted by source and vertices by id once, so an
    iteration shuffles only contributions, summed per task before they move. Sources with
    more than ``heavy_degree`` links would overload their partition: their edges
    stay spread out and meet a broadcast of those few ranks, of which there are
    fewer than edges / heavy_degree. Edges, vertices and, every few rounds, ranks
    are stored in the scratch folder, so that a lost executor costs no earlier round again;
    a scratch scope around the call and the use of its result removes them.
    """
    spark = edges.sparkSession
    store = StorageLevel.MEMORY_AND_DISK

    edges = stored_table(edges.select("src", "dst"), "edges")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = partitions or max(least, ceil(edges.count() / EDGES_A_PARTITION))
    vertices = edge_vertices(edges) if vertices is None else vertices
    degrees = edges.groupBy("src").agg(F.count("*").alias("degree"))
    placed = vertices.select("id").join(degrees, F.col("id") == F.col("src"), "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree"))
    state = (
        stored_table(placed, "vertices")
        .repartition(partitions, "id")
        .sortWithinPartitions("id")
        .persist(store)
    )
    size = state.agg(
        F.count("*").alias("vertices"),
        F.coalesce(F.sum("degree"), F.lit(0)).alias("edges"),
        F.coalesce(F.max("degree"), F.lit(0)).alias("most"),
    ).first()
    # Keeps the broadcast of heavy sources within its bound.
    heavy_degree = max(heavy_degree, ceil(size["edges"] / MAX_BROADCAST_ROWS))

    if size["most"] > heavy_degree:
        heavy_ids = state.where(F.col("degree") > heavy_degree).select(F.col("id").alias("src"))
        light = edges.join(F.broadcast(heavy_ids), "src", "left_anti")
        heavy = edges.join(F.broadcast(heavy_ids), "src", "left_semi")
    else:
        light, heavy = edges, None
    light = partition_graph(light, partitions).sortWithinPartitions("src").persist(store)

    ranks = state.withColumn("rank", F.lit(1.0))
    for step in range(1, iters + 1):
        shares = ranks.where(F.col("degree") > 0).select(
            F.col("id").alias("src"), "degree", (F.col("rank") / F.col("degree")).alias("share")
        )
        passed = light.join(shares, "src").select("dst", "share")
        if heavy is not None:
            large = F.broadcast(shares.where(F.col("degree") > heavy_degree))
            passed = passed.unionByName(heavy.join(large, "src").select("dst", "share"))
        received = passed.groupBy("dst").agg(F.sum("share").alias("received"))
        ranks = state.join(received, F.col("id") == F.col("dst"), "left").select(
            "id", "degree",
            (reset + (1 - reset) * F.coalesce("received", F.lit(0.0))).alias("rank"),
        )
        if step % checkpoint_every == 0 or step == iters:
            ranks = stored_table(ranks, "ranks")
    for frame in (light, state):
        frame.unpersist()

    total = ranks.agg(F.sum("rank")).scalar()
    return ranks.select("id", (F.col("rank") * F.lit(size["vertices"]) / total).alias("pagerank"))


def sort_ranks(ranks: DataFrame) -> DataFrame:
    return ranks.orderBy(F.desc("pagerank"), "id")
