"""PageRank tables as gzip CSV."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PAGERANK


def write_rank_csv(ranks: DataFrame, path: str) -> None:
    """Write (doc_id, pagerank) as headerless gzip CSV, highest rank first.

    The sort is a range partitioning, so part files in name order hold the ranks
    in descending order and joining them gives the one sorted file; no task
    handles more than its range.
    """
    (
        ranks.select("doc_id", "pagerank")
        .orderBy(F.desc("pagerank"), "doc_id")
        .write.mode("overwrite").option("compression", "gzip").csv(path)
    )


def read_rank_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGERANK).csv(path)


def show_top_ranks(ranks: DataFrame, n: int = 20) -> DataFrame:
    """The n highest ranks, a report."""
    return ranks.orderBy(F.desc("pagerank"), "doc_id").limit(n)
