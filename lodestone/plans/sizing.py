"""Broadcasting only what has been measured to be small."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize

MAX_BROADCAST_ROWS = 1_000_000
# Rows (query, term, document) that one task of a search sums up.
TASK_ROWS = 2_000_000


def broadcast_if_bounded(df: DataFrame, rows: int, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if its known row bound is within the limit.

    Above it no hint is given: Spark then shuffles both sides and splits skewed
    partitions adaptively.
    """
    return F.broadcast(df) if rows <= limit else df


class QueryBatch:
    """A table (query_id, query) with its measured size.

    Rows and tokens are counted in one aggregate over the raw queries. They bound
    everything derived from them: a table of terms has at most one row per token,
    and a top-k result at most k rows per query.
    """

    def __init__(self, queries: DataFrame, max_rows=MAX_BROADCAST_ROWS):
        self.queries = queries
        self.max_rows = max_rows
        size = queries.agg(
            F.count("*").alias("rows"),
            F.coalesce(F.sum(F.coalesce(F.size(tokenize("query")), F.lit(0))), F.lit(0)).alias("tokens"),
        ).first()
        self.rows = size["rows"]
        self.terms_fit = max(self.rows, size["tokens"]) <= max_rows

    @classmethod
    def of(cls, queries) -> "QueryBatch":
        return queries if isinstance(queries, cls) else cls(queries)

    def broadcast_terms(self, df: DataFrame) -> DataFrame:
        """For tables with at most one row per query token."""
        return F.broadcast(df) if self.terms_fit else df

    def broadcast_rows(self, df: DataFrame) -> DataFrame:
        """For tables with at most one row per query."""
        return broadcast_if_bounded(df, self.rows, self.max_rows)

    def broadcast_results(self, df: DataFrame, k: int) -> DataFrame:
        """For tables with at most k rows per query."""
        return broadcast_if_bounded(df, self.rows * k, self.max_rows)
