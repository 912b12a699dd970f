"""Physical layout of posting tables."""

from pyspark.sql import DataFrame

from ..functions.text import term_bucket


def cluster_by_bucket(postings: DataFrame, n_buckets: int | None = 124) -> DataFrame:
    """Add the bucket column and gather each bucket, sorted by term and document.

    Without ``n_buckets`` the postings bring the column along.

    The rebalance hint lets adaptive execution split a bucket that outgrows the
    advisory partition size and merge small ones, so a term holding a third of
    all postings spreads over many tasks and files.
    """
    if n_buckets is not None:
        postings = postings.withColumn("bucket", term_bucket("term", n_buckets))
    return (
        postings
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "term", "doc_id")
    )
