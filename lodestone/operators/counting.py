"""Counting tokens by vector operations on Arrow batches, in the order of a stored index."""

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.arrow import in_arrow

PLACED_POSTINGS = "term string, doc_id long, tf long, head struct<dl: long, nf: long>, bucket long"
# Postings that a task hands back at a time.
ROWS_OUT = 100_000


def placed_postings(docs: DataFrame, n_buckets: int, stopwords=()) -> DataFrame:
    """Marked postings of (doc_id, tokens) with their bucket, without a shuffle.

    As ``count_tokens(docs, marked=True)`` without the stopwords and with ``term_bucket``.
    A batch of documents (10,000 or 64 MB by Spark's settings) is counted at once, each of its
    distinct terms hashed once, and its postings leave in the order bucket, term, document:
    a sort behind a shuffle merges a few long runs instead of single rows.
    """
    words = list(stopwords)
    docs = docs.select(F.col("doc_id").cast("long"), "tokens")
    return in_arrow(docs, lambda batches: _placed(batches, n_buckets, words), PLACED_POSTINGS)


def _placed(batches, n_buckets: int, stopwords: list):
    dropped = pa.array(stopwords, pa.string())
    for batch in batches:
        ids, tokens = batch.column("doc_id"), batch.column("tokens")
        if not len(ids):
            continue
        words = pc.list_flatten(tokens).dictionary_encode()
        terms, rows = words.dictionary, len(ids)
        buckets = np.array([int.from_bytes(md5(term).digest()[:5], "big") % n_buckets
                            for term in terms.cast(pa.binary()).to_pylist()], np.int64)
        by_term = pc.array_sort_indices(terms).to_numpy()
        order = by_term[np.argsort(buckets[by_term], kind="stable")]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_id = np.argsort(ids.fill_null(0).to_numpy(), kind="stable")
        row = np.empty(rows, np.int64)
        row[by_id] = np.arange(rows)
        # One number per token: the place of its term, then that of its document.
        codes = words.indices.to_numpy()
        keys = place[codes] * rows + row[pc.list_parent_indices(tokens).to_numpy()]
        unwanted = pc.is_in(terms, value_set=dropped).to_numpy(zero_copy_only=False)
        if unwanted.any():
            keys = keys[~unwanted[codes]]
        keys, tf = np.unique(keys, return_counts=True)
        at = keys % rows
        order = order[keys // rows]
        length, norm = (np.bincount(at, weights=x, minlength=rows).astype(np.int64) for x in (tf, tf * tf))
        first = np.full(rows, -1)
        first[at[::-1]] = np.arange(len(at))[::-1]
        for start in range(0, len(at), ROWS_OUT):
            some = slice(start, start + ROWS_OUT)
            row_at, term_at = at[some], order[some]
            plain = first[row_at] != np.arange(start, start + len(row_at))
            head = pa.StructArray.from_arrays(
                [pa.array(length[row_at]), pa.array(norm[row_at])], ["dl", "nf"], mask=pa.array(plain))
            yield pa.RecordBatch.from_arrays(
                [terms.take(pa.array(term_at)), ids.take(pa.array(by_id[row_at])),
                 pa.array(tf[some].astype(np.int64)), head, pa.array(buckets[term_at])],
                ["term", "doc_id", "tf", "head", "bucket"])
