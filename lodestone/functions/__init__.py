from .stopwords import ENGLISH, index_stopwords, query_stopwords
from .text import (
    TOKEN_PATTERN,
    bucket_of,
    is_question,
    is_short_query,
    remove_stopwords,
    term_bucket,
    text_hash,
    tokenize,
)
from .scoring import (
    DEFAULT_WEIGHTS,
    Weights,
    bm25_idf,
    bm25_term_score,
    cosine_idf,
    pagerank_factor,
    pageview_factor,
)

__all__ = [
    "ENGLISH", "index_stopwords", "query_stopwords",
    "TOKEN_PATTERN", "bucket_of", "is_question", "is_short_query", "remove_stopwords",
    "term_bucket", "text_hash", "tokenize",
    "DEFAULT_WEIGHTS", "Weights", "bm25_idf", "bm25_term_score", "cosine_idf",
    "pagerank_factor", "pageview_factor",
]
