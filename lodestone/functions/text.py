"""Tokenising, hashing and query predicates as column expressions."""

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: one '#', '@' or word character, then 2 to 24 word characters, each
# with an optional apostrophe or hyphen before it. Unicode classes are spelled out
# because \w covers ASCII only in Java.
TOKEN_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}"

# The same tokens, by a loop where Java would recurse: nothing follows that a shorter match could serve.
_FAST_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?+[\p{L}\p{N}_]){2,24}+"

# First words that mark a question.
QUESTION_WORDS = ["What", "Which", "Who", "Where", "Why", "When", "How", "Whose"]


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """Lower-cased tokens of a text, in order, as an array."""
    return F.regexp_extract_all(F.lower(_column(text)), F.lit(_FAST_PATTERN), F.lit(0))


def remove_stopwords(tokens, words) -> Column:
    """Drop the given words from a token array; order and repeats stay."""
    words = list(words)
    return F.filter(_column(tokens), lambda token: ~token.isin(words))


def text_hash(text) -> Column:
    """40-bit hash of a string, the first ten hex digits of its MD5."""
    digits = F.substring(F.md5(_column(text).cast("binary")), 1, 10)
    return F.conv(digits, 16, 10).cast("bigint")


def term_bucket(term, n=124) -> Column:
    """Bucket of a term, 0 to n-1: its ``text_hash`` modulo n, of which a power of two needs the last digits only."""
    digits = next((d for d in range(1, 10) if 16**d % n == 0), 10)
    last = F.substring(F.md5(_column(term).cast("binary")), 11 - digits, digits)
    return F.pmod(F.conv(last, 16, 10).cast("bigint"), F.lit(n).cast("bigint"))


def bucket_of(term: str, n=124) -> int:
    """Same value as :func:`term_bucket`, for a term known while planning."""
    return int(hashlib.md5(term.encode("utf-8")).hexdigest()[:10], 16) % n


def is_question(query, question_words=False) -> Column:
    """True if the query ends with '?'; optionally also if it starts with a question word."""
    query = _column(query)
    ends = query.endswith("?")
    if not question_words:
        return ends
    return ends | F.substring_index(query, " ", 1).isin(QUESTION_WORDS)


def is_short_query(query) -> Column:
    """True for fewer than four characters and no '?' at the end."""
    query = _column(query)
    return (F.length(query) < 4) & ~query.endswith("?")
