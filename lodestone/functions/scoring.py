"""Scoring formulas and fusion weights as column expressions."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Weights:
    """Weights of the hybrid ranking."""

    # Fixed values.
    rank_decay: float = 149.15920831630416
    rank_decay_question: float = 1304.4103830767667
    title_bonus: float = 5.193904691848007
    title_bonus_short: float = 59.41622193605568
    anchor_bonus: float = 4.548782213371328
    pagerank_scale: float = 1.5
    pageview_scale: float = 0.75


DEFAULT_WEIGHTS = Weights()

# BM25 constants.
BM25_K1, BM25_B, BM25_K2 = 1.0, 0.9, 10.0


def bm25_idf(df: Column, n) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25_term_score(idf, tf, dl, avgdl, k1=BM25_K1, b=BM25_B, k2=BM25_K2) -> Column:
    """Score of one term in one document; k2 saturates the document's tf once more."""
    saturated = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
    return saturated * ((k2 + 1) * tf / (k2 + tf))


def cosine_idf(df: Column, n) -> Column:
    return F.log2(n / df)


def pagerank_factor(pagerank: Column) -> Column:
    """Whole part of log10 above 1, else the value itself; a missing rank is neutral.

    Ranks between 1 and 10 give 0, which zeroes the whole score.
    """
    return (
        F.when(pagerank.isNull(), F.lit(1.0))
        .when(pagerank > 1, F.log10(pagerank).cast("bigint").cast("double"))
        .otherwise(pagerank)
    )


def pageview_factor(views: Column) -> Column:
    """Whole part of log2 above 1, 1 for one view, 2 for none or an unknown page."""
    views = F.coalesce(views, F.lit(0))
    return (
        F.when(views > 1, F.log2(views).cast("bigint").cast("double"))
        .when(views < 1, F.lit(2.0))
        .otherwise(F.lit(1.0))
    )
