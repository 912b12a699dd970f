"""From documents to packed sequences in five stages, each an operator of lodestone.llm.

A stage gets the documents its predecessor kept and returns those it keeps, with the columns
of documents; the last returns packed pieces. :func:`run` writes each stage's rows to the
shared scratch folder and reads them back, so a lost executor costs one stage at most.
Rows without doc_id are kept or rejected by their own text in every stage. Of rows that
repeat a doc_id with the same text, near-dedup keeps one.
"""

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import decontaminate, near_dedup, packing, quality_rules, substring_dedup
from lodestone.llm.tables import stored, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.passing(docs)


# Stages on word shingles take five words and a similarity of 0.8; op5 has a contract of its own.
# 32 bands of 5 miss a pair at 0.8 with probability 3e-6.
NEAR = near_dedup.NearDedup(shingle=5, percent=80)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_dedup.representatives(docs, NEAR)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur in an earlier one."""
    return substring_dedup.without_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", rules),
    ("near-dedup", near),
    ("substring dedup", passages),
    ("decontamination", benchmark),
    ("packing", packed),
]

# Fertility bands, edit distances and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
