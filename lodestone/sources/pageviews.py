"""Monthly page-view dumps."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PAGEVIEWS


def read_pageview_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text dump; bz2 files are split between tasks."""
    return spark.read.text(path)


def parse_pageview_line(lines: DataFrame, project: str = "en.wikipedia") -> DataFrame:
    """Article id (third field) and monthly total (fifth field) of one project's lines.

    The project is matched as a prefix. Lines whose two values are not all
    digits, or too long for a 64-bit number, are dropped.
    """
    fields = F.split("value", " ")
    digits = r"^[0-9]+$"
    return (
        lines.where(F.col("value").rlike("^" + re.escape(project)))
        .select(F.get(fields, 2).alias("doc_id"), F.get(fields, 4).alias("views"))
        .where(F.col("doc_id").rlike(digits) & F.col("views").rlike(digits))
        .select(F.col("doc_id").try_cast("bigint").alias("doc_id"),
                F.col("views").try_cast("bigint").alias("views"))
        .dropna()
    )


def pageviews_by_article(views: DataFrame) -> DataFrame:
    """Total views per article; an article has a line per access channel and title."""
    return views.groupBy("doc_id").agg(F.sum("views").alias("views"))


def write_pageviews(views: DataFrame, path: str) -> None:
    views.write.mode("overwrite").parquet(path)


def read_pageviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGEVIEWS).parquet(path)
