"""Relevance judgments as JSON objects {query: [document ids]}."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_qrels(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per judged (query, doc_id).

    Every line is one JSON object, which covers a file with a single object on
    one line as well as many objects. ``multi_line`` takes each file as one
    object that may be laid out over several lines. Blank lines are skipped; a
    line that is no such object ends the job with an error.
    """
    entries = spark.read.text(path, wholetext=multi_line).where(F.trim("value") != "").select(
        F.explode(F.from_json("value", "map<string,array<bigint>>", {"mode": "FAILFAST"}))
        .alias("query", "ids")
    )
    return entries.select("query", F.explode("ids").alias("doc_id"))


def write_qrels(qrels: DataFrame, path: str, span: int = 1_000_000) -> None:
    """Write distinct (query, doc_id) rows as lines of JSON objects.

    A query's judgments are spread over one object per ``span`` of document ids,
    so an object never holds more than ``span`` ids.
    """
    (
        qrels.groupBy("query", F.floor(F.col("doc_id") / span).alias("part"))
        .agg(F.sort_array(F.collect_set("doc_id")).alias("ids"))
        .select(F.to_json(F.create_map("query", "ids")).alias("value"))
        .write.mode("overwrite").text(path)
    )
