"""Reading the article corpus."""

import fnmatch
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.runtime import hadoop_path
from ..schemas import CORPUS


def _roots(spark: SparkSession, paths) -> set:
    """Folders that names are relative to, as file paths show them (encoded, without scheme)."""
    roots = set()
    for path in paths:
        pattern, files = hadoop_path(spark, path)
        found = files.globStatus(pattern) or []
        if not len(found):
            raise FileNotFoundError(f"nothing at {path}")
        for status in found:
            place = status.getPath()
            # What a pattern matched, and a file, are named from the folder that holds them.
            if re.search(r"[*?\[{]", path) or not status.isDirectory():
                place = place.getParent()
            roots.add(place.toUri().getRawPath().rstrip("/"))
    return roots


def read_corpus(spark: SparkSession, paths, exclude=()) -> DataFrame:
    """Scan Parquet articles under ``paths``, leaving out some files.

    ``exclude`` holds shell globs matched against file names relative to the
    folder they were found in (for a path with wildcards, the folder that holds
    what it matched); '*' also spans sub-folders. The test is on file metadata
    alone, so Spark drops excluded files while listing and never opens them.
    Paths may be relative and hold blanks; one that matches nothing is an error.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    roots = _roots(spark, paths)
    corpus = (
        spark.read.schema(CORPUS).option("recursiveFileLookup", "true").parquet(*paths)
    )
    place = F.regexp_replace(F.col("_metadata.file_path"), "^[^:/]+:(?://[^/]*)?", "")
    for root in sorted(roots):
        name = F.url_decode(F.replace(F.substr(place, F.lit(len(root) + 2)), F.lit("+"), F.lit("%2B")))
        for glob in exclude:
            corpus = corpus.where(
                ~(place.startswith(f"{root}/") & name.rlike("^" + fnmatch.translate(glob))))
    return corpus


def corpus_count(corpus: DataFrame) -> DataFrame:
    """Number of articles."""
    return corpus.agg(F.count("*").alias("n"))


def project_field(corpus: DataFrame, field: str) -> DataFrame:
    """The id and one field, as (doc_id, <field>)."""
    return corpus.select(F.col("id").alias("doc_id"), field)
