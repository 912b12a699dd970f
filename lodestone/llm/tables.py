"""Stored intermediate tables, blocked numbering and connected components."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import plans
from ..plans import own_scratch, scratch_path

# A batch stands in memory four times at least: as Spark's vectors, serialised, in the worker and in its slices.
BATCH_BYTES = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over batches of a few MB, unless the session sets a size of its own.

    Operators cut batches into slices of that size anyway; Spark's 64 MB would only be held.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return plans.in_arrow(df, function, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there.

    The table goes with the scratch scope it was stored in, if there is one.
    """
    path = own_scratch(scratch_path(df.sparkSession, "llm", f"{name}-{uuid4().hex}"))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, keys, order, rows_a_block: int = 20_000, into: str = "place",
             weight=None, many: int | None = None) -> DataFrame:
    """Number the rows of every key from 0 without gathering a key in one task.

    ``df`` must be a stored table with a column ``uid``, unique per row. Rows are dealt to
    blocks by a hash of it, numbered inside their block, and a block starts where the
    smaller blocks of its key end. With ``weight`` the number is the sum of the weights
    of the rows before.
    """
    rows = df.count() if many is None else many
    blocks = max(1, -(-rows // rows_a_block))
    value = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    df = df.withColumn("_block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    sizes = df.groupBy(*keys, "_block").agg(F.sum(value).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b"),
                          F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_block").orderBy(*order, "uid").rowsBetween(Window.unboundedPreceding, -1)
    on = F.col("_block") == F.col("_b")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, on)
        .withColumn(into, F.col("_start") + F.col("_in"))
        .drop("_block", "_b", "_start", "_in", *[f"_k{i}" for i in range(len(keys))])
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of an edge table (a, b): root is the smallest id reachable.

    Large-star and small-star rounds on a stored edge table; a round is two aggregates
    and two joins, and their number grows with the logarithm of the vertices.
    """
    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "edges")
    last = mark(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "b")).where("a <> b").distinct(), "edges")
        now = mark(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
