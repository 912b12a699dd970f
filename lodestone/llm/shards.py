"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring, and a document falls on the arc before the point
that follows its hash. A shard takes no more rows than its bound; the rest of an arc goes
on clockwise to the shards of the following points. With the bounds used here, equal to
the mean and adding up to the number of rows, counts differ by one at most (law ``rows``).

Only row counts per arc reach the driver, as many as the ring has points. Rows are
numbered inside their arc in blocks, and ranges of these numbers go to shards; a doc_id
that is repeated or null (hashed as such) by a third of all rows is no hot key. Null
texts have size 1 and the checksum of no bytes.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, stored


@dataclass(frozen=True)
class Ring:
    shards: int = 16
    points: int = 64
    seed: int = 17


def ring_points(spark, ring: Ring) -> list:
    """(position, shard) of every virtual node, clockwise."""
    nodes = spark.range(ring.shards).select(
        F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(ring.points - 1))).alias("point"))
    placed = nodes.select(F.xxhash64("shard", "point", F.lit(ring.seed)).alias("position"), "shard")
    return sorted((r["position"], r["shard"]) for r in placed.collect())


def bounds(total: int, shards: int) -> list:
    return [total // shards + (s < total % shards) for s in range(shards)]


def fill(counts: list, owners: list, limits: list) -> list:
    """Ranges (arc, first, last, shard, slot) that meet the limits; ``last`` is exclusive.

    All arcs first fill the shard of their own point, clockwise from the ring's start;
    what is left moves on point by point.
    """
    left, taken, room = list(counts), [0] * len(counts), list(limits)
    used, ranges = [0] * len(limits), []
    waiting = [a for a, n in enumerate(left) if n]
    for step in range(len(owners)):
        for arc in waiting:
            shard = owners[(arc + step) % len(owners)]
            n = min(left[arc], room[shard])
            if n:
                ranges.append((arc, taken[arc], taken[arc] + n, shard, used[shard]))
                left[arc] -= n
                taken[arc] += n
                room[shard] -= n
                used[shard] += n
        waiting = [arc for arc in waiting if left[arc]]
        if not waiting:
            break
    return ranges


def _arc_of(points: list, position):
    """Index of the first point not before a position; past the last the ring starts anew.

    A table of the ring's points sorted with the rows would shuffle them, so the points
    (as many as the parameters say) are a literal that a binary search walks.
    """
    cuts = F.array(*[F.lit(p) for p, _ in points])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(points).bit_length()))])
    before = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= len(points)) & (F.get(cuts, n + step - 1) < position), n + step).otherwise(n))
    return before % len(points)


def assign_shards(docs: DataFrame, ring: Ring | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    ring = ring or Ring()
    spark = docs.sparkSession
    points = ring_points(spark, ring)
    text = F.coalesce(F.col("text"), F.lit(""))
    position = F.xxhash64(F.col("doc_id"), F.lit(ring.seed))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), position.alias("position"))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "sizes")
    rows = rows.withColumn("arc", _arc_of(points, F.col("position")))
    counts = {r["arc"]: r["count"] for r in rows.groupBy("arc").count().collect()}
    total = sum(counts.values())
    ranges = fill([counts.get(a, 0) for a in range(len(points))], [s for _, s in points], bounds(total, ring.shards))
    plan = spark.createDataFrame(ranges, "arc int, low long, high long, shard int, base long")
    placed = numbered(rows, ["arc"], ["position"], many=max(counts.values(), default=0))
    return (
        placed.join(F.broadcast(plan), "arc")
        .where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                (F.col("base") + F.col("place") - F.col("low")).alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )
