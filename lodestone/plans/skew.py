"""Joins on keys that may hold a large part of all rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(large: DataFrame, small: DataFrame, keys, deal_by: str, how: str = "inner",
                salts: int = 16) -> DataFrame:
    """Join that spreads every key of ``large`` over several tasks.

    Rows of ``large`` are dealt to ``salts`` groups per key by a hash of
    ``deal_by``, and ``small`` is repeated once per group. Both sides shuffle
    directly into the join, so adaptive execution can split what is still too
    large; it cannot where one side keeps the partitioning of an earlier
    aggregate or join on the same keys.
    """
    salt = F.pmod(F.xxhash64(deal_by), F.lit(salts)).cast("int")
    groups = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        large.withColumn("salt", salt)
        .join(small.withColumn("salt", groups), [*keys, "salt"], how)
        .drop("salt")
    )
