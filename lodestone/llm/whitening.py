"""Whitening of embeddings by a covariance weighted with multiplicities.

Vectors are turned into whole numbers and grouped: a distinct vector is kept once, with the
number of its copies. Sums are exact. The covariance is a weighted product of the distinct,
centred vectors, made batch by batch inside tasks; tasks return one square matrix each, whose
rows are added up apart from each other. Only the finished matrix, whose size follows the
number of dimensions, comes to the driver for its eigenvectors. Each distinct vector is
whitened once and joined back to its copies: vectors with very many copies are few and
broadcast, so no task meets more copies of a vector than a small share of all rows.

Rows whose vector is null, or holds a null, NaN or infinite entry, are left out. Shorter
vectors are filled up with zeros to the longest. Entries beyond about 1.4e17 are cut there,
so that their whole numbers fit a long. Components without variance, as those of equal vectors,
have no scale and are left out; empty tables and tables of empty vectors give no rows. A
deviation beyond a long is null. Repeated rows and null ids count and return each by
themselves. Other columns are not read.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import in_arrow, stored

SCALE, SHIFT = 64.0, 1_000_000
FURTHEST = 9e18
BATCH_CELLS = 1 << 20

WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")


@dataclass(frozen=True)
class Whitening:
    """``components`` to return; with ``multiplicity`` off every distinct vector weighs one in the fit.

    A vector with more copies than a ``hot_share``-th of all rows, and at least ``hot_rows``, is
    broadcast: there are ``hot_share`` of them at most.
    """

    components: int = 32
    multiplicity: bool = True
    hot_share: int = 100_000
    hot_rows: int = 1_000


def whole_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the entries that remain, as whole numbers."""
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col(column).cast("array<double>").alias("vector"))
        .where(F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(False)))
        .select("vec_id", F.transform("vector", _whole).alias("x"))
    )


def _whole(v):
    near = F.greatest(F.least(v, F.lit(FURTHEST / SCALE)), F.lit(-FURTHEST / SCALE))
    return (F.floor(near * SCALE) + SHIFT).cast("long")


def _code():
    """128 bits that stand for a vector in joins."""
    return F.substring(F.sha2(F.array_join("x", ",").cast("binary"), 256), 1, 32)


def _blocks(batch, name, dims):
    """(rows, matrix) of a batch's vectors, filled up to ``dims``, a bounded number of cells at a time."""
    column = batch.column(name)
    step = max(1, BATCH_CELLS // max(1, dims))
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        flat, ends = part.flatten().to_numpy(zero_copy_only=False), np.diff(part.offsets.to_numpy())
        if len(part) and (ends == dims).all():
            yield at, flat.reshape(len(part), dims)
            continue
        fill = SHIFT if pa.types.is_integer(part.type.value_type) else 0.0
        full = np.full((len(part), dims), fill, flat.dtype)
        full[np.arange(dims) < ends[:, None]] = flat
        yield at, full


def vector_sums(distinct: DataFrame, dims: int) -> tuple[int, list]:
    """Exact weighted count and sums per dimension of (x, weight)."""
    def sums(batches):
        count, total = 0, [0] * dims
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            count += int(weights.sum())
            for at, x in _blocks(batch, "x", dims):
                w = weights[at : at + len(x)]
                safe = int(np.abs(x).max()) * int(w.sum()) < 1 << 62
                part = (w @ x if safe else w.astype(object) @ x.astype(object)).tolist()
                total = [a + b for a, b in zip(total, part)]
        yield pa.record_batch([pa.array([-1, *range(dims)], pa.int32()),
                               pa.array([str(v) for v in (count, *total)])], ["place", "total"])

    parts = in_arrow(distinct.select("x", "weight"), sums, "place int, total string")
    rows = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {r["place"]: int(r["total"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dims)]


def centred_product(rows: DataFrame, column: str, dims: int, centre) -> np.ndarray:
    """Sum over rows of weight * (v - c) (v - c)^T, ``centre`` turning a block into v - c.

    A task keeps one matrix. Its rows are added up apart from those of other places, so a
    task of the sum holds a share of one matrix, whatever the number of tasks.
    """
    def products(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            weights = batch.column("weight").to_numpy().astype(float)
            for at, block in _blocks(batch, column, dims):
                moved = centre(block)
                total += (moved * weights[at : at + len(block), None]).T @ moved
        yield pa.record_batch([pa.array(range(dims), pa.int32()),
                               pa.array(list(total), pa.list_(pa.float64()))], ["place", "cells"])

    def added(batches):
        sums: dict = {}
        for batch in batches:
            for place, cells in zip(batch.column("place").to_pylist(), batch.column("cells")):
                values = cells.values.to_numpy()
                sums[place] = sums[place] + values if place in sums else values
        yield pa.record_batch([pa.array(list(sums), pa.int32()),
                               pa.array(list(sums.values()), pa.list_(pa.float64()))], ["place", "cells"])

    kind = "place int, cells array<double>"
    parts = in_arrow(rows.select(column, "weight"), products, kind).repartition("place")
    total = np.zeros((dims, dims))
    for r in in_arrow(parts, added, kind).collect():
        total[r["place"]] = r["cells"]
    return total


def components_of(covariance: np.ndarray, most: int):
    """(falling eigenvalues, their unit eigenvectors as rows, shares of the trace).

    An eigenvector's largest entry is positive. Values that rounding cannot tell from zero
    are left out.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most], vectors.T[::-1][:most]
    trace = float(np.trace(covariance))
    real = values > max(trace, 0.0) * len(covariance) * 1e-13
    values, vectors = values[real], vectors[real]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)]) if len(vectors) else np.ones(0)
    return values, vectors * signs[:, None], values / trace if trace else values


@dataclass(frozen=True)
class Moments:
    """Exact count and sums of the fit list, with the components of its covariance."""

    n: int
    sums: tuple
    scales: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(float) / self.n

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: in longs where they hold it, in Python's numbers elsewhere."""
        largest = max(int(np.abs(x).max()) if x.size else 0, 1) * self.n + max(map(abs, self.sums), default=0)
        if largest < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> list:
        moved = self.scaled(x)
        top = max(abs(int(moved.max())), abs(int(moved.min()))) if moved.size else 0
        if top * top * max(1, moved.shape[1]) < 1 << 63:
            return (moved * moved).sum(1).tolist()
        exact = [int(v) for v in (moved.astype(object) ** 2).sum(1)]
        return [v if v < 1 << 63 else None for v in exact]


def fitted(distinct: DataFrame, dims: int, how: Whitening) -> Moments:
    """Count, sums and components of (x, weight)."""
    n, sums = vector_sums(distinct, dims)
    centred = Moments(n, tuple(sums), np.zeros(0), np.zeros((0, dims)), np.zeros(0)).centred
    covariance = centred_product(distinct, "x", dims, centred) / n
    values, vectors, explained = components_of(covariance, how.components)
    return Moments(n, tuple(sums), np.sqrt(values), vectors, explained)


def whitened_vectors(distinct: DataFrame, moments: Moments, *keys: str) -> DataFrame:
    """(keys, weight, deviation, white): every distinct vector whitened."""
    dims = len(moments.sums)

    def white(batches):
        for batch in batches:
            found, deviations = [], []
            for _, x in _blocks(batch, "x", dims):
                found.extend(moments.centred(x) @ moments.vectors.T / moments.scales)
                deviations.extend(moments.deviations(x))
            others = [batch.column(k) for k in (*keys, "weight")]
            yield pa.record_batch([*others, pa.array(deviations, pa.int64()),
                                   pa.array(list(found), pa.list_(pa.float64()))], [*keys, "weight", "deviation", "white"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.select(*keys).schema)
    return in_arrow(distinct.select(*keys, "x", "weight"), white,
                    f"{kinds}, weight long, deviation long, white array<double>")


def identity_error(white: DataFrame, n: int, many: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    weight = F.col("weight")
    means = white.select(*[F.sum(F.col("white")[k] * weight).alias(f"m{k}") for k in range(many)]).first()
    mean = np.array([m or 0.0 for m in means]) / n
    covariance = centred_product(white, "white", many, lambda v: v - mean) / n
    return float(np.abs(covariance - np.eye(many)).max())


def whiten(embeddings: DataFrame, how: Whitening = Whitening(), column: str = "embedding") -> DataFrame:
    """One row per remaining row and component, as ``op13`` defines it."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, column)
    weight = F.count("*") if how.multiplicity else F.lit(1).cast("long")
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies"), weight.alias("weight"))
                      .withColumn("code", _code()), "vectors")
    size = distinct.agg(F.max(F.size("x")), F.sum("copies")).first()
    dims, n_rows = size[0] or 0, size[1] or 0
    if not dims:
        return spark.createDataFrame([], WHITENED)
    moments = fitted(distinct, dims, how)
    many = len(moments.scales)
    if not many:
        return spark.createDataFrame([], WHITENED)
    white = stored(whitened_vectors(distinct, moments, "code", "copies"), "white")
    error = identity_error(white, moments.n, many)
    hot = F.col("copies") > max(how.hot_rows, n_rows // how.hot_share)
    told = ["code", "deviation", "white"]
    coded = rows.select("vec_id", _code().alias("code"))
    few = coded.join(F.broadcast(white.where(hot).select(*told)), "code", "left")
    # Rows of hot vectors are done; the others meet their vector in a shuffle.
    rare = (few.where("white is null").select("vec_id", "code")
            .join(white.where(~hot).select(*told), "code"))
    every = few.where("white is not null").unionByName(rare)
    shares = F.array(*[F.lit(float(v)) for v in moments.explained])
    return every.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(moments.n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))
