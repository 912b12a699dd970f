"""Near-duplicate documents by one-permutation MinHash.

Every set of word shingles is hashed once. The range of the hash is cut into bins, a
bin's value is its smallest hash, and empty bins borrow from bins that a hash of the
bin's own number picks (optimal densification), so borrowed bins stay independent. Bins
make bands; documents with an equal band share a bucket.

Documents with equal sets are one class, so copies cost nothing further. Each bucket
offers star-shaped edges, from its smallest class to the others, and these are confirmed
on the full sets. Members of a centre's buckets that remain in different components could
still be linked with each other: they are compared exactly in the centre's group, by the
few shingles in which each differs from the centre, in blocks of bounded size, and only
links that join components leave the group. So no link within a bucket is lost to the
star shape, and no pair becomes a row before it is confirmed.

Null or empty texts have an empty set and are linked with nothing. Texts with fewer words
than a shingle have their whole sequence as the one element. A document id is one vertex:
rows that repeat it share a component, unless they are empty. Each different set is compared
once, however many rows repeat an id or its texts. A row without id is linked with nothing
and kept.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from .tables import components, in_arrow, stored
from .words import AS_IS, LOWER, Words, gram_codes, mix, slices, strings


@dataclass(frozen=True)
class NearDedup:
    """A pair at the threshold 0.85 misses all 32 bands of 5 with probability 1e-8."""

    shingle: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 5
    fold_case: bool = True
    block: int = 500


EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# What tells sets apart.
KEY = ("key_a", "key_b", "n_shingles")


def _class():
    """A class by its smallest document id and half of its key: few classes share an id."""
    return F.struct("id", "key_a").alias("cls")


def _one(x: int) -> np.uint64:
    return mix(np.array([x], np.uint64))[0]


def shingle_sets(words: Words, n: int):
    """For each text the sorted distinct hashes of its shingles."""
    codes, hashes, first = gram_codes(words.hash, n), words.hash, words.first
    for k in range(words.n):
        a, b = int(first[k]), int(first[k + 1])
        if b - a >= n:
            found = np.sort(codes[a : b - n + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) > 1 else found
        elif b > a:
            yield mix(gram_codes(hashes[a:b], b - a) + _one(b - a))
        else:
            yield np.zeros(0, np.uint64)


def one_permutation(sets, bins: int) -> np.ndarray:
    """Densified bins (one row per set, no set empty)."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    cell = owner * bins + ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    out = np.full(len(sets) * bins, EMPTY)
    np.minimum.at(out, cell, mix(values))
    out = out.reshape(len(sets), bins)
    filled = out != EMPTY
    row, col = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        pick = (mix(col.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, pick]
        out[row[hit], col[hit]] = out[row[hit], pick[hit]]
        row, col = row[~hit], col[~hit]
    return out


def band_codes(bins: np.ndarray, how: NearDedup) -> np.ndarray:
    shaped = bins.reshape(len(bins), how.bands, how.rows)
    code = np.zeros(shaped.shape[:2], np.uint64)
    for i in range(how.rows):
        code = mix(code + shaped[:, :, i] + np.uint64(i + 1))
    return mix(code + np.arange(1, how.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _signatures(batches, how: NearDedup):
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")), fold=LOWER if how.fold_case else AS_IS)
            sets = list(shingle_sets(words, how.shingle))
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            keys = np.zeros((2, len(sets)), np.uint64)
            bands = np.zeros((0, how.bands), np.uint64)
            if len(full):
                kept = [sets[i] for i in full]
                bands = band_codes(one_permutation(kept, how.bands * how.rows), how)
                for i, s in zip(full, kept):
                    keys[:, i] = _set_keys(s)
            offsets = np.concatenate([[0], np.cumsum((sizes > 0) * how.bands)])
            yield pa.RecordBatch.from_arrays([
                strings(part.column("doc_id")).cast(pa.int64()), pa.array(sizes),
                pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.reshape(-1).view(np.int64))),
            ], ["doc_id", "n_shingles", "key_a", "key_b", "bands"])


def _set_keys(s: np.ndarray):
    """128 bits that stand for a set."""
    return mix(s).sum(), mix(s + np.uint64(0xABCDEF)).sum()


def _sets(batches, how: NearDedup):
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")), fold=LOWER if how.fold_case else AS_IS)
            sets = list(shingle_sets(words, how.shingle))
            keys = np.array([_set_keys(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                strings(part.column("doc_id")).cast(pa.int64()),
                pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
            ], ["id", *KEY, "shingles"])


def class_sets(rows: DataFrame, classes: DataFrame, wanted: DataFrame, again: DataFrame, how: NearDedup) -> DataFrame:
    """(cls, shingles): the set of each wanted class, once.

    ``wanted`` are the ids whose texts are read, ``again`` the ids on several rows. Only those
    can bring a set twice, or that of another id's class: their rows are reduced to different
    texts, and then to one set for each class of theirs.
    """
    kinds = "id long, key_a long, key_b long, n_shingles long, shingles array<long>"
    texts = rows.join(wanted, "doc_id", "left_semi")
    once = in_arrow(texts.join(again, "doc_id", "left_anti"), lambda b: _sets(b, how), kinds)
    several = in_arrow(texts.join(again, "doc_id", "left_semi").distinct(), lambda b: _sets(b, how), kinds)
    several = several.join(classes, ["id", *KEY], "left_semi").groupBy("id", *KEY).agg(
        F.first("shingles").alias("shingles"))
    return once.unionByName(several).select(_class(), "shingles")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes with their set sizes, the size of the overlap, and what only one has.

    A class has one set, so a pair is one row.
    """
    left = sets.select(F.col("cls").alias("class_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("cls").alias("class_b"), F.col("shingles").alias("set_b"))
    return (
        pairs.join(left, "class_a").join(right, "class_b")
        .select("class_a", "class_b", F.col("class_a.id").alias("a"), F.col("class_b.id").alias("b"),
                F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"),
                F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a")).alias("odd"))
    )


def _similar(n_a, n_b, odd, percent: int):
    """100 * shared >= percent * either, from the sizes and the number of odd shingles."""
    return 100 * (n_a + n_b - odd) >= percent * (n_a + n_b + odd)


def _leftover_links(key, rows, how: NearDedup):
    """Links between members of different components of one centre's group (or two blocks of it).

    Two members differ in the shingles in which just one of them differs from the centre, so
    the shingles odd to the centre give their exact similarity. As many links are returned
    as join components, fewer than members.
    """
    *_, low, high = key
    rows = rows.sort_values("b").reset_index(drop=True)
    root, n = rows["root"].to_numpy(), rows["n_b"].to_numpy().astype(np.int64)
    sizes = rows["odd"].map(len).to_numpy()
    items, owner = np.concatenate(rows["odd"].to_list()), np.repeat(np.arange(len(rows)), sizes)
    codes, inverse, counts = np.unique(items, return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    often = counts[inverse] > 1
    owner, at = owner[often], column[inverse[often]]
    shared = np.zeros((len(rows), len(rows)), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for first in range(0, int((counts > 1).sum()), 4096):
        a, b = np.searchsorted(at, [first, first + 4096])
        block = np.zeros((len(rows), 4096), np.float32)
        block[owner[a:b], at[a:b] - first] = 1
        shared += block @ block.T
    odd = sizes[:, None] + sizes[None, :] - 2 * np.rint(shared).astype(np.int64)
    found = _similar(n[:, None], n[None, :], odd, how.percent) & (root[:, None] != root[None, :])
    block = rows["block"].to_numpy()
    if low != high:
        found &= block[:, None] != block[None, :]
    parent = {int(r): int(r) for r in root}

    def top(r):
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    ids, out = rows["b"].to_numpy(), []
    for i, j in zip(*np.nonzero(np.triu(found, 1))):
        x, y = top(int(root[i])), top(int(root[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((ids[i], ids[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def leftover_links(compared: DataFrame, roots: DataFrame, how: NearDedup) -> DataFrame:
    """Links that the star edges leave out, for groups whose members lie in several components."""
    placed = compared.join(roots, compared["b"] == roots["id"], "left").select(
        "a", "class_a.key_a", "b", "n_b", "odd", F.coalesce("root", "b").alias("root"))
    centre = ["a", "key_a"]
    groups = (
        placed.groupBy(*centre)
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
        .where("low < high")
        .select(*centre, F.ceil(F.col("members") / how.block).cast("int").alias("blocks"))
    )
    # Broadcast behind a count: in a shuffle all members of a large group would meet in one task.
    groups = stored(groups, "groups")
    groups = broadcast_if_bounded(groups, groups.count())
    rows = placed.join(groups, centre).withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(*centre, F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper"),
                       "block", "b", "n_b", "odd", "root")
    # Dealt by pair of blocks: by centre alone all pairs of a large group would meet in one task.
    pair = [*centre, "lower", "upper"]
    return rows.repartition(*pair).groupBy(*pair).applyInPandas(
        lambda key, part: _leftover_links(key, part, how), "a long, b long")


def near_duplicates(docs: DataFrame, how: NearDedup | None = None) -> DataFrame:
    """One row per document: n_shingles, component_id (smallest doc_id reachable), kept."""
    how = how or NearDedup()
    rows = docs.select("doc_id", "text")
    found = stored(in_arrow(
        rows, lambda batches: _signatures(batches, how),
        "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>"), "signatures")

    again = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                   .select("doc_id"), "again")
    again = broadcast_if_bounded(again, again.count())
    classes = stored(
        found.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*KEY)
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes")
    banded = classes.select(_class(), F.explode("bands").alias("bucket"))
    starts = (
        banded.groupBy("bucket").agg(F.min("cls").alias("centre"), F.max("cls").alias("most"))
        .where("centre < most").select("bucket", "centre")
    )
    pairs = stored(banded.join(starts, "bucket").where("cls > centre").select(
        F.col("centre").alias("class_a"), F.col("cls").alias("class_b")).distinct(), "pairs")
    wanted = stored(pairs.select(F.explode(F.array("class_a.id", "class_b.id")).alias("doc_id")).distinct(), "wanted")
    wanted = broadcast_if_bounded(wanted, wanted.count())
    sets = stored(class_sets(rows, classes, wanted, again, how), "sets")
    compared = stored(_compared(pairs, sets), "compared")
    near = _similar(F.col("n_a"), F.col("n_b"), F.size("odd"), how.percent)
    # An id whose rows belong to several classes links these.
    held = (found.where("n_shingles > 0").join(again, "doc_id", "left_semi").join(classes, list(KEY))
            .select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct())
    links = stored(compared.where(near).select("a", "b").unionByName(held).where("a <> b"), "links")
    more = stored(leftover_links(compared, stored(components(links), "roots"), how), "links")
    roots = stored(components(links.unionByName(more)), "roots")

    placed = classes.select(*KEY, F.col("id").alias("first")).join(roots, F.col("first") == F.col("id"), "left")
    placed = placed.select(*[F.col(k).alias(f"{k}_") for k in KEY], F.coalesce("root", "first").alias("found"))
    same = (F.col("key_a") == F.col("key_a_")) & (F.col("key_b") == F.col("key_b_")) & (
        F.col("n_shingles") == F.col("n_shingles_"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return (
        found.drop("bands").join(placed, same, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def representatives(docs: DataFrame, how: NearDedup | None = None) -> DataFrame:
    """One row of each group of near copies (smallest doc_id), with all columns of ``docs``.

    Rows that repeat a doc_id are one vertex; the first by text stays. Rows without id or
    without a word stay.
    """
    found = near_duplicates(docs, how)
    gone = stored(found.where("doc_id IS NOT NULL AND NOT kept").select("doc_id").distinct(), "gone")
    again = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                   .select("doc_id"), "again")
    kept = docs.join(broadcast_if_bounded(gone, gone.count()), "doc_id", "left_anti")
    once = broadcast_if_bounded(again, again.count())
    columns = ["text", *(c for c in docs.columns if c not in ("doc_id", "text"))]
    repeated = kept.join(once, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("_row"))
    return kept.join(once, "doc_id", "left_anti").select(*docs.columns).unionByName(
        repeated.select("doc_id", "_row.*").select(*docs.columns))
