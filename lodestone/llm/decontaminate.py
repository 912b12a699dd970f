"""Benchmark decontamination by CGK embeddings, bit sampling and exact edit distances.

The CGK walk writes a string of words to a string of fixed length: at each step it copies
the word it stands at, and a random bit of step and word tells whether it moves on. Strings a
few edits apart have walks that meet again after each edit, so their embeddings agree in
many places, and edit distance becomes Hamming distance. Sampling a few places of the
embedding gives a bucket; repeated with other places and walks, near strings share a
bucket with the target recall (``walks`` times ``samples`` repetitions; tests measure it).

Windows of a text have the size of an item and stand where they can match at all: within
the allowed edits at least ``words - 2 - 3 * edits`` of an item's three-word runs survive
on neighbouring diagonals. This necessary condition drops no match. A window may begin before
its text or end behind it; places outside hold padding. Windows that share a
bucket with an item are verified by their exact word edit distance, over all starts and ends
nearby. Words are lower-case (ASCII) runs of letters and digits.

An item allows one edit in five words; items under eight words must stand exactly, and items
under three words are no evidence and match nothing. Items are broadcast in blocks of
``items_a_block``, so what is broadcast is bounded. Null and empty texts and items match nothing; repeated rows each get their rows.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from .tables import in_arrow, stored
from .words import LOWER, NOT_ALNUM, Words, gram_codes, mix, slices, strings


@dataclass(frozen=True)
class Decontamination:
    edits_in: int = 5
    exact_below: int = 8
    gram: int = 3
    walks: int = 8
    samples: int = 16
    places: int = 3
    fewer_places: tuple = (40, 150)
    items_a_block: int = 20_000
    seed: int = 3

    def edits(self, n: int) -> int:
        return 0 if n < self.exact_below else n // self.edits_in

    def places_of(self, n: int) -> int:
        """Places of an item of ``n`` words: one less from each length of ``fewer_places`` on.

        A long item's walks drift further apart with its edits, so fewer places agree at once.
        """
        return max(1, self.places - sum(n >= least for least in self.fewer_places))

    def least_grams(self, n: int) -> int:
        return max(1, n - self.gram + 1 - self.gram * self.edits(n))


PAD = np.uint64(0)


def cgk(symbols: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """Embeddings of rows of word hashes (zero past a row's end), ``steps`` long."""
    rows, at = np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
    padded = np.hstack([symbols, np.zeros((len(symbols), 1), np.uint64)])
    out = np.zeros((len(symbols), steps), np.uint64)
    for j in range(steps):
        word = padded[rows, at]
        out[:, j] = word
        moves = mix(word + np.uint64((walk * 100_003 + j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(63)
        at = np.minimum(at + moves.astype(np.int64), symbols.shape[1])
    return out


@lru_cache(4096)
def sampled_places(how: Decontamination, n: int) -> np.ndarray:
    """The places of the embedding that each repetition looks at, for rows of ``n`` words."""
    rng = np.random.default_rng([how.seed, n])
    few = min(how.places_of(n), 2 * n)
    drawn = rng.random((how.walks, how.samples, 2 * n)).argsort(axis=2)[:, :, :few]
    return np.concatenate([drawn, np.repeat(drawn[:, :, :1], how.places - few, axis=2)], axis=2)


def bucket_keys(symbols: np.ndarray, sizes: np.ndarray, how: Decontamination) -> np.ndarray:
    """One key per row and repetition; rows hold ``sizes`` words and zeros behind them."""
    found, which = np.unique(sizes, return_inverse=True)
    places = np.stack([sampled_places(how, n) for n in found.tolist()])[which]
    rows, keys = np.arange(len(symbols))[:, None, None], []
    for walk in range(how.walks):
        seen = cgk(symbols, walk, 2 * symbols.shape[1])[rows, places[:, walk]]
        code = np.arange(1, how.samples + 1, dtype=np.uint64) + np.uint64(walk * how.samples)
        for i in range(how.places):
            code = mix(code + seen[:, :, i])
        keys.append(code)
    return np.concatenate(keys, axis=1)


def best_match(item: np.ndarray, text: np.ndarray) -> tuple:
    """(distance, start) of the part of ``text`` nearest to ``item`` by word edits."""
    width = len(text) + 1
    cost, start = np.zeros(width, np.int64), np.arange(width)
    for i, word in enumerate(item):
        swap = cost[:-1] + (text != word)
        drop = cost[1:] + 1
        keep = np.where(swap <= drop, swap, drop)
        new = np.concatenate([[i + 1], keep])
        begun = np.concatenate([[0], np.where(swap <= drop, start[:-1], start[1:])])
        # Words put in: the least of new[j] + (k - j) over j <= k.
        level = new - np.arange(width)
        low = np.minimum.accumulate(level)
        first = np.maximum.accumulate(np.where(level == low, np.arange(width), 0))
        cost, start = low + np.arange(width), begun[first]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end])


class Items:
    """Benchmark items by word, with the places of their grams and their buckets."""

    def __init__(self, ids: list, texts: list, how: Decontamination):
        words = Words(pa.array(texts, pa.string()), NOT_ALNUM, LOWER)
        self.how, self.ids = how, ids
        self.words = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        codes, items, offsets = [], [], []
        for k, item in enumerate(self.words):
            if len(item) >= how.gram:
                found = gram_codes(item, how.gram)
                codes.append(found)
                items.append(np.full(len(found), k))
                offsets.append(np.arange(len(found)))
        self.empty = not codes
        if self.empty:
            return
        codes, self.items, self.offsets = map(np.concatenate, (codes, items, offsets))
        order = np.argsort(codes, kind="stable")
        self.items, self.offsets = self.items[order], self.offsets[order]
        self.codes, self.first, self.n = np.unique(codes[order], return_index=True, return_counts=True)
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[self.codes & np.uint64((1 << 20) - 1)] = True
        self.size = np.array([len(w) for w in self.words])
        self.edits = np.array([how.edits(n) for n in self.size])
        self.least = np.array([how.least_grams(n) for n in self.size])
        self.buckets = {}
        long = np.flatnonzero(self.size >= how.gram)
        for at in range(0, len(long), 1000):
            members = long[at : at + 1000]
            symbols = np.zeros((len(members), int(self.size[members].max())), np.uint64)
            for row, k in enumerate(members):
                symbols[row, : self.size[k]] = self.words[k]
            for k, keys in zip(members.tolist(), bucket_keys(symbols, self.size[members], how).tolist()):
                for key in keys:
                    self.buckets.setdefault((int(self.size[k]), key), set()).add(k)

    def hits(self, words: Words):
        """(text, item, diagonal) of every gram that a text and an item share."""
        grams = gram_codes(words.hash, self.how.gram)
        at = np.flatnonzero(self.bitmap[grams & np.uint64((1 << 20) - 1)])
        place = np.minimum(np.searchsorted(self.codes, grams[at]), len(self.codes) - 1)
        real = self.codes[place] == grams[at]
        at, place = at[real], place[real]
        text = np.searchsorted(words.first, at, "right") - 1
        inside = at + self.how.gram <= words.first[text + 1]
        at, place, text = at[inside], place[inside], text[inside]
        n = self.n[place]
        row = np.repeat(self.first[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(text, n), self.items[row], np.repeat(at, n) - self.offsets[row]

    def windows(self, words: Words):
        """(text, item, start) where enough shared grams lie on neighbouring diagonals."""
        text, item, diagonal = self.hits(words)
        order = np.lexsort((diagonal, item, text))
        text, item, diagonal = text[order], item[order], diagonal[order]
        # Diagonals differ by the edits between them, so a group is at most that wide.
        group = (text.astype(np.int64) * len(self.ids) + item)
        reach = np.int64(len(words) + 4 * int(self.size.max()) + 8)
        line = group * reach + diagonal + 2 * int(self.size.max())
        near = np.searchsorted(line, line + self.edits[item], "right") - np.searchsorted(line, line - self.edits[item])
        enough = near >= self.least[item]
        return text[enough], item[enough], diagonal[enough]

    def matches(self, words: Words):
        """{(text, item): (distance, start)} of all verified matches."""
        text, item, start = self.windows(words)
        found, hashes, done = {}, words.hash, {}
        spots = np.unique(np.stack([text, start, self.size[item]]), axis=1)
        pairs = set()
        for at in range(0, spots.shape[1], 4096):
            t, s, n = spots[:, at : at + 4096]
            offset = np.arange(int(n.max()))
            place = s[:, None] + offset
            live = (offset < n[:, None]) & (place >= words.first[t][:, None]) & (place < words.first[t + 1][:, None])
            symbols = np.where(live, hashes[np.clip(place, 0, len(hashes) - 1)], PAD)
            keys = bucket_keys(symbols, n, self.how)
            for t, s, n, row in zip(t.tolist(), s.tolist(), n.tolist(), keys.tolist()):
                for key in row:
                    pairs.update((t, k, s) for k in self.buckets.get((n, key), ()))
        for t, k, s in sorted(pairs):
            edits, n = int(self.edits[k]), int(self.size[k])
            if (t, k) in done and done[t, k] >= s:
                continue
            a = max(s - edits, int(words.first[t]))
            b = min(s + n + edits, int(words.first[t + 1]))
            # Each edit takes away one of the item's words at most.
            if np.isin(self.words[k], hashes[a:b]).sum() < n - edits:
                continue
            distance, at = best_match(self.words[k], hashes[a:b])
            if distance <= edits:
                if (t, k) not in found or distance < found[t, k][0]:
                    found[t, k] = (distance, a + at - int(words.first[t]))
                if distance == 0:
                    done[t, k] = s + n
        return found


SCHEMA = "doc_id long, item_id long, distance long, start long, item_words long"


def _searched(batches, ids, texts, how: Decontamination):
    items = Items(ids, texts, how)
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")), NOT_ALNUM, LOWER)
            if items.empty or len(words) < how.gram:
                continue
            docs = part.column("doc_id").to_pylist()
            out = [(docs[t], items.ids[k], d, s, int(items.size[k])) for (t, k), (d, s) in
                   sorted(items.matches(words).items())]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), pa.int64()) for x in zip(*out)], [x.split()[0] for x in SCHEMA.split(", ")])


def contaminated(docs: DataFrame, benchmark: DataFrame, how: Decontamination | None = None) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, distance, start, item_words."""
    how = how or Decontamination()
    context = docs.sparkSession.sparkContext
    items = stored(benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
                   .withColumn("block", F.monotonically_increasing_id()), "items")
    # Blocks are cut by rank of a unique number, so each has the stated size.
    cuts, total = [], items.count()
    if total > how.items_a_block:
        parts = -(-total // how.items_a_block)
        cuts = sorted(set(items.stat.approxQuantile("block", [i / parts for i in range(1, parts)], 0.0)))
    bounds = [None, *cuts, None]
    found = None
    for low, high in zip(bounds[:-1], bounds[1:]):
        some = items if low is None else items.where(F.col("block") > low)
        some = some if high is None else some.where(F.col("block") <= high)
        rows = sorted((r["item_id"] is None, r["item_id"] or 0, r["text"]) for r in some.collect())
        sent = context.broadcast(([None if none else i for none, i, _ in rows], [t for _, _, t in rows]))
        part = in_arrow(docs.select("doc_id", "text"), lambda b, sent=sent: _searched(b, *sent.value, how), SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, how: Decontamination | None = None) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns.

    Rows are told apart by id and text, so a null or repeated id costs no other row.
    """
    how = how or Decontamination()
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    named = rows.select(F.col("_row").alias("doc_id"), "text")
    bad = stored(contaminated(named, benchmark, how).select(F.col("doc_id").alias("_row")).distinct(), "bad")
    bad = broadcast_if_bounded(bad, bad.count())
    return rows.join(bad, "_row", "left_anti").select(*docs.columns)
