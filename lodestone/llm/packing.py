"""Packing token sequences into windows by minimum bin slack.

A document is its token ids and an end id. Whole windows are cut from its start and fill
a sequence each; the rest is shorter than a window. The counts of the rests' lengths, at
most one number for each length, are all that the driver sees. For them a subset-sum
dynamic program over bits finds the lengths that fill a window closest to its capacity,
the longest waiting length always among them, and walks back to their counts. A filling is
used as often as its counts allow, so the plan stays as small as the table of lengths.

Rows then number their rest among those of equal length, in blocks, and look their place
up in the plan, which is broadcast: its size is bounded by the window. Null and empty
texts are the end id alone. Repeated rows are packed as rows of their own.
"""

import os
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import in_arrow, numbered, stored
from .words import LOWER, Remembered, Words, expand, slices, strings


@dataclass(frozen=True)
class Packing:
    vocabulary: str = "word_bpe_49k.json"
    window: int = 4096
    end_id: int = 2
    cached_words: int = 400_000


SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x0A]] = True
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KINDS[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = 2


@lru_cache(2)
def _tokenizer(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def _ids(how: Packing):
    tokenizer = _tokenizer(how.vocabulary)

    def compute(words):
        found = [code.ids for code in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return list(map(len, found)), list(chain.from_iterable(found)), 0

    return compute


class TokenIds:
    """Ids of texts, encoded by parts and remembered by part.

    The vocabulary drops white space, lowers the case and parts letters from signs, so the
    ids of a text are those of its parts in turn: between spaces, line ends, and where an
    ASCII letter meets an ASCII sign (but no apostrophe, which may begin a suffix). Texts
    next to one with the beginning of a special token are parted at spaces only.
    """

    def __init__(self, how: Packing):
        self.known = Remembered(_ids(how), how.cached_words)

    def encode(self, texts: pa.Array) -> list:
        words, known = Words(texts, parted_by=SPACES, fold=LOWER, kinds=KINDS), self.known
        if b"<|" in words.data.tobytes():
            words = Words(texts, parted_by=SPACES)
        rows = known.rows(words)
        ids = known.flat[expand(rows, known.first, known.n)]
        ends = np.concatenate([[0], np.cumsum(known.n[rows])])[words.first]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(batches, how: Packing):
    tokens = TokenIds(how)
    for batch in batches:
        for part in slices(batch):
            out = []
            coded = tokens.encode(strings(part.column("text")))
            for doc_id, ids in zip(strings(part.column("doc_id")).to_pylist(), coded):
                ids = np.append(ids, np.uint32(how.end_id)).astype("<u4")
                for start in range(0, len(ids), how.window):
                    piece = ids[start : start + how.window]
                    out.append((doc_id, start, len(piece), crc32(piece.tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.int64()) for x in zip(*out)], [x.split()[0] for x in PIECES.split(", ")])


def best_filling(counts: dict, capacity: int) -> dict:
    """Lengths and how many of each fill ``capacity`` closest, the longest one included.

    Bit s of a mask says that some multiset sums to s. Counts are split into powers of
    two, so an item is a shift of the mask; walking the masks back gives the counts.
    """
    longest = max(counts)
    room = capacity - longest
    masks, items = [1], []
    full = (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        if masks[-1] >> room & 1:
            break
        left = min(counts[length] - (length == longest), room // length)
        size = 1
        while left > 0:
            size = min(size, left)
            masks.append((masks[-1] | masks[-1] << size * length) & full)
            items.append((length, size))
            left -= size
            size *= 2
    total = masks[-1].bit_length() - 1
    used = {longest: 1}
    for before, (length, size) in zip(masks[-2::-1], reversed(items)):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + size
            total -= size * length
    return used


def plan_windows(counts: dict, capacity: int) -> list:
    """(length, low, high, a_window, sequence, offset) for ranges of rests of a length.

    Ranks low to high - 1 of that length go ``a_window`` to a sequence, from ``sequence``
    on, the first of them at ``offset``.
    """
    left = {n: c for n, c in counts.items() if c}
    done, rows, sequence = dict.fromkeys(left, 0), [], 0
    while left:
        used = best_filling(left, capacity)
        times = min(left[n] // k for n, k in used.items())
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            rows.append((n, done[n], done[n] + k * times, k, sequence, offset))
            done[n] += k * times
            left[n] -= k * times
            offset += n * k
            if not left[n]:
                del left[n]
        sequence += times
    return rows


def pack(docs: DataFrame, how: Packing | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    how = how or Packing()
    pieces = in_arrow(docs.select("doc_id", "text"), lambda batches: cut_pieces(batches, how), PIECES)
    pieces = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    whole = counts.pop(how.window, 0)
    plan = plan_windows(counts, how.window)
    sequences = max((r[4] + (r[2] - r[1]) // r[3] for r in plan), default=0)
    plan.append((how.window, 0, whole, 1, sequences, 0))
    plan = docs.sparkSession.createDataFrame(
        plan, "length long, low long, high long, a_window long, sequence long, base long")
    rest = max(counts.values(), default=0)
    ranked = numbered(pieces, ["length"], ["doc_id", "start"], many=max(rest, whole))
    nth = F.col("place") - F.col("low")
    return (
        ranked.join(F.broadcast(plan), "length")
        .where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                (F.col("sequence") + F.floor(nth / F.col("a_window"))).cast("long").alias("sequence_id"),
                (F.col("base") + nth % F.col("a_window") * F.col("length")).alias("offset"))
    )
