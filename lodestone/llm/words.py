"""Words of whole texts, found and hashed by vector operations on their UTF-8 bytes.

Used inside ``mapInArrow`` functions. A batch is cut into slices of a few MB and a
slice is hashed in blocks, so memory follows the longest single text, not the table.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
BLOCK_BYTES = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PRIME = np.uint64(0x100000001B3)
_PRIME_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))

# Bytes 0x20 and 0x09 to 0x0D part the words; every other byte belongs to one.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
# Only ASCII digits, ASCII letters and bytes of non-ASCII characters belong to words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
# Lower case for A to Z alone.
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _letters(fold: bytes) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    return codes[np.frombuffer(fold, np.uint8)]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int):
    """P^i and P^-i for i < n, modulo 2^64."""
    if len(_powers[0]) < n:
        n = max(n, BLOCK_BYTES + 4096)
        for k, base in enumerate((_PRIME, _PRIME_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def gram_codes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, by start; runs may cross texts."""
    count = max(0, len(hashes) - n + 1)
    code = np.zeros(count, np.uint64)
    for i in range(n):
        code += hashes[i : i + count] * (mix(np.array([i + 1], np.uint64) * _ODD)[0] | np.uint64(1))
    return mix(code)


class Words:
    """Words of an array of texts (null counts as empty), in order.

    ``start`` and ``end`` are byte positions in ``data``, ``first`` has for each text
    the index of its first word (one more entry than texts), ``hash`` 64 bits a word.
    With ``kinds``, words also end between bytes of the kinds 1 and 2.
    """

    def __init__(self, texts: pa.Array, parted_by=BLANKS, fold=AS_IS, kinds=None):
        texts = texts.fill_null("")
        wide = pa.types.is_large_string(texts.type)
        _, offsets, data = texts.buffers()
        self.n = len(texts)
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + self.n + 1]
        self.at = at.astype(np.int64) - int(at[0])
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[int(at[0]) : int(at[-1])]
        self.fold = fold
        inside = ~parted_by[self.data]
        cut = np.zeros(len(self.data) + 1, bool)
        cut[self.at] = True
        if kinds is not None and len(self.data):
            kind = kinds[self.data]
            cut[1:-1] |= kind[:-1] + kind[1:] == 3
        opens, closes = inside.copy(), inside
        if len(inside):
            opens[1:] &= ~inside[:-1] | cut[1:-1]
            closes = inside.copy()
            closes[:-1] &= ~inside[1:] | cut[1:-1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.at)
        self._hash = None

    def __len__(self):
        return len(self.start)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            out, letters = np.empty(len(self), np.uint64), _letters(self.fold.tobytes())
            i = 0
            while i < len(self):
                base = self.start[i]
                j = max(i + 1, int(np.searchsorted(self.end, base + BLOCK_BYTES, "right")))
                part = self.data[base : self.end[j - 1]]
                power, inverse = power_tables(len(part) + 1)
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(letters[part] * power[: len(part)], out=total[1:])
                a, b = self.start[i:j] - base, self.end[i:j] - base
                out[i:j] = (total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64) * _ODD
                i = j
            self._hash = mix(out)
        return self._hash

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.fold[self.data[self.start[i] : self.end[i]]].tobytes()

    def text(self, k: int) -> bytes:
        return self.data[self.at[k] : self.at[k + 1]].tobytes()

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each text."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]


def slices(batch: pa.RecordBatch, column="text", most=SLICE_BYTES):
    """Cut a batch into runs of rows with at most ``most`` bytes of text, or one row."""
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def strings(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def expand(rows: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions in a flat table of all items of the rows, in order."""
    n = n[rows]
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - first[rows], n)


class Remembered:
    """Integer lists of words, computed once for each distinct word (by its 64-bit hash).

    ``compute`` takes a list of words and returns their lists' lengths, all their items
    and one more number a word. With more than ``most`` words the table starts anew, so
    memory is bounded.
    """

    def __init__(self, compute, most: int = 1_000_000):
        self.compute, self.most = compute, most
        self._clear()

    def _clear(self):
        self.row, self.size = {}, 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.first, self.n, self.extra = (np.zeros(1 << 12, np.int64) for _ in range(3))

    @staticmethod
    def _grown(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, len(array)), array.dtype)])

    def rows(self, words: Words) -> np.ndarray:
        """The table's row for every word."""
        if len(self.row) > self.most:
            self._clear()
        codes, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        keys = codes.tolist()
        found = list(map(self.row.get, keys))
        new = [k for k, row in enumerate(found) if row is None]
        if new:
            raw, at = words.fold[words.data].tobytes(), at[new]
            spans = zip(words.start[at].tolist(), words.end[at].tolist())
            lengths, items, extra = self.compute([raw[a:b].decode("utf-8", "replace") for a, b in spans])
            start = len(self.row)
            self.row.update((keys[k], start + i) for i, k in enumerate(new))
            for i, k in enumerate(new):
                found[k] = start + i
            end, size = start + len(new), self.size + len(items)
            self.flat = self._grown(self.flat, size)
            self.first, self.n, self.extra = (self._grown(x, end) for x in (self.first, self.n, self.extra))
            self.flat[self.size : size] = items
            self.n[start:end], self.extra[start:end] = lengths, extra
            self.first[start:end] = self.size + np.cumsum(lengths) - lengths
            self.size = size
        return np.array(found, np.int64)[inverse]
