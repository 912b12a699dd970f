"""Quality rules: how well public vocabularies fit a text.

A text made of words that a tokeniser knows takes few tokens. Every distinct word of a
slice is encoded once: by a multilingual byte-level BPE for characters per token, and by
a BPE with byte fallback for the share of fallback bytes and the entropy of the tokens.
A text outside the bands of its main script is rejected, as is one that fails the base
rules on length and repetition.

Null and empty texts have no words, so the base rules reject them. Rows are judged one
by one; repeated rows get equal verdicts.
"""

import base64
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import in_arrow
from .words import BLANKS, Remembered, Words, expand, gram_codes, slices, strings


@dataclass(frozen=True)
class Band:
    """Accepted values of one script; texts with fewer tokens than ``least_tokens`` pass."""

    chars_per_token: tuple = (1.2, 8.0)
    byte_share: float = 0.10
    entropy: float = 0.45
    top_share: float = 0.15
    least_tokens: int = 40


@dataclass(frozen=True)
class QualityRules:
    """Parameters: vocabulary files, base rules and the bands per script.

    ``entropy`` is that of the token distribution in runs of ``run`` tokens, over the largest
    possible in a run, so a text's length doesn't move the bar; ``top_share`` is the share of
    the most frequent token. A run is as long as the shortest text that the bands judge.
    """

    pieces: str = "piece_bpe_32k.model"
    units: str = "byte_bpe_multi_50k.tiktoken"
    least_words: int = 20
    most_repeated: int = 30
    window: int = 8
    run: int = 40
    bands: dict = field(default_factory=lambda: {
        "latin": Band(),
        "cyrillic": Band(chars_per_token=(0.9, 8.0)),
        "cjk": Band(chars_per_token=(0.3, 4.0), byte_share=0.6, top_share=0.35),
        "other": Band(chars_per_token=(0.25, 8.0), byte_share=0.95, top_share=0.35),
    })
    cached_words: int = 250_000


SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, script string, n_tokens long, "
          "chars_per_token double, byte_share double, token_entropy double, top_share double")

OUT = pa.schema([(name, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}.get(kind, pa.string()))
                 for name, kind in (column.split() for column in SCHEMA.split(", "))])


@lru_cache(2)
def _load(pieces: str, units: str):
    import public_tokenizers
    import sentencepiece
    import tiktoken

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
    is_byte = np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
    with open(public_tokenizers.path(units), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return sp, is_byte, bpe


def _pieces(rules: QualityRules):
    """Ids by the vocabulary with byte fallback, and the count of tokens by the other."""
    sp, _, bpe = _load(rules.pieces, rules.units)

    def compute(words):
        found = sp.encode(words, num_threads=1)
        units = [len(bpe.encode_ordinary(word)) for word in words]
        return list(map(len, found)), list(chain.from_iterable(found)), units

    return compute


# First code points (inclusive ranges) of scripts that are told apart.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "cyrillic": [(0x370, 0x52F)],
    "cjk": [(0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7AF), (0x20000, 0x2FA1F)],
}


def main_script(text: str) -> str:
    """The script of most characters from U+0041 on that aren't ASCII signs."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    found = {name: sum(int(((codes >= a) & (codes <= b)).sum()) for a, b in ranges) for name, ranges in SCRIPTS.items()}
    found["other"] = int((codes >= 0x80).sum()) - sum(
        int(((codes >= max(a, 0x80)) & (codes <= b)).sum()) for ranges in SCRIPTS.values() for a, b in ranges)
    return max(found, key=lambda name: (found[name], name))


def repeated_words(grams: np.ndarray, n: int) -> int:
    """Words covered by windows whose code occurs twice or more."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(grams) + n, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    return int((np.cumsum(edges) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def run_entropy(ids: np.ndarray, run: int) -> float:
    """Mean entropy (bits) of the runs of ``run`` tokens that cover a text; a shorter text is one run.

    The last run ends with the text, so it may share tokens with the one before.
    """
    run = min(run, len(ids))
    starts = np.arange(-(-len(ids) // run)) * run
    starts[-1] = len(ids) - run
    tokens = ids[starts[:, None] + np.arange(run)].astype(np.int64)
    counts = np.unique(tokens + (np.arange(len(starts))[:, None] << 32), return_counts=True)[1]
    return log2(run) - float((counts * np.log2(counts)).sum()) / tokens.size


def judge(batches, rules: QualityRules, known: Remembered | None = None):
    known = known or Remembered(_pieces(rules), rules.cached_words)
    sp, is_byte, _ = _load(rules.pieces, rules.units)
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")))
            first, counts = words.first, words.counts()
            chars = words.per_text(((words.data & 0xC0) != 0x80) & ~BLANKS[words.data])
            symbols = words.per_text(SYMBOLS[words.data])
            grams = gram_codes(words.hash, rules.window)
            rows = known.rows(words)
            all_ids, units = known.flat[expand(rows, known.first, known.n)], known.extra[rows]
            ends = np.concatenate([[0], np.cumsum(known.n[rows])])[first]
            out = []
            for k in range(words.n):
                a, b, n = first[k], first[k + 1], int(counts[k])
                text = words.text(k)
                repeated = repeated_words(grams[a : b - rules.window + 1], rules.window) if n > rules.window else 0
                failed = n < rules.least_words or 100 * repeated > rules.most_repeated * n
                ids = all_ids[ends[k] : ends[k + 1]]
                script = main_script(text.decode("utf-8", "replace"))
                n_units, total = int(units[a:b].sum()), len(ids)
                fit = n_bytes = entropy = top = 0.0
                if total:
                    seen = np.unique(ids, return_counts=True)[1] / total
                    fit = float(chars[k]) / n_units
                    n_bytes = float(is_byte[ids].mean())
                    entropy = run_entropy(ids, rules.run) / max(1.0, log2(min(total, rules.run, sp.vocab_size())))
                    top = float(seen.max())
                band = rules.bands[script]
                good = total < band.least_tokens or (
                    band.chars_per_token[0] <= fit <= band.chars_per_token[1]
                    and n_bytes <= band.byte_share and entropy >= band.entropy and top <= band.top_share)
                out.append((n, int(chars[k]), int(symbols[k]), duplicate_lines(text), repeated, bool(failed),
                            bool(not failed and good), script, total, fit, n_bytes, entropy, top))
            columns = [strings(part.column("doc_id")).cast(pa.int64())]
            columns += [pa.array(list(x), t) for x, t in zip(zip(*out), OUT.types[1:])]
            yield pa.RecordBatch.from_arrays(columns, schema=OUT)


def quality_rules(docs: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """One row per document: counts, token measures, ``base_failed`` and ``kept``."""
    rules = rules or QualityRules()
    return in_arrow(docs.select("doc_id", "text"), lambda batches: judge(batches, rules), SCHEMA)


def _passing(batches, rules: QualityRules):
    known = Remembered(_pieces(rules), rules.cached_words)
    for batch in batches:
        for part in slices(batch):
            verdicts = pa.Table.from_batches(list(judge([part], rules, known)), OUT).column("kept")
            yield part.filter(strings(verdicts))


def passing(docs: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rules = rules or QualityRules()
    return in_arrow(docs, lambda batches: _passing(batches, rules), docs.schema)
