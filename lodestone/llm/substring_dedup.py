"""Removal of passages that occur earlier, located by Aho-Corasick automata.

A window is ``window`` consecutive words. Of its runs of ``anchor`` words, the one with the
smallest hash is its anchor; equal windows have equal anchors, and neighbouring windows
mostly share one, so a text has few. The work is in steps, all joined by Spark:

1. anchors of all texts are counted; those found twice or more recur;
2. the stretches of text around recurring anchors (segments, the windows of one anchor) are
   gathered by anchor, equal ones pre-aggregated;
3. an anchor's segments hold all occurrences of its windows. Windows that occur twice or more
   are confirmed; runs of them, the recurring passages, are compiled into automata, sharded by
   anchor and bounded in size, which run over the segments and locate every occurrence;
4. occurrences other than a phrase's first (smallest doc_id, then start) mark words to remove.

Anchors with more occurrences than ``hot`` are routed by single windows instead, so no
group of segments outgrows a task. Windows are judged on the input, not on what is left.

Null and empty texts have no words. Rows with an equal doc_id are one document: of windows at
the same start none is the earlier, so exact repeats of a row keep their words. Null ids come
after all others.
"""

import hashlib
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from .tables import in_arrow, stored
from .words import Words, expand, gram_codes, mix, power_tables, slices, strings


@dataclass(frozen=True)
class SubstringDedup:
    window: int = 20
    anchor: int = 8
    hot: int = 2_000
    shard_segments: int = 4_000
    slice_bytes: int = 1 << 20


LAST = (1 << 63) - 1


def keyed(docs: DataFrame) -> DataFrame:
    """(did, rid, text): a sortable id and a row's key."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"),
        F.xxhash64("doc_id", "text").alias("rid"), "text")


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest value in each run of ``width``."""
    at, covered = np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        if len(at) <= step:
            return at[:0]
        a, b = at[:-step], at[step:]
        at = np.where(values[a] <= values[b], a, b)
        covered += step
    return at


def anchor_groups(words: Words, how: SubstringDedup):
    """(text, first window in the text, windows, code) of every anchor of every text."""
    codes = gram_codes(words.hash, how.anchor)
    places = sliding_argmin(codes, how.window - how.anchor + 1)
    counts = words.counts()
    fits = np.flatnonzero(counts >= how.window)
    n = counts[fits] - how.window + 1
    owner = np.repeat(fits, n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = places[words.first[owner] + start]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(place)))
    return owner[heads], start[heads], size, codes[place[heads]]


def _anchors(batches, how: SubstringDedup, counted: bool):
    for batch in batches:
        for part in slices(batch):
            owner, start, size, code = anchor_groups(Words(strings(part.column("text"))), how)
            code = pa.array(code.view(np.int64))
            if counted:
                yield pa.RecordBatch.from_arrays([code], ["code"])
            else:
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [strings(part.column("did")).take(take), strings(part.column("rid")).take(take),
                     pa.array(start.astype(np.int32)), pa.array(size.astype(np.int8)), code],
                    ["did", "rid", "start", "windows", "code"])


def run_codes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the words first to last - 1 of each run."""
    power, inverse = power_tables(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=total[1:])
    return mix((total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64))


def found_segments(part: pa.RecordBatch, words: Words, how: SubstringDedup):
    """(text, start, windows, code, hot) of the flagged anchors of each text, hot ones by window."""
    found = part.column("found")
    owner = np.repeat(np.arange(len(found)), pa.compute.list_value_length(found).to_numpy(zero_copy_only=False))
    values = found.flatten()
    start, windows, code, hot = (
        values.field(k).to_numpy(zero_copy_only=False) for k in ("start", "windows", "code", "hot"))
    times = np.where(hot, windows, 1).astype(np.int64)
    row = np.repeat(np.arange(len(start)), times)
    step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    start = start[row].astype(np.int64) + step
    windows = np.where(hot, 1, windows)[row].astype(np.int64)
    first = words.first[owner[row]] + start
    last = first + windows - 1 + how.window
    key_a = run_codes(words.hash, first, last)
    key_b = run_codes(mix(words.hash + np.uint64(0x5851F42D4C957F2D)), first, last)
    code = np.where(hot[row], key_a.view(np.int64), code[row])
    return owner[row], start, first, last, key_a.view(np.int64), key_b.view(np.int64), code


SEGMENT = "key_a long, key_b long, code long, segment string, did long, start int, n long"
PLACE = "key_a long, key_b long, did long, rid long, start int"


def _segments(batches, how: SubstringDedup):
    """Distinct segments of candidate rows, with their count and first place in the slice."""
    for batch in batches:
        for part in slices(batch, most=how.slice_bytes):
            words = Words(strings(part.column("text")))
            owner, start, first, last, key_a, key_b, code = found_segments(part, words, how)
            if not len(owner):
                continue
            did = part.column("did").to_numpy()[owner]
            order = np.lexsort((start, did, key_b, key_a))
            a, b = key_a[order], key_b[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            head, n = order[new], np.diff(np.append(new, len(order)))
            # All words parted by one space: a segment is then one stretch of bytes.
            width = words.end - words.start + 1
            at = np.concatenate([[0], np.cumsum(width)])
            line = np.full(int(at[-1]), 0x20, np.uint8)
            take = np.repeat(words.start - at[:-1], width - 1) + expand(np.arange(len(width)), at[:-1], width - 1)
            line[expand(np.arange(len(width)), at[:-1], width - 1)] = words.data[take]
            line = line.tobytes()
            texts = [line[i:j] for i, j in zip(at[first[head]].tolist(), (at[last[head]] - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key_a[head]), pa.array(key_b[head]), pa.array(code[head]),
                 pa.array(texts, pa.binary()).cast(pa.string()), pa.array(did[head]),
                 pa.array(start[head].astype(np.int32)), pa.array(n)],
                [x.split()[0] for x in SEGMENT.split(", ")])


def _places(batches, how: SubstringDedup):
    """Where the segments of candidate rows stand."""
    for batch in batches:
        for part in slices(batch):
            owner, start, _, _, key_a, key_b, _ = found_segments(part, Words(strings(part.column("text"))), how)
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key_a), pa.array(key_b), part.column("did").take(take), part.column("rid").take(take),
                 pa.array(start.astype(np.int32))], [x.split()[0] for x in PLACE.split(", ")])


def _located(rows: list, how: SubstringDedup):
    """One automaton: confirm the phrases of some anchors' segments and locate all occurrences."""
    letters, coded = {}, []
    for row in rows:
        coded.append("".join(
            [letters.setdefault(word, chr(0x10000 + len(letters))) for word in row["segment"].split(" ")]))
    count, first = {}, {}
    for row, text in zip(rows, coded):
        did, start, n = row["did"], row["start"], row["n"]
        for i in range(len(text) - how.window + 1):
            phrase, place = text[i : i + how.window], (did, start + i)
            if phrase in count:
                count[phrase] += n
                if place < first[phrase]:
                    first[phrase] = place
            else:
                count[phrase], first[phrase] = n, place
    # A passage is a longest run of confirmed phrases; it carries the first place of each.
    automaton = ahocorasick.Automaton()
    for text in coded:
        places, begin = [], 0
        for i in range(len(text) - how.window + 2):
            phrase = text[i : i + how.window]
            if count.get(phrase, 0) > 1:
                places.append(first[phrase])
            else:
                if places:
                    automaton.add_word(text[begin : i - 1 + how.window], places)
                places, begin = [], i + 1
    if not len(automaton):
        return
    automaton.make_automaton()
    for row, text in zip(rows, coded):
        found = own = 0
        for end, places in automaton.iter(text):
            at = end + 2 - how.window - len(places)
            for i, place in enumerate(places, at):
                found |= 1 << i
                if place == (row["did"], row["start"] + i):
                    own |= 1 << i
        if found:
            yield row["key_a"], row["key_b"], found, own, row["did"], row["start"]


LOCATED = "key_a long, key_b long, found int, own int, first_did long, first_start int"


def _shards(batches, how: SubstringDedup):
    """Segments sorted by anchor, cut between anchors into automata of bounded size."""
    def flush(rows):
        out = list(_located(rows, how))
        if out:
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            names = [x.split()[0] for x in LOCATED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), types)], names)

    rows = []
    for batch in batches:
        for row in batch.to_pylist():
            if len(rows) >= how.shard_segments and rows[-1]["code"] != row["code"]:
                yield from flush(rows)
                rows = []
            rows.append(row)
    if rows:
        yield from flush(rows)


def repeated_marks(docs: DataFrame, how: SubstringDedup | None = None):
    """(candidates, marks): rows (did, rid, text) that may repeat something, and for each such
    row the windows to remove as (start, mask): bit i stands for the window at start + i."""
    how = how or SubstringDedup()
    rows = keyed(docs)
    codes = in_arrow(rows.select("text"), lambda b: _anchors(b, how, True), "code long")
    recurring = stored(codes.groupBy("code").agg(F.count("*").alias("n")).where("n > 1")
                       .select("code", (F.col("n") > how.hot).alias("hot")), "recurring")
    anchors = in_arrow(rows, lambda b: _anchors(b, how, False),
                       "did long, rid long, start int, windows byte, code long")
    flagged = stored(
        anchors.join(recurring, "code").groupBy("did", "rid")
        .agg(F.collect_set(F.struct("start", "windows", "code", "hot")).alias("found")), "flagged")
    ids = flagged.select("did", "rid")
    few = broadcast_if_bounded(ids, flagged.count())
    candidates = stored(rows.join(few, ["did", "rid"], "left_semi").join(flagged, ["did", "rid"]), "candidates")

    distinct = in_arrow(candidates, lambda b: _segments(b, how), SEGMENT)
    distinct = distinct.groupBy("code", "key_a", "key_b", "segment").agg(
        F.min(F.struct("did", "start")).alias("first"), F.sum("n").alias("n"))
    distinct = distinct.select("code", "key_a", "key_b", "segment", "first.did", "first.start", "n")
    located = stored(in_arrow(
        distinct.repartition("code").sortWithinPartitions("code"), lambda b: _shards(b, how), LOCATED), "located")
    places = in_arrow(candidates, lambda b: _places(b, how), PLACE)
    first = (F.col("did") == F.col("first_did")) & (F.col("start") == F.col("first_start"))
    later = F.when(first, F.col("found").bitwiseAND(F.bitwise_not("own"))).otherwise(F.col("found"))
    marks = (
        places.join(located, ["key_a", "key_b"]).withColumn("mask", later).where("mask <> 0")
        .groupBy("did", "rid").agg(F.collect_set(F.struct("start", "mask")).alias("marks"))
    )
    return candidates.drop("found"), stored(marks, "marks")


def removed_words(n: int, marks: list, window: int) -> np.ndarray:
    """Which of a text's n words its marked windows cover."""
    edges = np.zeros(n + 1, np.int64)
    for mark in marks or ():
        mask, start = mark["mask"], mark["start"]
        while mask:
            low = mask & -mask
            at = start + low.bit_length() - 1
            edges[at] += 1
            edges[at + window] -= 1
            mask ^= low
    return np.cumsum(edges)[:n] > 0


def _digests(batches, how: SubstringDedup):
    for batch in batches:
        for part in slices(batch):
            texts = strings(part.column("text")).fill_null("").to_pylist()
            marks = part.column("marks").to_pylist() if "marks" in part.schema.names else [None] * len(texts)
            out = []
            for text, some in zip(texts, marks):
                words = text.encode("utf-8", "surrogatepass").split()
                n, gone = len(words), 0
                if some:
                    drop = removed_words(n, some, how.window)
                    gone = int(drop.sum())
                    words = [w for w, d in zip(words, drop.tolist()) if not d]
                out.append((n, gone, hashlib.sha256(b" ".join(words)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [part.column("did"), part.column("rid"), *[pa.array(list(x)) for x in zip(*out)]],
                ["did", "rid", "n_words", "n_removed", "kept_sha256"])


DIGEST = "did long, rid long, n_words long, n_removed long, kept_sha256 string"


def repeated_digests(docs: DataFrame, how: SubstringDedup | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    how = how or SubstringDedup()
    candidates, marks = repeated_marks(docs, how)
    cut = in_arrow(candidates.join(marks, ["did", "rid"]), lambda b: _digests(b, how), DIGEST)
    cut = cut.groupBy("did", "rid").agg(
        F.first("n_removed").alias("gone"), F.first("kept_sha256").alias("cut_sha256"))
    whole = in_arrow(keyed(docs), lambda b: _digests(b, how), DIGEST)
    return whole.join(cut, ["did", "rid"], "left").select(
        F.when(F.col("did") != LAST, F.col("did")).alias("doc_id"), "n_words",
        F.coalesce("gone", "n_removed").alias("n_removed"),
        F.coalesce("cut_sha256", "kept_sha256").alias("kept_sha256"))


def _rewritten(batches, how: SubstringDedup):
    """Texts without the bytes of their removed words and of the blanks behind them."""
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")))
            texts, left = [], []
            for k, some in enumerate(part.column("marks").to_pylist()):
                a, b = int(words.first[k]), int(words.first[k + 1])
                drop = removed_words(b - a, some, how.window)
                text, base, out, at = words.text(k), int(words.at[k]), [], 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], drop.astype(np.int8), [0]])))
                for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    out.append(text[at : int(words.start[a + i]) - base])
                    at = int(words.start[a + j]) - base if a + j < b else len(text)
                out.append(text[at:])
                texts.append(b"".join(out).decode("utf-8", "replace"))
                left.append(int((~drop).sum()))
            yield pa.RecordBatch.from_arrays(
                [part.column("did"), part.column("rid"), pa.array(texts), pa.array(left, pa.int64())],
                ["did", "rid", "new_text", "left"])


def without_repeats(docs: DataFrame, how: SubstringDedup | None = None) -> DataFrame:
    """The documents with repeated passages cut out; those left without a word are dropped."""
    how = how or SubstringDedup()
    candidates, marks = repeated_marks(docs, how)
    cut = in_arrow(candidates.join(marks, ["did", "rid"]), lambda b: _rewritten(b, how),
                   "did long, rid long, new_text string, left long")
    cut = stored(cut.dropDuplicates(["did", "rid"]), "rewritten")
    rows = docs.withColumns({"_did": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)),
                             "_rid": F.xxhash64("doc_id", "text")})
    cut = cut.select(F.col("did").alias("_did"), F.col("rid").alias("_rid"), F.col("new_text").alias("_new"),
                     F.col("left").alias("_left"))
    key = ["_did", "_rid"]
    few = broadcast_if_bounded(cut.select(*key), cut.count())
    changed = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_new").cast(docs.schema["n_chars"].dataType)
    rewritten = rows.drop("text").join(few, key, "left_semi").join(cut.where("_left > 0"), key).withColumns(changed)
    return rows.join(few, key, "left_anti").select(*docs.columns).unionByName(rewritten.select(*docs.columns))
