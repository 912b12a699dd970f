"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

Each word enters by two inputs: an embedding of the word and the scaled sum of embeddings of its
character runs (both hashed to tables of fixed size). A third number tells how much more often
the word, or one of its beginnings, stands in toxic texts of the sample than in clean ones; in
training it is taken from texts of other parts of the sample, so that the network learns how far
such odds hold for texts that they were not counted on. Two gated recurrent layers read a
window of words in both directions, attention weighs their states, and a logistic output
scores the window. Every text is cut into overlapping windows that cover it whole. Its score
is a logistic function of its highest window and of the mean of all its windows' scores,
fitted on held-back training texts.

Labels tell of texts, not of windows, so training asks for one toxic window in a toxic text:
first the window with the word of the highest odds, later the one that the network itself
scores highest; of clean texts a random and the highest window
count. The network is fitted in one task on a bounded sample of labelled rows
(``most_toxic`` and ``most_clean`` texts, those with the smallest hash of their id).

Null texts and texts without a word score 0. Without labels of both kinds all scores are 0.
Rows are scored one by one; repeated rows get equal scores.
"""

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import in_arrow
from .words import LOWER, NOT_ALNUM, Words, mix, slices, strings


@dataclass(frozen=True)
class ToxicityModel:
    window: int = 32
    stride: int = 24
    hidden: int = 8
    size: int = 16
    attention: int = 12
    words: int = 8192
    grams: int = 65536
    gram_bytes: tuple = (3, 6)
    beginnings: tuple = (3, 8)
    odds: int = 1 << 18
    least_texts: int = 3
    parts: int = 5
    most_toxic: int = 1500
    most_clean: int = 3000
    rounds: tuple = (2, 2)
    batch: int = 256
    rate: float = 0.01
    spread: float = 0.03
    held_back: float = 0.2
    folds: int = 3
    held_out_fold: int = 1
    threshold: float = 0.7
    seed: int = 7


def vocabulary(words: Words, model: ToxicityModel):
    """Distinct words of a slice: (row of each word, word bucket, gram buckets, first gram)."""
    _, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[at], words.end[at]
    n = end - start + 2
    first = np.cumsum(n) - n
    data = np.zeros(int(n.sum()), np.uint8)
    inner = np.ones(len(data), bool)
    inner[first] = inner[first + n - 1] = False
    take = np.arange(int((n - 2).sum())) + np.repeat(start - (np.cumsum(n - 2) - (n - 2)), n - 2)
    data[inner] = words.fold[words.data[take]]
    owner = np.repeat(np.arange(len(n)), n)
    grams, owners = [], []
    letters = mix(data.astype(np.uint64) + np.uint64(1))
    for k in model.gram_bytes:
        if len(data) < k:
            continue
        fits = owner[k - 1 :] == owner[: len(owner) - k + 1]
        code = np.zeros(len(data) - k + 1, np.uint64)
        for i in range(k):
            code = code * np.uint64(0x100000001B3) + letters[i : i + len(code)]
        grams.append((mix(code + np.uint64(k)) % np.uint64(model.grams))[fits].astype(np.int32))
        owners.append(owner[: len(fits)][fits])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(n))
    bucket = (words.hash[at] % np.uint64(model.words)).astype(np.int32)
    return inverse, bucket, grams[order], np.cumsum(counts) - counts, counts


def word_beginnings(words: Words, model: ToxicityModel):
    """(bucket, row) of every beginning of the distinct words, and of the words themselves."""
    _, at = np.unique(words.hash, return_index=True)
    start, size = words.start[at], words.end[at] - words.start[at]
    buckets = [mix(words.hash[at] + np.uint64(1))]
    rows, code = [np.arange(len(at))], np.zeros(len(at), np.uint64)
    low, high = model.beginnings
    for k in range(1, high + 1):
        long = np.flatnonzero(size >= k)
        letters = words.fold[words.data[start[long] + k - 1]].astype(np.uint64)
        code[long] = mix(code[long] * np.uint64(0x100000001B3) + letters + np.uint64(1))
        if k >= low:
            buckets.append(code[long])
            rows.append(long)
    return (np.concatenate(buckets) % np.uint64(model.odds)).astype(np.int64), np.concatenate(rows)


def word_odds(words: Words, rows, toxic: np.ndarray, part: np.ndarray, use: np.ndarray, model: ToxicityModel):
    """Log odds of buckets to be in a toxic text: by all texts in ``use``, and without each part of them.

    Odds below even, and of buckets in fewer than ``least_texts`` toxic texts, are 0.
    """
    bucket, row = word_beginnings(words, model)
    order = np.argsort(row, kind="stable")
    bucket, many = bucket[order], np.bincount(row, minlength=int(rows.max(initial=-1)) + 1)
    begin = np.cumsum(many) - many
    counts = np.zeros((model.parts, 2, model.odds), np.float32)
    texts = np.zeros((model.parts, 2))
    for t in np.flatnonzero(use):
        own = np.unique(rows[words.first[t] : words.first[t + 1]])
        take = np.arange(many[own].sum()) + np.repeat(begin[own] - np.cumsum(many[own]) + many[own], many[own])
        counts[part[t], toxic[t], np.unique(bucket[take])] += 1
        texts[part[t], toxic[t]] += 1
    whole, tables = counts.sum(0), []
    for k in range(-1, model.parts):
        good, bad = whole if k < 0 else whole - counts[k]
        n_good, n_bad = texts.sum(0) if k < 0 else texts.sum(0) - texts[k]
        odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))
        tables.append(np.where(bad >= model.least_texts, np.maximum(odds, 0), 0).astype(np.float32))
    return tables[0], tables[1:]


def odds_of(words: Words, table: np.ndarray, model: ToxicityModel) -> np.ndarray:
    """Each distinct word's highest odds."""
    bucket, row = word_beginnings(words, model)
    found = np.zeros(int(row.max(initial=-1)) + 1, np.float32)
    np.maximum.at(found, row, table[bucket])
    return found


def window_starts(n: int, model: ToxicityModel) -> np.ndarray:
    """Overlapping windows over n words; the last one ends with the text."""
    if n <= model.window:
        return np.zeros(min(n, 1), np.int64)
    starts = np.arange(0, n - model.window + 1, model.stride)
    return starts if starts[-1] == n - model.window else np.append(starts, n - model.window)


def windows_of(words: Words, model: ToxicityModel):
    """(text, first word, words) of all windows of a slice."""
    counts = words.counts()
    starts = [window_starts(int(n), model) for n in counts]
    owner = np.repeat(np.arange(words.n), [len(s) for s in starts])
    first = np.concatenate([np.zeros(0, np.int64), *starts]) + words.first[owner]
    return owner, first, np.minimum(counts[owner], model.window)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Weights, the forward pass and its gradients."""

    def __init__(self, model: ToxicityModel, weights: dict | None = None):
        self.model = model
        if weights is None:
            rng, h, d = np.random.default_rng(model.seed), model.hidden, 2 * model.size
            def drawn(*shape, by=None):
                return (rng.standard_normal(shape) * (by or shape[0] ** -0.5)).astype(np.float32)
            weights = {"word": drawn(model.words, model.size, by=model.spread), "gram": drawn(model.grams, model.size, by=model.spread),
                       "att": drawn(2 * h, model.attention), "att_b": np.zeros(model.attention, np.float32),
                       "att_v": drawn(model.attention), "out": drawn(2 * h), "out_b": np.zeros(1, np.float32)}
            for way in "fb":
                weights |= {f"in_{way}": drawn(d, 3 * h), f"rec_{way}": drawn(h, 3 * h), f"odds_{way}": drawn(3 * h, by=0.1),
                            f"bias_{way}": np.zeros(3 * h, np.float32)}
        self.w = weights

    def inputs(self, vocab):
        """One row per distinct word: its embedding and the scaled sum of its runs' embeddings."""
        _, bucket, grams, first, counts = vocab
        total = np.zeros((len(bucket), self.model.size), np.float32)
        some = counts > 0
        if some.any():
            total[some] = np.add.reduceat(self.w["gram"][grams], first[some], axis=0)
        return np.hstack([self.w["word"][bucket], total * self._share(counts)])

    @staticmethod
    def _share(counts):
        return (np.maximum(counts, 1) ** -0.5)[:, None].astype(np.float32)

    def _read(self, fed, live, way, keep):
        """States of one direction, time first; ``fed`` holds the projected inputs."""
        steps, n, _ = fed.shape
        h, rec = self.model.hidden, self.w[f"rec_{way}"]
        state = np.zeros((n, h), np.float32)
        states, kept = np.zeros((steps, n, h), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            inner = state @ rec
            gates = _sigmoid(fed[t, :, : 2 * h] + inner[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(fed[t, :, 2 * h :] + reset * inner[:, 2 * h :])
            before, on = state, live[t][:, None]
            state = np.where(on, new + update * (before - new), before)
            states[t] = state
            if keep:
                kept.append((t, before, update, reset, new, inner[:, 2 * h :], on))
        return states, kept

    def forward(self, x, places, live, odds=None, keep=False):
        """Logits of windows; ``places`` are rows of ``x`` by time and window, ``odds`` those of their words."""
        both, steps = [], []
        for way in "fb":
            projected = x @ self.w[f"in_{way}"] + self.w[f"bias_{way}"]
            fed = projected[places]
            if odds is not None:
                fed = fed + odds[:, :, None] * self.w[f"odds_{way}"]
            states, kept = self._read(fed, live, way, keep)
            both.append(states)
            steps.append(kept)
        states = np.concatenate(both, axis=2)
        hidden = np.tanh(states @ self.w["att"] + self.w["att_b"])
        weight = np.where(live, hidden @ self.w["att_v"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.w["out"] + self.w["out_b"][0]
        return (logits, (states, hidden, weight, pooled, steps)) if keep else logits

    def gradients(self, vocab, places, live, target, importance, odds=None):
        """Gradients of the weighted logistic loss of some windows."""
        h, g, w = self.model.hidden, {}, self.w
        x = self.inputs(vocab)
        logits, (states, hidden, weight, pooled, steps) = self.forward(x, places, live, odds, keep=True)
        d_logit = ((_sigmoid(logits) - target) * importance / len(target)).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att_v"] = np.einsum("tn,tnk->k", d_score, hidden)
        d_hidden = d_score[:, :, None] * w["att_v"] * (1 - hidden ** 2)
        flat = d_hidden.reshape(-1, d_hidden.shape[2])
        g["att"], g["att_b"] = states.reshape(-1, 2 * h).T @ flat, flat.sum(axis=0)
        d_states = d_states + d_hidden @ w["att"].T
        d_x = np.zeros_like(x)
        for k, way in enumerate("fb"):
            rec = w[f"rec_{way}"]
            d_rec, d_fed = np.zeros_like(rec), np.zeros((*places.shape, 3 * h), np.float32)
            carried = np.zeros((places.shape[1], h), np.float32)
            for t, before, update, reset, new, inner, on in reversed(steps[k]):
                d = d_states[t, :, k * h : (k + 1) * h] + carried
                d_on = np.where(on, d, 0)
                d_new = d_on * (1 - update) * (1 - new ** 2)
                d_update = d_on * (before - new) * update * (1 - update)
                d_reset = d_new * inner * reset * (1 - reset)
                d_inner = np.hstack([d_update, d_reset, d_new * reset])
                d_fed[t] = np.hstack([d_update, d_reset, d_new])
                d_rec += before.T @ d_inner
                carried = np.where(on, d_on * update, d) + d_inner @ rec.T
            flat, rows = d_fed.reshape(-1, 3 * h), places.reshape(-1)
            g[f"odds_{way}"] = np.zeros(3 * h) if odds is None else odds.reshape(-1) @ flat
            projected = np.zeros((len(x), 3 * h), np.float32)
            np.add.at(projected, rows, flat)
            g[f"rec_{way}"], g[f"in_{way}"], g[f"bias_{way}"] = d_rec, x.T @ projected, flat.sum(axis=0)
            d_x += projected @ w[f"in_{way}"].T
        _, bucket, grams, _, counts = vocab
        g["word"], g["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        size = self.model.size
        np.add.at(g["word"], bucket, d_x[:, :size])
        share = d_x[:, size:] * self._share(counts)
        np.add.at(g["gram"], grams, np.repeat(share, counts, axis=0))
        return g


def laid_out(rows, first, n, window: int):
    """(places, live) by time and window; places past a window's end repeat its last word."""
    offset = np.arange(window)[:, None]
    live = offset < n
    return rows[first + np.minimum(offset, n - 1)], live


def score_windows(network: Network, vocab, first, n, odds, part=None, chunk: int = 4096) -> np.ndarray:
    """Logits of windows; ``odds`` are rows of words' odds, of which ``part`` names each window's."""
    x, out = network.inputs(vocab), np.zeros(len(first), np.float32)
    part = np.zeros(len(first), int) if part is None else part
    for a in range(0, len(first), chunk):
        places, live = laid_out(vocab[0], first[a : a + chunk], n[a : a + chunk], network.model.window)
        out[a : a + chunk] = network.forward(x, places, live, odds[part[None, a : a + chunk], places])
    return out


def top_of(owner, scores, texts: int):
    """Each text's highest window (-1 for none)."""
    order = np.lexsort((scores, owner))
    last = np.ones(len(order), bool)
    last[:-1] = owner[order][1:] != owner[order][:-1]
    best = np.full(texts, -1)
    best[owner[order[last]]] = order[last]
    return best


def fit(texts: pa.Array, toxic: np.ndarray, model: ToxicityModel) -> dict:
    """Weights and calibration from labelled texts."""
    words = Words(texts, NOT_ALNUM, LOWER)
    vocab = vocabulary(words, model)
    owner, first, n = windows_of(words, model)
    rng = np.random.default_rng(model.seed)
    back = rng.random(words.n) < model.held_back
    network = Network(model)
    part = rng.integers(0, model.parts, words.n)
    table, others = word_odds(words, vocab[0], toxic, part, ~back, model)
    # Held-back texts are counted nowhere, so they meet the odds of all the others.
    odds = np.stack([odds_of(words, t, model) for t in (*others, table)])
    part = np.where(back, model.parts, part)[owner]
    scores = np.array([odds[p, vocab[0][a : a + k]].max() for p, a, k in zip(part, first, n)])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.w.items()}
    step, begins = 0, np.searchsorted(owner, np.arange(words.n + 1))
    has = np.diff(begins) > 0
    train = np.flatnonzero(~back & has)
    positive = (toxic[train] == 1).mean()
    for epochs in model.rounds:
        best = top_of(owner, scores, words.n)
        for _ in range(epochs):
            clean = train[toxic[train] == 0]
            random = begins[clean] + (rng.random(len(clean)) * np.diff(begins)[clean]).astype(int)
            bad = train[toxic[train] == 1]
            picked = np.concatenate([best[bad], best[clean], random])
            target = np.concatenate([np.ones(len(bad)), np.zeros(2 * len(clean))]).astype(np.float32)
            order = rng.permutation(len(picked))
            for at in range(0, len(order), model.batch):
                some = order[at : at + model.batch]
                ids, y = picked[some], target[some]
                places, live = laid_out(vocab[0], first[ids], n[ids], model.window)
                near = odds[part[ids], places]
                distinct, places = np.unique(places, return_inverse=True)
                counts = vocab[4][distinct]
                take = np.arange(counts.sum()) + np.repeat(vocab[3][distinct] - np.cumsum(counts) + counts, counts)
                inputs = (None, vocab[1][distinct], vocab[2][take], np.cumsum(counts) - counts, counts)
                heavy = np.where(y == 1, np.float32(min(4.0, 0.5 / max(positive, 1e-3))), np.float32(1))
                grads = network.gradients(inputs, places.reshape(live.shape), live, y, heavy, near)
                step += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    rate = model.rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                    network.w[k] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        scores = score_windows(network, vocab, first, n, odds, part)
    check = np.flatnonzero(has & back) if (has & back).sum() >= 200 else np.flatnonzero(has)
    scale = calibration(text_evidence(owner, scores, words.n)[check], toxic[check])
    return network.w | {"scale": scale, "odds": table}


def text_evidence(owner, logits, texts: int) -> np.ndarray:
    """Per text: the highest logit, the logit of the mean score of its windows, and 1."""
    best = top_of(owner, logits, texts)
    high = np.where(best >= 0, logits[best] if len(logits) else 0, 0)
    windows = np.maximum(np.bincount(owner, minlength=texts), 1)
    mean = np.bincount(owner, _sigmoid(logits.astype(np.float64)), minlength=texts) / windows
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.stack([np.clip(high, -12, 12), np.log(mean / (1 - mean)), np.ones(texts)], axis=1)


def calibration(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of the evidence by ridge logistic regression (Newton steps of falling length)."""
    start = np.array([0.5, 0.5] + [0.0] * (x.shape[1] - 2))
    scale = start.copy()
    for i in range(200):
        p = _sigmoid(x @ scale)
        grad = x.T @ (p - y) + 0.5 * (scale - start)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(scale))
        most = 1 / (1 + i / 20)
        scale = scale - np.clip(np.linalg.solve(hess, grad), -most, most)
    return scale


def fold_of(doc_id: str, folds: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: dict, folds: int, held_out: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most[y]`` training ids of each label y, one row an id."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = rows.where(fold_of("doc_id", folds) != held_out)
    picked = None
    for y, n in most.items():
        some = rows.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = some if picked is None else picked.unionByName(some)
    return one_text(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "label")


def one_text(sample: DataFrame, *keys: str) -> DataFrame:
    """One row per id and further keys, however often it is repeated: the one with the least text."""
    return sample.groupBy("doc_id", *keys).agg(F.min("text").alias("text"))


def _fitted(batches, model: ToxicityModel):
    table = pa.Table.from_batches(list(batches), schema=pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32())])).sort_by(
        [("doc_id", "ascending"), ("text", "ascending")])
    toxic = table.column("label").to_numpy()
    out = io.BytesIO()
    if len(set(toxic.tolist())) == 2:
        np.savez(out, **fit(strings(table.column("text")), toxic, model))
    yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["weights"])


def train(docs: DataFrame, labels: DataFrame, model: ToxicityModel) -> bytes:
    """Weights, fitted in one task on the bounded sample; empty without labels of both kinds."""
    most = {1: model.most_toxic, 0: model.most_clean}
    sample = labelled_sample(docs, labels, "toxic", most, model.folds, model.held_out_fold)
    sample = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label").coalesce(1)
    made = in_arrow(sample, lambda batches: _fitted(batches, model), "weights binary").collect()
    return bytes(made[0][0]) if made else b""


def _scored(batches, weights: bytes, model: ToxicityModel):
    network = scale = table = None
    if weights:
        loaded = dict(np.load(io.BytesIO(weights)))
        scale, table = loaded.pop("scale"), loaded.pop("odds")
        network = Network(model, loaded)
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")), NOT_ALNUM, LOWER)
            score = np.zeros(words.n)
            if network and len(words):
                owner, first, n = windows_of(words, model)
                odds = odds_of(words, table, model)[None]
                logits = score_windows(network, vocabulary(words, model), first, n, odds)
                score = np.where(words.counts() > 0, _sigmoid(text_evidence(owner, logits, words.n) @ scale), 0.0)
            yield pa.RecordBatch.from_arrays(
                [strings(part.column("doc_id")).cast(pa.int64()), pa.array(score)], ["doc_id", "score"])


def score_toxicity(docs: DataFrame, labels: DataFrame, model: ToxicityModel | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = model or ToxicityModel()
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, model))
    scored = in_arrow(docs.select("doc_id", "text"), lambda batches: _scored(batches, weights.value, model),
                      "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id", model.folds) == model.held_out_fold, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= model.threshold).cast("int").alias("predicted"))
