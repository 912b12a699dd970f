"""A quality classifier learnt from trusted positives and unlabelled text.

Negative labels are never used. With the share of positives among all texts (the class
prior) known, the risk of a classifier on negatives follows from its risks on unlabelled
texts and on positives; the estimate is kept from falling below zero (non-negative
unbiased risk), which would mean that the network fits the unlabelled texts by heart.

The prior is estimated first: a network that tells positives from unlabelled texts ranks
texts, and among the texts above any of its thresholds the unlabelled share over the
positive share is never below the prior, so the smallest such ratio on texts held back is it.

Inputs are measures of form: kinds of characters, word lengths and shapes, repetition.
Both samples are bounded by parameters (rows with the smallest hash of their id) and the
network is fitted in one task. Every whole text is scored. Null and empty texts have the
measures of no words and are scored like any other. Without positives all scores are 0.
"""

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import in_arrow
from .toxicity import fold_of, one_text
from .words import BLANKS, Words, gram_codes, slices, strings


@dataclass(frozen=True)
class QualityModel:
    hidden: int = 24
    most_positive: int = 4000
    most_unlabelled: int = 6000
    prior_steps: int = 60
    steps: int = 400
    rate: float = 0.01
    decay: float = 1e-4
    shapes: int = 24
    folds: int = 5
    held_out_fold: int = 0
    threshold: float = 0.3
    seed: int = 5


KINDS = np.zeros(256, np.uint8)  # other bytes: 0
KINDS[0x61:0x7B] = 1
KINDS[0x41:0x5B] = 2
KINDS[0x30:0x3A] = 3
KINDS[list(b".,;:!?'\"()-")] = 4
KINDS[list(b"#*$%&|<>@^_~=+/\\`{}[]")] = 5
KINDS[BLANKS] = 6
KINDS[0x80:] = 7


def measures(words: Words, model: QualityModel) -> np.ndarray:
    """One row of measures per text."""
    n, kinds = words.n, KINDS[words.data]
    size = np.diff(words.at)
    counts = words.counts()
    share = [words.per_text(kinds == k) / np.maximum(size, 1) for k in range(1, 8)]
    length = (words.end - words.start).astype(np.float64)
    owner = np.repeat(np.arange(n), counts)
    some = np.maximum(counts, 1)

    def mean(values):
        return np.bincount(owner, values, minlength=n) / some

    average = mean(length)
    by_kind = np.zeros((8, len(words.data) + 1), np.int32)
    for k in range(1, 8):
        np.cumsum(kinds == k, out=by_kind[k, 1:])
    inside = (by_kind[:, words.end] - by_kind[:, words.start]).astype(np.float64)
    letters = inside[1] + inside[2] + inside[7]
    shape = ((inside[2] > 0) * 1 + (inside[2] > 1) * 1 + (inside[3] > 0) * 3 + (inside[5] > 0) * 6
             + (letters == 0) * 12).astype(int) % model.shapes
    shapes = np.zeros((n, model.shapes))
    np.add.at(shapes, (owner, shape), 1)
    shapes /= some[:, None]
    hashes = words.hash
    again = np.zeros(len(words))
    if len(words):
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    grams = gram_codes(hashes, 3)
    repeats = np.zeros((n, 4))
    data = words.data.tobytes()
    for k in range(n):
        a, b = int(words.first[k]), int(words.first[k + 1])
        if a == b:
            continue
        seen = np.unique(hashes[a:b], return_counts=True)[1]
        runs = grams[a : b - 2]
        lines = [x for x in data[words.at[k] : words.at[k + 1]].split(b"\n") if x.strip()]
        repeats[k] = (len(seen) / (b - a), seen.max() / (b - a),
                      1 - len(np.unique(runs)) / len(runs) if b - a > 2 else 0.0,
                      1 - len(set(lines)) / max(1, len(lines)))
    columns = [np.log1p(counts), np.log1p(size), average, np.sqrt(np.maximum(mean(length ** 2) - average ** 2, 0)),
               mean(length <= 3), mean(length >= 12), mean(again), *share]
    return np.hstack([np.stack(columns, axis=1), repeats, np.sqrt(shapes)])


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


class Scorer:
    """Standardised measures, one hidden layer, one logit."""

    def __init__(self, width: int, model: QualityModel, seed: int, weights: dict | None = None):
        rng = np.random.default_rng(seed)
        self.w = weights or {
            "a": rng.standard_normal((width, model.hidden)) * width ** -0.5, "b": np.zeros(model.hidden),
            "c": rng.standard_normal(model.hidden) * model.hidden ** -0.5, "d": np.zeros(1)}
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        self.step = 0

    def logits(self, x):
        return np.tanh(x @ self.w["a"] + self.w["b"]) @ self.w["c"] + self.w["d"][0]

    def descend(self, x, d_logit, model: QualityModel):
        """One Adam step along a gradient given per logit."""
        hidden = np.tanh(x @ self.w["a"] + self.w["b"])
        inner = d_logit[:, None] * self.w["c"] * (1 - hidden ** 2)
        grads = {"a": x.T @ inner, "b": inner.sum(axis=0), "c": hidden.T @ d_logit, "d": d_logit.sum(keepdims=True)}
        self.step += 1
        for k, g in grads.items():
            m, v = self.moments[k]
            g = g + model.decay * self.w[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.w[k] = self.w[k] - model.rate * (m / (1 - 0.9 ** self.step)) / (
                np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)


def estimate_prior(pos: np.ndarray, unl: np.ndarray, model: QualityModel) -> float:
    """The share of positives among the unlabelled rows, less two standard errors.

    Each half of the rows is judged by a network fitted on the other half.
    """
    rng = np.random.default_rng(model.seed)
    half_p, half_u = rng.random(len(pos)) < 0.5, rng.random(len(unl)) < 0.5
    ratios = []
    for side in (False, True):
        p, u = pos[half_p == side], unl[half_u == side]
        x, y = np.vstack([p, u]), np.concatenate([np.ones(len(p)), np.zeros(len(u))])
        net = Scorer(x.shape[1], model, model.seed)
        for _ in range(model.prior_steps):
            net.descend(x, (_sigmoid(net.logits(x)) - y) / len(y), model)
        a, b = net.logits(pos[half_p != side]), net.logits(unl[half_u != side])
        if len(a) and len(b):
            cuts = np.quantile(a, np.linspace(0.05, 0.5, 10))
            ratios.append([(b >= cut).mean() / (a >= cut).mean() for cut in cuts])
    low = float(np.mean(ratios, axis=0).min()) if ratios else 0.5
    return float(np.clip(low - 2 * (max(0.0, low * (1 - low)) / max(1, len(unl))) ** 0.5, 0.05, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray, model: QualityModel) -> dict:
    """Weights by the non-negative risk of positives and unlabelled rows."""
    both = np.vstack([pos, unl])
    centre, spread = both.mean(axis=0), both.std(axis=0) + 1e-6
    pos, unl = (np.clip((x - centre) / spread, -8, 8) for x in (pos, unl))
    prior = estimate_prior(pos, unl, model)
    net, x = Scorer(pos.shape[1], model, model.seed + 1), np.vstack([pos, unl])
    for _ in range(model.steps):
        p = _sigmoid(net.logits(x))
        p_pos, p_unl = p[: len(pos)], p[len(pos) :]
        # Mean logistic losses: of positives called negative, of unlabelled called negative.
        as_negative = -np.log(1 - p_unl + 1e-9).mean() - prior * -np.log(1 - p_pos + 1e-9).mean()
        d_neg = np.concatenate([-prior * p_pos / len(pos), p_unl / len(unl)])
        if as_negative >= 0:
            d = d_neg + np.concatenate([prior * (p_pos - 1) / len(pos), np.zeros(len(unl))])
        else:
            d = -d_neg  # undo the overfit of the unlabelled rows
        net.descend(x, d, model)
    return net.w | {"centre": centre, "spread": spread, "prior": np.array([prior])}


def _measured(batches, model: QualityModel):
    for batch in batches:
        for part in slices(batch):
            values = measures(Words(strings(part.column("text"))), model)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(values.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "label", "x"])


def _fitted(batches, model: QualityModel):
    rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: (r["doc_id"], r["x"]))
    pos, unl = (np.array([r["x"] for r in rows if r["label"] == y]) for y in (1, 0))
    out = io.BytesIO()
    if len(pos) and len(unl):
        np.savez(out, **fit(pos, unl, model))
    yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["weights"])


def train(docs: DataFrame, labels: DataFrame, model: QualityModel) -> bytes:
    """Weights, fitted in one task on the measures of the two bounded samples."""
    kept = fold_of("doc_id", model.folds) != model.held_out_fold
    chance = F.xxhash64("doc_id", F.lit(model.seed))
    good = labels.where((F.col("quality") == 1) & kept).select("doc_id").distinct()
    good = good.orderBy(chance, "doc_id").limit(model.most_positive)
    rest = docs.where(kept).select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(-model.seed)), "doc_id")
    picked = good.withColumn("label", F.lit(1)).unionByName(
        rest.limit(model.most_unlabelled).distinct().withColumn("label", F.lit(0)))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    measured = in_arrow(one_text(sample, "label").select("doc_id", "text", "label"), lambda batches: _measured(batches, model),
                        "doc_id long, label int, x array<double>")
    made = in_arrow(measured.repartition(1), lambda batches: _fitted(batches, model), "weights binary").collect()
    return bytes(made[0][0]) if made else b""


def _scored(batches, weights: bytes, model: QualityModel):
    w = dict(np.load(io.BytesIO(weights))) if weights else None
    for batch in batches:
        for part in slices(batch):
            words = Words(strings(part.column("text")))
            score = np.zeros(words.n)
            if w is not None:
                x = np.clip((measures(words, model) - w["centre"]) / w["spread"], -8, 8)
                score = _sigmoid(Scorer(x.shape[1], model, 0, w).logits(x))
            yield pa.RecordBatch.from_arrays(
                [strings(part.column("doc_id")).cast(pa.int64()), pa.array(score)], ["doc_id", "score"])


def score_quality(docs: DataFrame, labels: DataFrame, model: QualityModel | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = model or QualityModel()
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, model))
    scored = in_arrow(docs.select("doc_id", "text"), lambda batches: _scored(batches, weights.value, model),
                      "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id", model.folds) == model.held_out_fold, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= model.threshold).cast("int").alias("predicted"))
