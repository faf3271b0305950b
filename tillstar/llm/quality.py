"""Quality scores by positive-unlabelled learning.

A linear model is fitted to trusted good texts (positives) and unlabelled web text, by minimising
the non-negative unbiased risk

    prior * R_p+(g) + max(0, R_u-(g) - prior * R_p-(g))

where R_p+ is the mean loss of calling positives good, and R_u-, R_p- the mean losses of calling
unlabelled texts and positives bad. The class prior, the share of good texts among the unlabelled,
is estimated first: a plain positive-against-unlabelled model ranks rows it was not fitted to, and
the prior is the least ratio of the unlabelled share to the positive share above a threshold.

Features are shares, so long and short texts compare: letter cases, marks, repeated words and
lines, and pairs of neighbouring character shapes. Fitting uses a sample of about POSITIVE_ROWS
positives and UNLABELLED_ROWS unlabelled rows; only their feature vectors reach the driver. The rows
are chosen by hashes and fitted in an order of their own, so the model is the same whatever the
layout of the tables and the number of tasks. Scores use whole texts.

Defined results: a null text counts as empty; an empty text has all-zero features and so a score like
any other; without positives or unlabelled rows every score is 0.5; equal texts have equal
scores; other columns are carried along.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from tillstar.llm.common import map_rows, sampled, written

POSITIVE_ROWS = 6_000
UNLABELLED_ROWS = 12_000
PREDICT_FROM = 0.3
PAIR_PLACES = 512
STEPS = 400
RATE = 0.02
DECAY = 1e-4
BATCH_ROWS = 2_048
# Unlabelled rows with a positive share above a threshold, for the prior, are at least this share.
LEAST_SHARE = 0.3
PIECE_CHARS = 1_000_000

_shapes = None


@dataclass
class Model:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def _shape_table():
    """A shape for each code point: case or kind, and each ASCII mark for itself."""
    global _shapes
    if _shapes is None:
        kinds = np.full(0x110000, 5, np.uint8)
        for code in range(0x110000):
            c = chr(code)
            if code < 128 and not c.isalnum() and not c.isspace():
                kinds[code] = 6 + code % 58
            elif c == "\n":
                kinds[code] = 4
            elif c.isspace():
                kinds[code] = 3
            elif c.isalpha():
                kinds[code] = 1 if c.isupper() else 0
            elif c.isnumeric():
                kinds[code] = 2
        _shapes = kinds
    return _shapes


def _shape_counts(text):
    """Counts of shapes and of hashed pairs of shapes, piece by piece."""
    table = _shape_table()
    single, pairs = np.zeros(64, np.int64), np.zeros(64 * 64, np.int64)
    for start in range(0, len(text), PIECE_CHARS):
        piece = text[max(0, start - 1) : start + PIECE_CHARS]
        shape = table[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        single += np.bincount(shape[1 if start else 0 :], minlength=64)
        pairs += np.bincount(shape[:-1].astype(np.int64) * 64 + shape[1:], minlength=64 * 64)
    place = np.arange(64 * 64) * 0x9E3779B1 % (1 << 32) * PAIR_PLACES >> 32
    return single, np.bincount(place, weights=pairs, minlength=PAIR_PLACES)


def _repeats(items):
    """Share of items that are not the first of their kind, and share of the commonest."""
    if not items:
        return 0.0, 0.0
    seen = Counter(items)
    return 1 - len(seen) / len(items), max(seen.values()) / len(items)


def features(text):
    """The feature vector of a whole text."""
    single, pairs = _shape_counts(text)
    chars = max(1, len(text))
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    count = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    plain = [
        *(single[:6] / chars),
        single[6:].sum() / chars,
        *_repeats(words),
        *_repeats(lines),
        min(1.0, np.log1p(len(words)) / 12),
        (lengths.mean() if words else 0.0) / 10,
        (lengths.std() if words else 0.0) / 10,
        (lengths > 25).mean() if words else 0.0,
        sum(map(str.isupper, words)) / count,
        sum(map(str.istitle, words)) / count,
        sum(map(str.isalpha, words)) / count,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / count,
        len(lines) / count,
    ]
    return np.concatenate([plain, np.sqrt(pairs / chars)]).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(rows, gradient, rng):
    """Weights by Adam steps over mini-batches; the last place is the bias."""
    weights = np.zeros(rows)
    speed, power = np.zeros(rows), np.zeros(rows)
    for step in range(1, STEPS + 1):
        slope = gradient(weights, rng) + DECAY * weights
        speed = 0.9 * speed + 0.1 * slope
        power = 0.999 * power + 0.001 * slope**2
        weights -= RATE * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.999**step)) + 1e-8)
    return weights


def _mean_slope(x, weights, target):
    """Slope of the mean logistic loss of calling all rows the target."""
    return x.T @ ((_sigmoid(x @ weights) - target) / len(x))


def _batch(x, rng):
    return x if len(x) <= BATCH_ROWS else x[rng.integers(0, len(x), BATCH_ROWS)]


def estimate_prior(positive, unlabelled, rng):
    """Share of good rows among the unlabelled, from rows that a first model was not fitted to."""

    def slope(weights, rng):
        p, u = _batch(positive[::2], rng), _batch(unlabelled[::2], rng)
        return _mean_slope(p, weights, 1) + _mean_slope(u, weights, 0)

    weights = _descend(positive.shape[1], slope, rng)
    p = np.sort(positive[1::2] @ weights) if len(positive) > 1 else np.sort(positive @ weights)
    u = np.sort(unlabelled[1::2] @ weights) if len(unlabelled) > 1 else np.sort(unlabelled @ weights)
    at = p[: max(1, int(len(p) * (1 - LEAST_SHARE)))]
    p_above = 1 - np.searchsorted(p, at) / len(p)
    u_above = 1 - np.searchsorted(u, at) / len(u)
    doubt = np.sqrt(np.log(200) / 2) * (1 / np.sqrt(len(u)) + 1 / np.sqrt(len(p)))
    best = int(np.argmin((u_above + doubt) / p_above))
    return float(np.clip(u_above[best] / p_above[best], 0.05, 0.98))


def fit(positive, unlabelled, seed=13):
    """A model from feature vectors of positives and unlabelled rows."""
    width = len(features(""))
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    middle, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (_scaled(x, middle, spread) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    prior = estimate_prior(p, u, rng)

    def slope(weights, rng):
        batch_p, batch_u = _batch(p, rng), _batch(u, rng)
        good = _sigmoid(batch_p @ weights)
        # The mean loss of calling rows bad is the mean of log(1 + exp(g)).
        bad = np.logaddexp(0, batch_u @ weights).mean() - prior * np.logaddexp(0, batch_p @ weights).mean()
        bad_slope = _mean_slope(batch_u, weights, 0) - prior * _mean_slope(batch_p, weights, 0)
        good_slope = prior * (batch_p.T @ ((good - 1) / len(batch_p)))
        return good_slope + bad_slope if bad >= 0 else -bad_slope

    weights = _descend(p.shape[1], slope, rng)
    return Model(middle, spread, weights[:-1], float(weights[-1]), prior)


def _scaled(x, middle, spread):
    scaled = np.clip((x - middle) / spread, -6, 6)
    return np.concatenate([scaled, np.ones((len(x), 1), x.dtype)], axis=1)


def score_texts(model, texts):
    """Scores from 0 to 1 of whole texts."""
    if not texts:
        return np.zeros(0)
    x = _scaled(np.stack([features(t or "") for t in texts]), model.middle, model.spread)
    return _sigmoid(x @ np.append(model.weights, model.bias))


def _vectors(df, text):
    def make():
        return lambda texts: [[features(t or "").tobytes() for t in texts.to_pylist()]]

    rows = map_rows(df.select(F.col(text).alias("text")), [F.col("text")], make, {"x": "binary"}, keep=["text"])
    # Rows arrive in any order; theirs is by content, then mixed.
    found = sorted(rows.select("x").toArrow()["x"].to_pylist())
    found = [found[i] for i in np.random.default_rng(len(found)).permutation(len(found))]
    return np.frombuffer(b"".join(found), np.float32).reshape(len(found), len(features("")))


def train(docs, labels, text="text", positive_rows=POSITIVE_ROWS, unlabelled_rows=UNLABELLED_ROWS):
    """A model from the documents that labels call good and from all documents, unlabelled.

    Positives are sampled by id, before any text is read; of rows that repeat an id, the one with the
    least text counts.
    """
    good = labels.filter("quality = 1").select("doc_id").distinct()
    known = docs.select("doc_id").distinct().join(good, "doc_id", "left_semi")
    # About positive_rows ids, so small enough to broadcast.
    chosen = written(sampled(known, positive_rows / max(1, known.count()), 3, "doc_id"), "positives")
    rows = docs.select("doc_id", F.col(text).alias("text"))
    positives = rows.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    unlabelled = sampled(rows, unlabelled_rows / max(1, docs.count()), 5, "doc_id", "text")
    return fit(_vectors(positives, "text"), _vectors(unlabelled, "text"))


def score(df, model, text="text", keep=None):
    """Rows with `score`, from 0 to 1, higher for texts more like the positives."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [score_texts(shared.value, texts.to_pylist())]

    return map_rows(df, [F.col(text)], make, {"score": "double"}, keep)
