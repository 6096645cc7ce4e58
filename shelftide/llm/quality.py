"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

Every document of label 1 is preferred to every document of label 0. The chance that i beats j is
the logistic function of w . (x_i - x_j); w minimises the logistic loss over ``PAIRS`` drawn
partners for each document of the rarer label, with a ridge. The threshold is the quantile of the training
scores that errs least on the training labels, and scores are put on a 0-1 scale so that it is
``CUT``.

The model is fitted on the driver on a bounded sample: at most about ``SAMPLE`` documents of each
label, those of lowest hash. Scores and decisions cover all documents.

Defined results: null and empty texts have the features of no words; labels other than 0 and 1 and
null ids teach nothing; of repeated labels or documents of one id the lowest counts; without labels of
both kinds every score is 0.5; a text of any length is read whole; documents with a score right at the cut
are predicted 1, and equal texts have equal scores; score and predicted take the place of carried columns of
those names, other columns of the documents may have any name; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import column, utf8, with_columns

SAMPLE = 20_000
PAIRS = 10
CUT = 0.3
RIDGE = 1e-3
FEATURES = 12

_LETTERS = np.arange(256)
UPPER = (_LETTERS >= 65) & (_LETTERS <= 90)
LOWER = (_LETTERS >= 97) & (_LETTERS <= 122)
DIGIT = (_LETTERS >= 48) & (_LETTERS <= 57)
WIDE = _LETTERS >= 128
SPACE = np.isin(_LETTERS, [*range(9, 14), 32])
STOP = np.isin(_LETTERS, [ord(c) for c in ".,;:?"])
LOUD = _LETTERS == ord("!")
BAR = _LETTERS == ord("|")
MARK = ~(UPPER | LOWER | DIGIT | WIDE | SPACE | STOP | LOUD | BAR) & (_LETTERS > 32)
CLASSES = np.stack([UPPER, LOWER, DIGIT, WIDE, SPACE, STOP, LOUD, BAR, MARK]).astype(float).T


def features(text: bytes) -> list[float]:
    """Rates of letters, marks and repetition; they do not depend on length but for its logarithm."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * FEATURES
    upper, lower, digit, wide, _, stop, loud, bar, mark = (
        np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ CLASSES)
    size = len(text)
    distinct = len(set(words))
    return [np.sqrt(upper / max(1, upper + lower)), np.sqrt(digit / size), np.sqrt(wide / size),
            np.sqrt(stop / n), np.sqrt(loud / n), np.sqrt(bar / n), np.sqrt(mark / n),
            np.sqrt(sum(map(eq, words, words[1:])) / n), distinct / n,
            np.log(distinct / n ** 0.85), (size - n) / n / 10, np.log1p(n) / 10]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    quantile: float
    threshold: float
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        if not self.weights.any():
            return np.full(len(x), 0.5)
        at = self.slope * (z - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(at, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 1) -> Model:
    """x: features, y: labels 0 or 1, weight: documents each row of the sample stands for."""
    width = x.shape[1]
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0, 1.0)
    order = np.lexsort((*x.T, y))  # the fit does not depend on the order of arrival
    x, y, weight = x[order], y[order], weight[order]
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    few, many = sorted((good, bad), key=len)
    partner = rng.choice(many, (len(few), PAIRS))
    first = np.repeat(few, PAIRS)
    winners, losers = (first, partner.ravel()) if few is good else (partner.ravel(), first)
    d = z[winners] - z[losers]
    w = np.zeros(width)
    for _ in range(30):  # Newton's method on the logistic loss of the differences
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        gradient = -(d * p[:, None]).mean(0) + RIDGE * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    s = z @ w
    by = np.argsort(s, kind="stable")
    s, y, weight = s[by], y[by], weight[by]
    # errors if the k lowest are rejected: the good ones among them, the bad ones above
    lost = np.concatenate([[0], np.cumsum(weight * (y == 1))])
    passed = (weight * (y == 0)).sum() - np.concatenate([[0], np.cumsum(weight * (y == 0))])
    errors = lost + passed
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    k = int(np.clip(best[len(best) // 2], 1, len(s) - 1))
    threshold = (s[k - 1] + s[k]) / 2
    slope = 1.0
    for _ in range(50):  # one coefficient: how fast the chance of label 1 rises from the threshold
        p = 1 / (1 + np.exp(-np.clip(slope * (s - threshold) + np.log(CUT / (1 - CUT)), -500, 500)))
        g = (weight * (p - y) * (s - threshold)).sum() / weight.sum() + 1e-3 * (slope - 1)
        h = (weight * p * (1 - p) * (s - threshold) ** 2).sum() / weight.sum() + 1e-3
        slope = max(0.05, slope - np.clip(g / h, -1, 1))
    return Model(mean, scale, w, float(weight[:k].sum() / weight.sum()), float(threshold),
                 float(slope))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def featured(docs: DataFrame, text: str, carry) -> DataFrame:
    def start():
        def work(texts):
            return [pa.array([features(t) for t in utf8(texts)], pa.list_(pa.float64()))]
        return work

    return with_columns(docs, [text], "x array<double>", start, carry)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text") -> Model:
    """Fit on a sample of the labelled documents that are not held out."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                          & (remainder(F.col("doc_id"), 5) != 0))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = {q: min(1.0, sample / max(1, counts.get(q, 0))) for q in (0, 1)}
    bound = F.when(F.col("quality") == 1, share[1]).otherwise(share[0]) * 2.0**31
    taken = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < bound)
    own = docs.select("doc_id", column(text).alias("text"))
    rows = (featured(own.join(F.broadcast(taken), "doc_id"), "text", ["doc_id", "quality"])
            .groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect())
    y = np.array([r.quality for r in rows], int)
    x = np.array([r.x for r in rows], float).reshape(len(rows), FEATURES)
    return fit(x, y, np.array([1 / share[q] for q in y.tolist()]))


def scored(docs: DataFrame, model: Model, text: str = "text", carry=("doc_id",)) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from the threshold on)."""
    def start():
        def work(texts):
            x = np.array([features(t) for t in utf8(texts)]).reshape(len(texts), FEATURES)
            s = model.scores(x) if len(texts) else np.zeros(0)
            return [pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32))]
        return work

    return with_columns(docs, [text], "score double, predicted int", start, carry)
