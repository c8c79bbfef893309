"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives and unlabelled texts, both bounded samples in the order of a hash of their ids,
become shares of hashed byte four-grams, of kinds of characters, and of words that repeat the word
one or two places before. A linear model
minimises the non-negative risk  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))  with the
logistic loss; where the second part falls below zero, the step climbs out of it. The class prior
is estimated first: a model of positives against unlabelled ranks a held-back third of both, and the
prior is the smallest ratio, over score thresholds, of the unlabelled share to the positive share
above the threshold, with a margin for sampling error (best-bin estimate).

Scoring is the mean of learned weights over a text's four-grams, so whole texts are read in one
pass, without a shuffle.

Defined results: a NULL or empty text has no features and gets the score of the intercept; a text
under four bytes has its counts only; repeated rows get equal scores; NULL ids are scored and never
learned from; without any positive or unlabelled row the model is undefined and an error says so;
an empty table to score gives no rows; other columns pass through ``keep_good`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.llm.common import chunks, fold, text_buffers
from tabwork.llm.text import NOT_SPACE, words

#: Hashed four-grams.
BITS = 11
_KINDS, _REPEATS = 7, 2
#: Features of a text.
WIDTH = (1 << BITS) + _KINDS + _REPEATS


def _byte_kinds() -> np.ndarray:
    """Kind of each byte: 0 other, 1 lower case, 2 upper case, 3 digit, 4 space, 5 line end, 6 punctuation."""
    kinds = np.zeros(256, np.int64)
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[32], kinds[10], kinds[33:48], kinds[58:65] = 1, 2, 3, 4, 5, 6, 6
    kinds[91:97], kinds[123:127] = 6, 6
    return kinds


KINDS = _byte_kinds()


def grams(data: np.ndarray) -> np.ndarray:
    """The hashed four-gram that starts at each byte but the last three."""
    if len(data) < 4:
        return np.empty(0, np.int64)
    d = data.astype(np.uint32)
    x = d[:-3] | (d[1:-2] << np.uint32(8)) | (d[2:-1] << np.uint32(16)) | (d[3:] << np.uint32(24))
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def repeats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of a text's words that equal the word one and two places before."""
    w = words(data, offsets, NOT_SPACE)
    out, owner = np.zeros((len(offsets) - 1, _REPEATS)), w.owner()
    for back in range(1, _REPEATS + 1):
        same = (w.hashes[back:] == w.hashes[:-back]) & (owner[back:] == owner[:-back])
        out[:, back - 1] = np.bincount(owner[back:][same], minlength=len(out)) / np.maximum(w.counts, 1)
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of scaled shares per text: four-grams, kinds of bytes, repeated words."""
    out = np.zeros((len(offsets) - 1, WIDTH), np.float32)
    out[:, -_REPEATS:] = repeats(data, offsets) * 30
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        g = grams(data[a:b])
        if len(g):
            out[i, : 1 << BITS] = np.bincount(g, minlength=1 << BITS) / len(g) * 100
        if b > a:
            out[i, 1 << BITS : -_REPEATS] = np.bincount(KINDS[data[a:b]], minlength=_KINDS) / (b - a) * 10
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float
    prior: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of the positive class for each text."""
        z = self.intercept + repeats(data, offsets) @ self.weights[-_REPEATS:] * 30
        base, n = offsets[0], offsets[-1] - offsets[0]
        starts, lengths = offsets[:-1] - base, np.diff(offsets)
        data = data[base : offsets[-1]]
        per_byte = np.zeros(n + 1)
        np.cumsum(self.weights[1 << BITS : -_REPEATS][KINDS[data]], out=per_byte[1:])
        per_gram = np.zeros(n + 1)
        g = grams(data)
        np.cumsum(self.weights[: 1 << BITS][g], out=per_gram[1 : 1 + len(g)])
        per_gram[1 + len(g) :] = per_gram[len(g)]
        n_grams = np.maximum(lengths - 3, 0)
        z += (per_byte[starts + lengths] - per_byte[starts]) / np.maximum(lengths, 1) * 10
        z += (per_gram[starts + n_grams] - per_gram[starts]) / np.maximum(n_grams, 1) * 100
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 200, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float, list[float]]:
    """Weights, intercept and the course of the non-negative risk, by full-batch Adam."""
    w, b = np.zeros(positive.shape[1], np.float32), 0.0
    m, v, risks = np.zeros(len(w) + 1), np.zeros(len(w) + 1), []
    for t in range(1, steps + 1):
        p, u = _sigmoid(positive @ w + b), _sigmoid(unlabelled @ w + b)
        gain = prior * -np.log(p + 1e-12).mean()
        negative = -np.log(1 - u + 1e-12).mean() - prior * -np.log(1 - p + 1e-12).mean()
        risks.append(gain + max(0.0, negative))
        by_u, by_p = u / len(u), -prior * p / len(p)  # derivatives of the negative part by the scores
        if negative < 0:
            du, dp = -by_u, -by_p
        else:
            du, dp = by_u, by_p - prior * (1 - p) / len(p)
        grad = np.append(dp.astype(np.float32) @ positive + du.astype(np.float32) @ unlabelled + decay * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), float(b - step[-1])
    return w.astype(np.float64), b, risks


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, margin: float = 0.05) -> float:
    """Best-bin estimate of the share of positives among the unlabelled."""
    cut_p, cut_u = len(positive) * 2 // 3, len(unlabelled) * 2 // 3
    w, b, _ = minimise(positive[:cut_p], unlabelled[:cut_u], 0.5, steps=60)
    p, u = np.sort(positive[cut_p:] @ w + b), np.sort(unlabelled[cut_u:] @ w + b)
    if not len(p) or not len(u):
        return 0.5
    above_p = 1 - np.arange(len(p)) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    slack = np.sqrt(np.log(4 / margin) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    ratio = above_u / above_p
    best = int(np.argmin(ratio + slack / above_p))
    return float(np.clip(ratio[best], 0.05, 0.99))


def _sample(ids: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` ids first in the order of a hash; a bounded number, so it can be broadcast."""
    return F.broadcast(ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def _matrix(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                found = features(data, offsets[lo : hi + 1]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in found], pa.binary())], names=["doc_id", "x"])

    rows = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(run, "doc_id long, x binary").toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    found = [np.frombuffer(x.as_py(), np.float16) for x in rows.column("x")]
    return np.stack(found)[order].astype(np.float32) if found else np.empty((0, WIDTH), np.float32)


def train(docs: DataFrame, positive_ids: DataFrame, unlabelled_ids: DataFrame, rows: int = 4000) -> QualityModel:
    """Fit on at most ``rows`` positives and ``rows`` unlabelled documents, each given by a table of ``doc_id``."""
    positive, unlabelled = _matrix(docs, _sample(positive_ids, rows)), _matrix(docs, _sample(unlabelled_ids, rows))
    if not len(positive) or not len(unlabelled):
        raise ValueError("learning needs positive and unlabelled documents")
    shuffled = np.random.default_rng(5)
    positive, unlabelled = shuffled.permutation(positive), shuffled.permutation(unlabelled)
    prior = estimate_prior(positive, unlabelled)
    w, b, _ = minimise(positive, unlabelled, prior)
    return QualityModel(w, b, prior)


def train_on_labels(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, rows: int = 4000) -> QualityModel:
    """Positives are the labels of quality 1, the unlabelled are all documents; neither from the fold held out."""
    usable = lambda df: df.where(fold("doc_id", folds) != held_out)
    return train(docs, usable(labels.where("quality = 1").select("doc_id")), usable(docs.select("doc_id")), rows)


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for lo, hi in chunks(offsets):
                found = sent.value.score(data, offsets[lo : hi + 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The documents with a score of at least ``threshold``, with all their columns."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(at))
            for lo, hi in chunks(offsets):
                yield batch.slice(lo, hi - lo).filter(pa.array(sent.value.score(data, offsets[lo : hi + 1]) >= threshold))

    return docs.mapInArrow(run, docs.schema)
