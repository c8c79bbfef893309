"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``WINDOW`` bytes; a network of one gated recurrent layer in each
direction reads a window from both ends and gives every byte position a probability for each
language, and a text's probabilities are the mean over all its positions. Recurrence restarts at
window borders, where the other direction still has its context. Gates and candidate use the
piecewise-linear sigmoid and tanh, which cost no exponentials. Training is plain backpropagation
through time in numpy on a bounded sample of windows, in the order of a hash of the ids.

Defined results: NULL text and texts without a letter are ``und`` with score 0; a class is any
non-null ``lang`` of the sample; equal probabilities go to the lesser name; repeated rows get
equal results; NULL ids are predicted and never learned from; learning without any row raises an
error; an empty table to predict gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.llm.common import chunks, fold, text_buffers

WINDOW = 128
HIDDEN = 8
#: Windows read together in one step, and windows of a text that are sampled for training.
BATCH, PER_TEXT = 4096, 2


def _gate(x: np.ndarray) -> np.ndarray:
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


@dataclass
class Direction:
    """One gated recurrent layer: inputs by table over bytes (256 is padding), recurrent weights, each for update, reset, candidate."""

    table: np.ndarray  # (3 * HIDDEN, 257), biases within
    recurrent: np.ndarray  # (3 * HIDDEN, HIDDEN)

    def read(self, steps: np.ndarray) -> list[np.ndarray]:
        """Hidden states (windows, HIDDEN) after each of the steps (time, windows); the affine part of the gates is folded into the weights."""
        n = HIDDEN
        scale = np.repeat(np.float32([0.25, 0.25, 1.0]), n)[:, None]
        table = self.table * scale + np.repeat(np.float32([0.5, 0.5, 0.0]), n)[:, None]
        tables = [np.ascontiguousarray(t.T) for t in np.split(table, 3)]
        weights = [np.ascontiguousarray(w.T) for w in np.split(self.recurrent * scale, 3)]
        h, states = np.zeros((steps.shape[1], n), np.float32), []
        for byte in steps:
            z, r, c = (np.take(t, byte, axis=0, mode="clip") for t in tables)
            z += h @ weights[0]
            np.clip(z, 0, 1, out=z)
            r += h @ weights[1]
            np.clip(r, 0, 1, out=r)
            r *= h @ weights[2]
            c += r
            np.clip(c, -1, 1, out=c)
            h = h - c
            h *= z
            h += c
            states.append(h)
        return states

    def run(self, steps: np.ndarray) -> tuple[list[np.ndarray], list[tuple]]:
        """Hidden states (HIDDEN, windows) after each of the steps (time, windows), and what backpropagation needs of each."""
        n = HIDDEN
        h = np.zeros((n, steps.shape[1]), np.float32)
        states, past = [], []
        for byte in steps:
            x = np.take(self.table, byte, axis=1)
            u = self.recurrent @ h
            zr = _gate(x[: 2 * n] + u[: 2 * n])
            z, r = zr[:n], zr[n:]
            raw = r * u[2 * n :]
            raw += x[2 * n :]
            c = np.clip(raw, -1, 1)
            new = h - c
            new *= z
            new += c
            past.append((h, zr, u[2 * n :], raw, c, byte))
            h = new
            states.append(h)
        return states, past

    def back(self, past: list[tuple], outer: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and recurrent weights from the gradients of the states."""
        n = HIDDEN
        d_table, d_recurrent = np.zeros_like(self.table), np.zeros_like(self.recurrent)
        carry, by_step = np.zeros_like(outer[0]), []
        for (h, zr, uc, raw, c, byte), out in zip(reversed(past), reversed(outer)):
            dh = out + carry
            z, r = zr[:n], zr[n:]
            d_raw = dh * (1 - z) * (np.abs(raw) < 1)
            d_gate = np.concatenate([dh * (h - c), d_raw * uc]) * (0.25 * ((zr > 0) & (zr < 1)))
            d_u = np.concatenate([d_gate, d_raw * r])
            d_x = np.concatenate([d_gate, d_raw])
            d_recurrent += d_u @ h.T
            by_step.append(d_x)
            carry = self.recurrent.T @ d_u + dh * z
        read = np.concatenate([byte for *_, byte in reversed(past)])
        for k, row in enumerate(np.concatenate(by_step, axis=1)):
            d_table[k] = np.bincount(read, weights=row, minlength=self.table.shape[1])
        return d_table, d_recurrent


@dataclass
class LanguageModel:
    names: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # (languages, 2 * HIDDEN + 1)

    def positions(self, steps: np.ndarray) -> Iterator[np.ndarray]:
        """Probabilities (windows, languages) of each position of the windows in columns, position by position."""
        ahead, behind, n = self.forward.read(steps), self.backward.read(steps[::-1]), HIDDEN
        by_ahead, by_behind = (np.ascontiguousarray(w.T) for w in (self.output[:, :n], self.output[:, n : 2 * n]))
        for t in range(len(steps)):
            p = ahead[t] @ by_ahead
            p += behind[-1 - t] @ by_behind
            p += self.output[:, -1]
            np.exp(np.clip(p, -60, 60, out=p), out=p)
            p /= p.sum(axis=1, keepdims=True)
            yield p

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities (texts, languages) over all positions of each text."""
        lengths = np.diff(offsets)
        per_text = -(-lengths // WINDOW)
        owner = np.repeat(np.arange(len(lengths)), per_text)
        first = np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = offsets[:-1][owner] + (np.arange(len(owner)) - first) * WINDOW
        sizes = np.minimum(offsets[1:][owner] - starts, WINDOW)
        sums = np.zeros((len(lengths), len(self.names)))
        order = np.argsort(-sizes, kind="stable")
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            total = np.zeros((len(part), len(self.names)), np.float32)
            for t, found in enumerate(self.positions(_columns(data, starts[part], sizes[part]))):
                live = int(np.searchsorted(-sizes[part], -t, "left"))  # windows longer than t come first
                total[:live] += found[:live]
            for k in range(len(self.names)):
                sums[:, k] += np.bincount(owner[part], weights=total[:, k], minlength=len(lengths))
        return sums / np.maximum(lengths, 1)[:, None]


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-2, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-2, keepdims=True)
    return x


def _columns(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Windows as columns of bytes, padded by 256 to the longest."""
    time = np.arange(int(sizes.max()) if len(sizes) else 0)[:, None]
    at = np.minimum(starts + time, max(len(data) - 1, 0))
    return np.where(time < sizes, data[at].astype(np.int64), 256)


def fit(windows: list[bytes], labels: np.ndarray, names: list[str], steps: int = 400, batch: int = 128, rate: float = 0.02, seed: int = 3) -> LanguageModel:
    """Cross-entropy of every position by Adam and backpropagation through time; the windows are of one length."""
    rng = np.random.default_rng(seed)
    n, k = HIDDEN, len(names)
    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    model = LanguageModel(names, Direction(small(3 * n, 257), small(3 * n, n)), Direction(small(3 * n, 257), small(3 * n, n)), small(k, 2 * n + 1))
    parts = [model.forward.table, model.forward.recurrent, model.backward.table, model.backward.recurrent, model.output]
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    all_bytes = np.array([np.frombuffer(w, np.uint8) for w in windows]).T.astype(np.int64)
    for t in range(1, steps + 1):
        pick = rng.integers(0, all_bytes.shape[1], batch)
        steps_, want = all_bytes[:, pick], labels[pick]
        ahead, past_a = model.forward.run(steps_)
        behind, past_b = model.backward.run(steps_[::-1])
        out, length = model.output, len(steps_)
        da, db, d_out = [], [None] * length, np.zeros_like(out)
        for i in range(length):
            a, b = ahead[i], behind[-1 - i]
            p = _softmax(out[:, :n] @ a + out[:, n : 2 * n] @ b + out[:, -1:])
            p[want, np.arange(batch)] -= 1
            p /= batch * length
            d_out[:, :n] += p @ a.T
            d_out[:, n : 2 * n] += p @ b.T
            d_out[:, -1] += p.sum(axis=1)
            da.append(out[:, :n].T @ p)
            db[length - 1 - i] = out[:, n : 2 * n].T @ p
        grads = [*model.forward.back(past_a, da), *model.backward.back(past_b, db), d_out]
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
        for p, g, first, second in zip(parts, grads, m, v):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first += 0.1 * (g - first)
            second += 0.01 * (g**2 - second)
            p -= rate * (1 - 0.7 * t / steps) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-7)
    return model


def train(docs: DataFrame, folds: int = 4, held_out: int = 2, rows: int = 600) -> LanguageModel:
    """Fit on at most ``rows`` documents of each language outside the fold held out, ``PER_TEXT`` windows of each.

    Languages are the distinct ``lang`` values; their number is small by the meaning of the column.
    """
    usable = docs.where((fold("doc_id", folds) != held_out) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("doc_id", "lang", "text")
    names = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    if not names:
        raise ValueError("learning needs documents with a language")
    windows, labels = [], []
    for k, name in enumerate(names):
        ids = usable.where(F.col("lang") == name).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        rows_ = usable.where(F.col("lang") == name).join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(_sampled_windows, "doc_id long, windows array<binary>").toArrow()
        for _, found in sorted(zip(rows_.column(0).to_pylist(), rows_.column(1).to_pylist())):
            windows += found
            labels += [k] * len(found)
    balanced = _balanced(np.array(labels), len(names))
    return fit([windows[i] for i in balanced], np.array(labels)[balanced], names)


def _balanced(labels: np.ndarray, n: int) -> list[int]:
    """Indices with as many of each label, the rarer ones repeated."""
    by = [np.flatnonzero(labels == k) for k in range(n)]
    most = max(len(x) for x in by)
    return np.concatenate([np.resize(x, most) for x in by]).tolist()


def _sampled_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows spread evenly over each text; a shorter text is repeated up to the length of a window."""
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        rows = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            if b - a < WINDOW:
                rows.append([np.resize(data[a:b], WINDOW).tobytes()])
            else:
                rows.append([data[at : at + WINDOW].tobytes() for at in np.linspace(a, b - WINDOW, PER_TEXT + 2)[1:-1].astype(int)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.binary()))], names=["doc_id", "windows"])


def predict(docs: DataFrame, model: LanguageModel, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score) for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in chunks(offsets, 1 << 20):
                part = batch.slice(lo, hi - lo)
                found = model.pooled(data, offsets[lo : hi + 1])
                letters = np.array(part.column("letters").to_pylist(), bool)
                best = found.argmax(axis=1)
                names = [model.names[k] if ok else "und" for k, ok in zip(best, letters)]
                score = np.clip(np.where(letters, found[np.arange(len(best)), best], 0.0), 0, 1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(
        "doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)).alias("letters"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
