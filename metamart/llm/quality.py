"""Quality classifier: a factorisation machine (op5).

Inputs of a score are the whole text and its length only: hashed words,
statistics of its structure (shares of character classes, repetition, lengths)
and the metadata that every text has (its size in bytes, words and lines).
The score is logistic(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the
pairwise part is computed in time linear in the features by
1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

Training takes at most ``SAMPLE_ROWS`` labelled rows (a documented bound; rows
in the order of a hash of doc_id), whose features the executors compute; the
numbers of a row are bounded by ``BUCKETS`` whatever its length.  Scoring runs
in Arrow batches without a shuffle.

Defined results: null and empty texts get the score of a text without words;
without both classes in the sample the score is the constant 0.5 (no labels) or
the only label's side (0.25 / 0.75).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from metamart.llm import supervised
from metamart.llm.common import binary_column, list_array, remembering, small_batches, word_codes

FOLDS, FOLD = 3, 1
SAMPLE_ROWS = 5000
BUCKETS = 1 << 15
RANK = 8
EPOCHS = 12

# classes of bytes, counted as shares of a text
_CLASS = np.zeros(256, np.uint8)
for _i, _members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t",
                               b"\r\n", b".,", b"!?;:", b"'\"()-", b"|", b"#$%&*@~^_+=<>/\\[]{}`", bytes(range(128, 256)))):
    _CLASS[list(_members)] = _i + 1
N_CLASSES = 12
N_STATS = N_CLASSES + 10


def structure(text: bytes, codes: np.ndarray, distinct: int, top: int) -> np.ndarray:
    """Statistics of a text's structure and its size."""
    n, words = len(text), len(codes)
    share = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=N_CLASSES) / max(n, 1)
    lines = text.split(b"\n")
    sentences = text.count(b".") + text.count(b"!") + text.count(b"?")
    same = np.count_nonzero(codes[1:] == codes[:-1]) if words > 1 else 0
    rest = (np.log1p(n), np.log1p(words), np.log1p(len(lines)), n / max(words, 1), distinct / max(words, 1),
            top / max(words, 1), same / max(words, 1), len(set(lines)) / len(lines), words / (sentences + 1),
            words / len(lines))
    return np.concatenate((share, np.minimum(rest, 200.0)))


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of hashed words, their weights of unit length, structure)."""
    text = text or b""
    codes = word_codes(text.lower().split())
    found, counts = np.unique((codes >> np.uint64(40)) & np.uint64(BUCKETS - 1), return_counts=True)
    weight = np.log1p(counts).astype(np.float32)
    if len(weight):
        weight /= np.sqrt((weight * weight).sum())
    return found.astype(np.int32), weight, structure(text, codes, len(found), counts.max(initial=0)).astype(np.float32)


@dataclass
class Machine:
    """Words are features 0..BUCKETS-1, structure statistics follow."""

    mean: np.ndarray
    scale: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray
    constant: float | None = None

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4).astype(np.float32) * np.float32(0.5)

    def row(self, found, weight, stats) -> tuple[np.ndarray, np.ndarray]:
        return (np.concatenate((found, np.arange(BUCKETS, BUCKETS + N_STATS, dtype=np.int32))),
                np.concatenate((weight, self.dense(stats))))

    def margin(self, idx: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[idx] * x[:, None]
        return self.w0 + float(self.w[idx] @ x) + 0.5 * float((vx.sum(0) ** 2).sum() - (vx * vx).sum())

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = np.array([self.margin(*self.row(*features(t))) for t in texts])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], seed: int = 7) -> Machine:
    """Adagrad on the log loss, small batches, weights decay towards 0."""
    labels = {r[0] for r in rows}
    stats = np.array([r[3] for r in rows], np.float32).reshape(len(rows), N_STATS)
    rng = np.random.default_rng(seed)
    size = BUCKETS + N_STATS
    m = Machine(stats.mean(0) if len(rows) else np.zeros(N_STATS), stats.std(0) + 1e-3 if len(rows) else np.ones(N_STATS),
                0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, RANK)).astype(np.float32))
    if len(labels) < 2:
        m.constant = {frozenset(): 0.5, frozenset((0,)): 0.25, frozenset((1,)): 0.75}[frozenset(labels)]
        return m
    y = np.array([r[0] for r in rows], np.float32)
    m.w0 = float(np.log(y.mean() / (1 - y.mean())))
    xs = [m.row(*r[1:]) for r in rows]
    gw, gv, g0 = np.full(size, 1e-2, np.float32), np.full((size, RANK), 1e-2, np.float32), 1e-2
    for epoch in range(EPOCHS):
        rate = 0.15 / (1 + 0.3 * epoch)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 32):
            part = order[at:at + 32]
            idx = np.concatenate([xs[i][0] for i in part])
            x = np.concatenate([xs[i][1] for i in part])
            lens = np.array([len(xs[i][0]) for i in part])
            starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
            doc = np.repeat(np.arange(len(part)), lens)
            vx = m.v[idx] * x[:, None]
            s = np.add.reduceat(vx, starts)
            z = m.w0 + np.add.reduceat(m.w[idx] * x, starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            uniq, back = np.unique(idx, return_inverse=True)
            dw = np.bincount(back, g[doc] * x, len(uniq)).astype(np.float32) + 1e-5 * m.w[uniq]
            per = (g[doc] * x)[:, None] * (s[doc] - vx)
            dv = np.stack([np.bincount(back, per[:, f], len(uniq)) for f in range(RANK)], 1).astype(np.float32) + 1e-5 * m.v[uniq]
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            g0 += float(g.sum()) ** 2
            m.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            m.v[uniq] -= rate * 0.3 * dv / np.sqrt(gv[uniq])
            m.w0 -= rate * float(g.sum()) / np.sqrt(g0)
    return m


@remembering("words")
def _featurise(batches):
    for b in small_batches(batches, 200):
        rows = [features(t) for t in binary_column(b, 2)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), list_array([r[0] for r in rows], pa.int32()),
             list_array([r[1] for r in rows], pa.float32()), list_array([r[2] for r in rows], pa.float32())],
            names=["id", "y", "found", "weight", "stats"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    sample = supervised.training_sample(docs, labels, "quality", FOLDS, FOLD, sample_rows)
    rows = sample.select("id", "y", "text").mapInArrow(
        _featurise, "id long, y int, found array<int>, weight array<float>, stats array<float>").toArrow().sort_by("id")
    return train([(y, np.array(f, np.int32), np.array(w, np.float32), np.array(s, np.float32)) for y, f, w, s in
                  zip(*(rows[c].to_pylist() for c in ("y", "found", "weight", "stats")), strict=True)])


def quality_scores(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # (BUCKETS + stats) x (RANK + 1) floats
    return supervised.scored(docs, lambda: shared.value.scores, FOLDS, FOLD)


def drop_rejected(docs: DataFrame, model: Machine) -> DataFrame:
    """The documents (all columns) that the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    @remembering("words")
    def run(batches):
        for b in small_batches(batches, 200):
            keep = shared.value.scores(binary_column(b, at)) >= 0.5
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
