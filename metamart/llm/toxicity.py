"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks (op1).

Kernel.  Two words are compared by the subsequences of four characters they
share.  Up to ``SKIPPED`` characters may be skipped, at one place of the subsequence
or one at each of its places; each step of length s weighs DECAY ** s, and the value is divided by the norms
of words of these lengths.  So inserted characters ("idxiot") and gaps cost a
little similarity, not all.  Before, characters are folded: case and accents
go, digits stand for the letters they look like, punctuation inside a word goes
("i-d.i*ot"), and letters written apart ("i d i o t") are one word.  A sentence
is compared by its best word, as one insult makes it toxic.

Training.  The sample is bounded: ``CLASS_ROWS`` labelled documents of each
class, ``SENTENCES`` sentences of each (in the order of hashes; sentences of more than
``PIECE`` characters are several).  Landmarks are
words of the sample, those most typical of labelled-toxic sentences and common
others.  Nystroem features of a word are K_mm^(-1/2) k(landmarks, word).  A linear
SVM (squared hinge) is trained on the words of the sentences: those of clean
documents are negative (``CLEAN_WORDS`` in the order of a hash, and all that looked toxic in
a round); positive are words that ``TYPICAL`` times more toxic than clean documents have, and
from the first of ``ROUNDS`` rounds on all such words that score high, each also
with one to ``SKIPPED`` characters inserted at every place.  A logistic scale of the margins of a document's best
two words, fitted on the sampled documents, gives the score.

Scoring.  The margin of a word is linear in its subsequences, so landmarks and
weights fold into one table over the subsequences: a text costs a
lookup per character and gap, whatever the number of landmarks.  Whole texts
are scored in Arrow batches, without a shuffle; inputs are texts alone.

Defined results: null and empty texts score as a text without words (below
0.5); without both classes in the sample all scores are 0.25, 0.5 or 0.75.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm import supervised
from metamart.llm.common import small_batches

FOLDS, FOLD = 5, 0
CLASS_ROWS = 2500
SENTENCES = 60
CLEAN_WORDS = 15_000
LANDMARKS = 256
PIECE = 2000
SKIPPED = 3
DECAY = 0.6
ROUNDS = 3
TYPICAL = 8                      # times as frequent in toxic documents
CLEAN_WEIGHT = 20.0
PLAIN = 0.5                      # weight of insults as written, among the positive words
CHARS = 32                       # classes of characters; 0: none, 1 to 26: letters, 27 to 29: others
BEGIN, END = 30, 31              # of a word
LENGTH = 4                       # characters of a subsequence
SPACE = 255
LOWEST = 2.0

# digits that stand for letters (fixed values of the folding)
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
STEPS = [steps for steps in product(range(1, SKIPPED + 2), repeat=LENGTH - 1)
         if sum(steps) - len(steps) <= SKIPPED and (max(steps) <= 2 or sum(s > 1 for s in steps) == 1)]
TABLE = 0x3000


def _fold(cp: int) -> int:
    ch = chr(cp)
    if ch.isspace():
        return SPACE
    base = unicodedata.normalize("NFKD", ch)[:1].lower()
    base = LOOKALIKES.get(base, base)
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + cp % 3 if ch.isalnum() else 0


_CLASS = np.array([_fold(c) for c in range(TABLE)], np.uint8)


def classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = _CLASS[np.minimum(cp, TABLE - 1)]
    far = cp >= TABLE
    if far.any():
        out[far] = 27 + cp[far] % 3
    return out


def word_stream(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(character classes with marks, word number of each, number of words).
    Letters apart join within a sentence only, which a line break or . ! ? ends."""
    raw = classes(text)
    n = len(raw)
    space = raw == SPACE
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, np.uint8), np.empty(0, np.int64), 0
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    stop = np.isin(cp[end - 1], (0x2E, 0x21, 0x3F)) | np.isin(cp[np.minimum(end, n - 1)], (0x0A, 0x0D))
    single = np.bincount(np.repeat(np.arange(len(start)), end - start), (raw[~space] > 0), len(start)) == 1
    joined = np.concatenate(([False], single[1:] & single[:-1] & ~stop[:-1]))
    number = np.cumsum(~joined) - 1                       # word number of each piece
    words = int(number[-1]) + 1
    word = np.repeat(number, end - start)
    chars = raw[~space]
    keep = chars > 0
    chars, word = chars[keep], word[keep]
    # a mark before and after every word
    size = np.bincount(word, minlength=words) + 2
    out = np.empty(int(size.sum()), np.uint8)
    last = np.cumsum(size) - 1
    out[last - size + 1] = BEGIN
    out[last] = END
    out[np.arange(len(chars)) + 2 * word + 1] = chars
    return out, np.repeat(np.arange(words), size), words


def norms(size) -> np.ndarray:
    """Norms of words by their lengths (subsequences taken as distinct)."""
    n = np.asarray(size)
    total = sum(DECAY ** (2 * span) * times * np.maximum(n - span, 0) for span, times in Counter(map(sum, STEPS)).items())
    return np.sqrt(np.maximum(total, 1e-12))


def _codes(c: np.ndarray, m: int, places: tuple[int, ...]) -> np.ndarray:
    """Number of the subsequence that begins at each of the first m positions."""
    code = c[:m]
    for o in places:
        code = code * CHARS + c[o:m + o]
    return code


def subsequences(chars: np.ndarray):
    """(number, weight) of the subsequences of one word, for each choice of steps."""
    c = chars.astype(np.int32)
    for steps in STEPS:
        if (m := len(c) - sum(steps)) > 0:
            yield _codes(c, m, tuple(accumulate(steps))), DECAY ** sum(steps)


def word_margins(chars: np.ndarray, word: np.ndarray, words: int, table: np.ndarray) -> np.ndarray:
    """Margins (less the bias) of all words of a text at once."""
    total = np.zeros(len(chars), np.float32)
    c = chars.astype(np.int32)
    for steps in STEPS:
        span = sum(steps)
        if (m := len(c) - span) > 0:
            value = table[_codes(c, m, tuple(accumulate(steps)))]
            value *= word[span:] == word[:m]
            value *= np.float32(DECAY ** span)
            total[:m] += value
    size = np.bincount(word, minlength=words)
    return np.bincount(word, total, words) / norms(size)


@dataclass
class Model:
    table: np.ndarray
    bias: float
    scale: np.ndarray            # of the best and second best word's margins, and a constant
    constant: float | None = None

    def margins(self, text: str | None) -> tuple[float, float]:
        """Margins of the best two words, from -LOWEST to LOWEST."""
        chars, word, words = word_stream(text or "")
        if not words:
            return -LOWEST, -LOWEST
        g = np.append(word_margins(chars, word, words, self.table) + self.bias, -LOWEST)
        two = np.clip(np.partition(g, len(g) - 2)[-2:], -LOWEST, LOWEST)
        return float(two[1]), float(two[0])

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        m = np.array([self.margins(None if t is None else t.decode("utf-8", "replace")) for t in texts]).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(m @ self.scale[:2] + self.scale[2], -30, 30)))


# ---------------------------------------------------------------- training
_CUT = re.compile(r"(?<=[.!?])\s+|[\r\n]+")
_PIECES = re.compile(rf"\S.{{0,{PIECE - 2}}}(?!\S)|\S{{1,{PIECE}}}", re.S)


def _sentences(batches):
    for b in small_batches(batches, 200):
        out = []
        for text in b.column(2).to_pylist():
            parts = {p for s in _CUT.split(text or "") for p in (_PIECES.findall(s) if len(s) > PIECE else [s]) if p.strip()}
            out.append(sorted(parts, key=lambda s: (xxhash.xxh3_64_intdigest(s), s))[:SENTENCES])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.string()))], names=["id", "y", "sentences"])


def fit(docs: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS) -> Model:
    rows = []
    for y in (0, 1):
        part = labels.filter(F.col("toxic").cast("int") == y)
        sample = supervised.training_sample(docs, part, "toxic", FOLDS, FOLD, class_rows)
        got = sample.mapInArrow(_sentences, "id long, y int, sentences array<string>").toArrow().sort_by("id")
        rows += list(zip(got["y"].to_pylist(), got["sentences"].to_pylist(), strict=True))
    return train(rows)


def _stream(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, word number of each) of folded words."""
    chars = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return chars, np.repeat(np.arange(len(words)), [len(w) for w in words])


def _spelt(text: str) -> list[str]:
    """The folded words of a text, with their marks."""
    chars, word, n = word_stream(text)
    cuts = np.searchsorted(word, np.arange(n + 1)).tolist()
    raw = chars.tobytes().decode("latin-1")
    return [raw[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


class Landmarks:
    """Landmark words in the space of subsequences, and the Nystroem map."""

    def __init__(self, marks: list[str]):
        self.where = np.full(CHARS ** LENGTH, -1, np.int32)
        codes = [[(c, w) for c, w in subsequences(np.frombuffer(m.encode("latin-1"), np.uint8))] for m in marks]
        used = np.unique(np.concatenate([np.empty(0, np.int32), *[c for x in codes for c, _ in x]]))
        self.where[used] = np.arange(len(used))
        self.used = used
        self.matrix = np.zeros((len(used), len(marks)), np.float32)
        for j, (m, x) in enumerate(zip(marks, codes, strict=True)):
            for c, w in x:
                np.add.at(self.matrix[:, j], self.where[c], w)
            self.matrix[:, j] /= norms(len(m))
        k = self.kernel(marks).astype(np.float64)
        vals, vecs = np.linalg.eigh((k + k.T) / 2)
        self.root = (vecs / np.sqrt(np.maximum(vals, 1e-3 * max(vals.max(), 1e-9)))) @ vecs.T     # K_mm^(-1/2)

    def kernel(self, words: list[str]) -> np.ndarray:
        """k(word, landmark); words in slices, to bound memory."""
        out = np.zeros((len(words), self.matrix.shape[1]), np.float32)
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            chars, word = _stream(part)
            c = chars.astype(np.int32)
            for steps in STEPS:
                span = sum(steps)
                if (m := len(c) - span) <= 0:
                    continue
                row = self.where[_codes(c, m, tuple(accumulate(steps)))]
                ok = np.flatnonzero((row >= 0) & (word[span:] == word[:m]))
                if len(ok):
                    first = np.flatnonzero(np.diff(word[ok], prepend=-1))
                    out[at + word[ok[first]]] += np.add.reduceat(self.matrix[row[ok]], first) * np.float32(DECAY ** span)
            out[at:at + len(part)] /= norms([len(w) for w in part])[:, None]
        return out

    def features(self, words: list[str]) -> np.ndarray:
        return self.kernel(words) @ self.root.astype(np.float32)

    def table(self, u: np.ndarray) -> np.ndarray:
        """Weight of every subsequence: margins are linear in them."""
        t = np.zeros(CHARS ** LENGTH, np.float32)
        t[self.used] = self.matrix @ (self.root @ u)
        return t


def train(rows: list[tuple[int, list[str]]]) -> Model:
    """rows: (label, sentences) of documents."""
    kinds = {y for y, _ in rows}
    if len(kinds) < 2:
        constant = {frozenset(): 0.5, frozenset((0,)): 0.25, frozenset((1,)): 0.75}[frozenset(kinds)]
        return Model(np.zeros(CHARS ** LENGTH, np.float32), 0.0, np.zeros(3), constant)
    # distinct folded words of toxic documents; of clean ones only their counts
    df: list[Counter[str]] = [Counter(), Counter()]
    toxic: list[list[str]] = []
    seen: set[int] = set()
    for y, texts in rows:
        keys = [xxhash.xxh3_64_intdigest(t, seed=y) for t in texts]
        own = sorted(set(_spelt("\n".join(t for t, k in zip(texts, keys, strict=True) if k not in seen))))
        seen.update(keys)                             # copies of a document teach nothing new
        own = [w for w in own if len(w) > LENGTH]
        df[y].update(own)
        if y == 1 and own:
            toxic.append(own)
    n0, n1 = (max(1, sum(y == k for y, _ in rows)) for k in (0, 1))
    least = min(max(3, n1 // 100), max(df[1].values(), default=1))

    def typical(w: str, n: int) -> bool:
        return n >= least and n / n1 >= TYPICAL * (df[0][w] + 0.2) / n0

    maybe = {w for w, n in df[1].items() if typical(w, n)}
    after = {(w, before) for y, texts in rows if y == 1 for spelt in [_spelt("\n".join(texts))]
             for before, w in zip(spelt[:-1], spelt[1:], strict=True) if w in maybe}
    places = Counter(w for w, _ in after)             # near copies repeat a word in one place only
    seeds = {w for w in maybe if typical(w, min(df[1][w], places[w]))}
    by_hash = sorted(df[0].keys() - seeds, key=lambda w: (xxhash.xxh3_64_intdigest(w.encode()), w))
    marks = sorted(seeds, key=lambda w: (-df[1][w], w))[:LANDMARKS * 3 // 4]
    marks += sorted(df[0].keys() - seeds, key=lambda w: (-df[0][w], w))[:LANDMARKS - len(marks)]
    if not marks:
        return Model(np.zeros(CHARS ** LENGTH, np.float32), -1.0, np.zeros(3), n1 / (n0 + n1))
    space = Landmarks(marks)
    everyday = list(dict.fromkeys(by_hash[:CLEAN_WORDS]))
    hard: set[str] = set()
    positive = sorted(seeds)
    clean_x = space.features(everyday)
    u, bias = np.zeros(len(marks)), -1.0
    for _ in range(ROUNDS):
        if not positive:
            break
        extra = sorted(hard - set(everyday))
        spoilt = [w[:at] + "".join(chr(1 + (at * 7 + len(w) + 5 * i) % 26) for i in range(k)) + w[at:]
                  for w in positive for k in range(1, SKIPPED + 1) for at in range(2, len(w) - 1)]
        n = len(positive) + len(spoilt)
        x = np.concatenate((space.features(positive), space.features(spoilt), clean_x, space.features(extra)))
        y = np.concatenate((np.ones(n), -np.ones(len(everyday) + len(extra))))
        c = np.where(y > 0, (1 - PLAIN) / max(1, len(spoilt)), CLEAN_WEIGHT / max(1, len(everyday) + len(extra)))
        c[:len(positive)] = PLAIN / len(positive)
        c[n + len(everyday):] = 1 / n                                 # clean words that looked toxic
        u, bias = _svm(x, y, c)
        table = space.table(u)
        found = set(seeds)
        for ws in toxic:                         # of toxic sentences the best words
            f = word_margins(*_stream(ws), len(ws), table) + bias
            found.update(ws[i] for i in np.flatnonzero(f > 0.3).tolist() if ws[i] not in df[0])
        positive = sorted(found)
        for at in range(0, len(by_hash), 50_000):
            part = by_hash[at:at + 50_000]
            f = word_margins(*_stream(part), len(part), table) + bias
            hard.update(part[i] for i in np.flatnonzero(f > -0.3).tolist())
    model = Model(space.table(u), float(bias), np.zeros(3))
    best = np.array([model.margins("\n".join(texts)) for _, texts in rows])
    model.scale = _scale(best, np.array([y for y, _ in rows]))
    return model


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, ridge: float = 2e-5, steps: int = 25) -> tuple[np.ndarray, float]:
    """Squared hinge with weights c, by Newton steps (m + 1 unknowns)."""
    z = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    reg = np.full(len(w), ridge)
    reg[-1] = 1e-9

    def loss(w):
        gap = np.maximum(0, 1 - y * (z @ w))
        return (c * gap * gap).sum() + (reg * w * w).sum()

    for _ in range(steps):
        act = y * (z @ w) < 1
        za, ca = z[act], c[act]
        grad = -2 * za.T @ (ca * (y[act] - za @ w)) + 2 * reg * w
        step = np.linalg.solve(2 * (za * ca[:, None]).T @ za + 2 * np.diag(reg), grad)
        t, now = 1.0, loss(w)
        while loss(w - t * step) > now and t > 1e-4:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def _scale(margins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on the two margins, by Newton steps."""
    z = np.column_stack((margins, np.ones(len(margins))))
    w, ridge = np.zeros(z.shape[1]), np.array([1e-3, 1e-3, 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(ridge)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return w


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # CHARS ** LENGTH floats
    return supervised.scored(docs, lambda: shared.value.scores, FOLDS, FOLD)
