import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from metamart.llm import quality, queries, toxicity
from tests.llm.cases import DOCS, edge_rows, with_clashes

LABELS = "doc_id long, quality int, toxic int"
OPS = {"op1_toxicity": (toxicity, "toxic", 5, 0, toxicity.toxicity_scores),
       "op5_quality_classifier": (quality, "quality", 3, 1, quality.quality_scores)}


@pytest.mark.parametrize("name", OPS)
def test_held_out_accuracy(spark, name):
    module, label, folds, fold, _ = OPS[name]
    d = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, d).collect()
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    hits = [r.predicted == 1 for r in held if truth[r.doc_id] == 1]
    assert np.mean(hits) > 0.75


@pytest.mark.parametrize("name", OPS)
def test_edges(spark, name):
    module, label, *_, scores = OPS[name]
    docs = with_clashes(spark.createDataFrame(edge_rows(), DOCS))
    labels = with_clashes(spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(1, 10)] + [(None, 1, 1), (1, None, None), (2, 7, 7), (99, 0, 0), (1, 1, 1)], LABELS))
    none = labels.limit(0)
    for lab, want in ((labels, None), (none, 0.5), (labels.filter(f"{label} = 1"), 0.75), (labels.filter(f"{label} = 0"), 0.25)):
        got = scores(docs, module.fit(docs, lab)).collect()
        assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
        if want is not None:
            assert {r.score for r in got} == {want}
    assert scores(docs.limit(0), module.fit(docs.limit(0), labels)).collect() == []


def test_same_model_for_any_order_of_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for module in (quality, toxicity):
        a = module.fit(docs, labels)
        b = module.fit(docs.repartition(5, "text"), labels.orderBy("toxic").withColumnRenamed("x", "y"))
        texts = [r.text.encode() for r in docs.limit(40).collect()]
        assert np.allclose(a.scores(texts), b.scores(texts))


def test_sum_of_squares_identity():
    rnd = np.random.default_rng(1)
    size = quality.BUCKETS + quality.N_STATS
    m = quality.Machine(np.zeros(quality.N_STATS), np.ones(quality.N_STATS), 0.3, rnd.normal(size=size), rnd.normal(size=(size, 5)))
    idx, x = rnd.choice(size, 12, replace=False), rnd.normal(size=12)
    pairs = sum(m.v[idx[i]] @ m.v[idx[j]] * x[i] * x[j] for i in range(12) for j in range(i))
    assert np.isclose(m.margin(idx, x), 0.3 + m.w[idx] @ x + pairs)


def test_gapped_and_inserted_insults():
    rnd = random.Random(4)
    vocab = ["".join(rnd.choices("abdehilnorstu", k=rnd.randint(3, 9))) for _ in range(800)]
    insults = ["idiot", "pathetic", "worthless", "disgusting", "moronic", "stupid"]

    def doc(n, bad=()):
        w = rnd.choices(vocab, k=n)
        for b in bad:
            w.insert(rnd.randrange(len(w)), b)
        return [" ".join(w[i:i + 9]) + "." for i in range(0, len(w), 9)]

    model = toxicity.train([(1, doc(60, rnd.sample(insults, 2))) for _ in range(80)] + [(0, doc(60)) for _ in range(300)])
    clean = model.scores([" ".join(doc(80)).encode() for _ in range(200)])
    assert (clean < 0.5).mean() > 0.98
    for said in ("IDIOT, IDIOT", "i.d.i.o.t i-d-i-o-t", "p a t h e t i c and w o r t h l e s s", "path3tic w0rthless", "worthxless patheqtic",
                 "disg*usting stu_pid", "wörthless päthetic"):
        texts = [" ".join(doc(40, [said])).encode() for _ in range(20)]
        assert (model.scores(texts) >= 0.5).mean() >= 0.9, said


def test_two_and_three_inserted_letters():
    """Invented words and insults; documents with two insults, as in training."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choices("abdehilnorstu", k=rnd.randint(3, 9))) for _ in range(800)]
    insults = ["idiot", "pathetic", "worthless", "disgusting", "moronic", "stupid"]

    def doc(n, bad=()):
        w = rnd.choices(vocab, k=n)
        for b in bad:
            w.insert(rnd.randrange(len(w)), b)
        return [" ".join(w[i:i + 9]) + "." for i in range(0, len(w), 9)]

    def spoilt(w, k):
        at = rnd.randrange(1, len(w))
        return w[:at] + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=k)) + w[at:]

    model = toxicity.train([(1, doc(60, rnd.sample(insults, 2))) for _ in range(80)] + [(0, doc(60)) for _ in range(300)])
    assert (model.scores([" ".join(doc(80)).encode() for _ in range(300)]) < 0.5).mean() > 0.98
    for k in (0, 1, 2, 3):
        texts = [" ".join(doc(40, [spoilt(w, k) for w in rnd.sample(insults, 2)])).encode() for _ in range(120)]
        assert (model.scores(texts) >= 0.5).mean() >= 0.9, k


def test_kernel_by_its_definition():
    """The gap-weighted kernel over all choices of four positions."""
    rnd = random.Random(2)

    def image(w):
        out = defaultdict(float)
        for at in combinations(range(len(w)), 4):
            skips = [b - a - 1 for a, b in zip(at, at[1:])]
            if max(skips) <= 1 or (sorted(skips)[1] == 0 and max(skips) <= 3):
                out[tuple(w[i] for i in at)] += 0.6 ** (at[3] - at[0])
        return out

    def norm(n):
        return sum(v * v for v in image(tuple(range(n))).values()) ** 0.5

    words = ["\x1e" + "".join(chr(rnd.randint(1, 4)) for _ in range(rnd.randint(3, 12))) + "\x1f" for _ in range(12)]
    words.append("\x1e" + "\x01\x02\x03" * 30 + "\x1f")
    got = toxicity.Landmarks(words[:5] + words[-1:]).kernel(words)
    images, lengths = [image(w) for w in words], {n: norm(n) for n in {len(w) for w in words if len(w) < 30}}
    lengths[92] = float(toxicity.norms(92))
    assert np.allclose([toxicity.norms(n) for n in lengths], list(lengths.values()))
    for i, a in enumerate(words):
        for j, b in enumerate((*range(5), len(words) - 1)):
            want = sum(v * images[b][u] for u, v in images[i].items()) / lengths[len(a)] / lengths[len(words[b])]
            assert np.isclose(got[i, j], want, rtol=1e-3, atol=1e-4)


def test_long_sentences_are_cut_not_dropped():
    import pyarrow as pa
    text = " ".join(f"w{i}" for i in range(4000)) + " " + "x" * 2000 + "y" * 3000
    batch = pa.RecordBatch.from_pydict({"id": [1], "y": [1], "text": [text]})
    (out,) = toxicity._sentences(iter([batch]))
    parts = out.column(2).to_pylist()[0]
    assert sorted(" ".join(parts).split()) == sorted([*text.split()[:-1], "x" * 2000, "y" * 2000, "y" * 1000])
    assert max(map(len, parts)) <= toxicity.PIECE


def test_table_equals_the_kernel():
    """Folding landmarks into a table gives K_mm^(-1/2) k(landmarks, word) u."""
    fold = lambda w: "\x1e" + "".join(chr(ord(c) - 96) for c in w) + "\x1f"
    space = toxicity.Landmarks([fold(w) for w in ("idiot", "hello", "world")])
    u = np.array([0.7, -0.2, 0.4])
    words = [fold(w) for w in ("idixot", "helpo", "idiot")]
    got = toxicity.word_margins(*toxicity._stream(words), 3, space.table(u))
    assert np.allclose(got, space.features(words) @ u, atol=1e-4)
