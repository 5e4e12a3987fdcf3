import hashlib
import random
from collections import defaultdict
from fractions import Fraction
from math import ceil, floor

import pytest

from metamart.llm import mixing as M, queries
from tests.llm.cases import DOCS, edge_rows, with_clashes


def brute(rows, weights=None, block=M.BLOCK_DOCS):
    """The scheduler run slot by slot over the whole table, in fractions."""
    docs = {}
    for i, _, _, source, _ in rows:
        if i is not None:
            docs[i] = min(docs.get(i, (source is not None, source)), (source is not None, source), key=lambda k: (k[0], k[1] or ""))
    by = defaultdict(list)
    for i, s in docs.items():
        by[s].append(i)
    names = sorted(by, key=lambda k: (k[0], (k[1] or "").encode()))
    most = max([weights.get(s[1], 0) for s in names] + [0]) if weights else 0
    w = {s: round(len(by[s]) ** 0.5 * 1e6) if weights is None else max(1, round(weights.get(s[1], 0) / (most or 1) * 1e12)) for s in names}
    for s in names:
        by[s].sort(key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    blocks = {s: [by[s][a:a + block] for a in range(0, len(by[s]), block)] for s in names}
    size = {s: len(blocks[s]) for s in names}

    def slot(v):                          # of virtual time v in the ideal mix
        return sum(min(w[s] * v, size[s]) for s in names)

    ends = sorted({Fraction(0)} | {Fraction(size[s], w[s]) for s in names})
    at = [slot(v) for v in ends]

    def time(t):                          # virtual time of a slot
        i = max(i for i, x in enumerate(at) if x <= t)
        return ends[i] if i + 1 == len(at) else ends[i] + (t - at[i]) / sum(w[s] for s in names if size[s] > w[s] * ends[i])

    windows = {s: [(floor(slot(Fraction(j, w[s]))), ceil(slot(Fraction(j + 1, w[s])))) for j in range(size[s])] for s in names}
    out, taken = {}, dict.fromkeys(names, 0)
    for t in range(sum(size.values())):
        due, s = min((windows[s][taken[s]][1], n) for n, s in enumerate(names)
                     if taken[s] < size[s] and windows[s][taken[s]][0] <= t)
        s = names[s]
        assert t < due
        for j, i in enumerate(blocks[s][taken[s]]):
            out[i] = (s[1], t, *windows[s][taken[s]], t * block + j)
        taken[s] += 1
        v = time(t + 1)
        for x in names:     # less than one block from the share by the given weights
            assert abs(taken[x] - min(w[x] * v, size[x])) < 1
    return out


def table(df):
    return {r.doc_id: (r.source, r.slot, r.release, r.deadline, r.position) for r in df.collect()}


@pytest.mark.parametrize("weights", [None, {"a": 0.5, "b": 0.3, "c": 0.2, "d": 0}, {"a": 0.6995, "b": 0.0005, "c": 0.3, "d": 1e-9}])
def test_equals_slot_by_slot(spark, weights, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_ROWS", 40)
    monkeypatch.setattr(M.schedules, "__defaults__", (M.SEGMENT, 3))     # several groups of segments
    rows = [(i * 7, "t", "en", "aaaaaabbbcd"[i % 11] if i % 13 else None, 1) for i in range(1500)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    w = weights and spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double")
    got = table(M.schedule(docs, w, block_docs=4, segment=20))
    assert got == brute(rows, weights, 4)
    assert sorted(v[1] for v in got.values())[0] == 0
    order = [r.doc_id for f in sorted(M.mixed(docs, w, 4, 20).rdd.glom().collect(), key=lambda p: 0) for r in f]
    assert order == sorted(got, key=lambda i: got[i][4])


def test_random_sources(spark):
    """Sources of very unequal sizes and weights, segments shorter than most windows."""
    rng = random.Random(5)
    for _ in range(3):
        names = [f"s{k}" for k in range(rng.randrange(2, 9))]
        weights = {k: rng.random() ** 6 + 1e-4 for k in names}
        size = {k: rng.choice([1, 7, 40, 300]) for k in names}
        kinds = [k for k in names for _ in range(size[k])]
        rows = [(i, "t", "en", k, 1) for i, k in enumerate(kinds)]
        w = spark.createDataFrame(list(weights.items()), "source string, weight double")
        assert table(M.schedule(spark.createDataFrame(rows, DOCS), w, block_docs=1, segment=5)) == brute(rows, weights, 1)


def test_weights_without_a_number(spark):
    rows = [(i, "t", "en", "abcd"[i % 4], 1) for i in range(200)]
    w = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("nan")), ("d", -1.0), ("x", 5.0)], "source string, weight double")
    got = table(M.schedule(spark.createDataFrame(rows, DOCS), w, block_docs=2))
    assert got == brute(rows, {"a": 1.0}, 2)
    assert table(M.schedule(spark.createDataFrame(rows, DOCS), w.limit(0), block_docs=2)) == brute(rows, {}, 2)


def test_thousand_sources(spark):
    """The schedule grows with slots x sources, not with the cube of the sources."""
    sources = spark.range(1000).selectExpr("concat('=', lpad(id, 4, '0')) AS src", "cast(id AS int) AS s", "id AS docs",
                                           "1 + id % 3 AS blocks", "cast(1 + id * id AS decimal(18,0)) AS w")
    plan = M.schedules(spark, sources).collect()
    assert sorted(r.slot for r in plan) == list(range(1999)) and all(r.release <= r.slot < r.deadline for r in plan)


def test_edges(spark):
    docs = with_clashes(spark.createDataFrame(edge_rows(), DOCS))
    assert table(M.schedule(docs)) == brute(edge_rows())
    out = M.mixed(docs)
    assert out.columns == docs.columns and out.count() == len(edge_rows())
    assert M.schedule(docs.limit(0)).collect() == [] == M.mixed(docs.limit(0)).collect()


def test_query_equals_slot_by_slot(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert table(queries.QUERIES["op3_mix_sources"](spark, d)) == brute(rows)
