import random
from collections import defaultdict

from metamart.llm import queries, suffix_dedup as S
from tests.llm.cases import DOCS, edge_rows, with_clashes, words


def windows(rows):
    """50-word window -> its occurrences (doc_id, place), over named rows."""
    docs = {i: words(t) for i, t, *_ in rows if i is not None}
    out = defaultdict(list)
    for i, w in docs.items():
        for p in range(len(w) - S.MATCH + 1):
            out[tuple(w[p:p + S.MATCH])].append((i, p))
    return docs, {k: sorted(v) for k, v in out.items() if len(v) > 1}


def check(rows, got):
    """Every word removed belongs to a passage of MATCH words that occurs earlier;
    every window repeated in a later document is covered, and every such document is found."""
    docs, repeated = windows(rows)
    gone = defaultdict(set)
    for r in got:
        gone[r.doc_id].update(range(r.a, r.z))
    later = defaultdict(set)
    for occ in repeated.values():
        for i, p in occ[1:]:
            later[i].update(range(p, p + S.MATCH))
    for i, g in gone.items():
        assert g <= later[i], (i, sorted(g - later[i])[:5])
    must = {(i, q) for occ in repeated.values() for i, p in occ[1:] if i != occ[0][0] for q in range(p, p + S.MATCH)}
    missed = {(i, q) for i, q in must if q not in gone[i]}
    assert len(missed) <= 0.005 * len(must)        # edges that only a farther suffix shares
    # a document may also repeat a passage of its own, which goes too
    own = {i for i, g in later.items() if g} - {i for i, _ in must}
    found = {i for i, g in gone.items() if g} | {i for i, _ in missed if not gone[i]}
    assert {i for i, _ in must} <= found <= {i for i, _ in must} | own
    assert len({i for i, _ in must if not gone[i]}) <= 0.005 * len({i for i, _ in must})
    return gone


def made(seed, n=150):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    passages = [rnd.choices(vocab, k=k) for k in (50, 51, 60, 75, 120, 300)]
    rows = []
    for i in range(n):
        w = rnd.choices(vocab, k=rnd.randint(0, 150))
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            w += rnd.choice(passages) + rnd.choices(vocab, k=rnd.randint(0, 90))
        if rnd.random() < 0.2:               # parts of a passage
            w += passages[5][rnd.randint(0, 100):rnd.randint(150, 300)]
        rows.append((1000 + rnd.randrange(10**6) * 1000 + i, " ".join(w), "en", "s", 0))
    base = rnd.choices(vocab, k=200)
    for i in range(30):                      # near copies
        w = list(base)
        w[rnd.randrange(200)] = "edit"
        rows.append((20 + i, " ".join(w).upper() if i % 2 else "  ".join(w), "en", "s", 0))
    rows += [(60 + i, rows[0][1] + " " + " ".join(base), "en", "s", 0) for i in range(12)]
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = made(1)
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    small = check(rows, S.matches(docs).collect())
    texts = {r.doc_id: r for r in S.removals(docs).collect()}
    assert texts.keys() == {i for i, g in small.items() if g}
    for i, r in texts.items():
        raw = next(t for d, t, *_ in rows if d == i)
        assert words(r.text) == [w for p, w in enumerate(words(raw)) if p not in small[i]]
        assert r.first_ids and min(r.first_ids) <= i
    # many partitions and rounds find the same repeated windows
    monkeypatch.setattr(S, "ROWS", 30)
    check(rows, S.matches(docs).collect())


def test_edges(spark):
    docs = with_clashes(spark.createDataFrame(edge_rows() + [(50, "same " * 300, None, None, None), (51, None, None, None, None)], DOCS))
    got = S.removals(docs).collect()
    assert {r.doc_id for r in got} <= {8, 9, 50}
    nine = next(r for r in got if r.doc_id == 9)
    assert 8 in nine.first_ids and words(nine.text) == ["tail"]
    assert S.removals(docs.limit(0)).collect() == []


def test_query_finds_every_repeated_passage(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    gone = check(rows, S.matches(spark.read.parquet(f"{d}/documents.parquet")).collect())
    assert {r.doc_id for r in queries.QUERIES["op4_suffix_dedup"](spark, d).collect()} == {i for i, g in gone.items() if g}
