import random
from itertools import combinations

import pytest

from metamart.llm import decontaminate as D, queries
from tests.llm.cases import DOCS, edge_rows, with_clashes, words

BENCH = "item_id long, text string"


def leaks(spark, docs, items, **kw):
    d = with_clashes(spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS))
    b = spark.createDataFrame(items, BENCH)
    return sorted({(r.doc_id, r.item_id) for r in D.overlaps(d, b, **kw).collect()})


def test_substitutions(spark):
    rnd = random.Random(5)
    vocab = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(15, 59)))) for i in range(40)]
    docs, want = [], []
    for n, (i, text) in enumerate(items):
        w = text.split()
        for share in (0, 0.05, 0.1):
            x = list(w)
            for at in rnd.sample(range(len(w)), int(share * len(w))):
                x[at] = "zzz"
            doc = rnd.choices(vocab, k=30) + x + rnd.choices(vocab, k=30)
            want.append((len(docs), i))
            docs.append((len(docs), " ".join(doc).upper()))
        docs.append((len(docs), " ".join(rnd.choices(vocab, k=200))))               # clean
        docs.append((len(docs), " ".join(rnd.choices(vocab, k=40) + w[:8] + rnd.choices(vocab, k=40))))  # eight words only
    assert leaks(spark, docs, items) == sorted(want)
    assert leaks(spark, docs, items, block_words=50) == sorted(want)     # many blocks, same rows


def test_query_holds_every_exact_passage(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, " ".join(words(r.text))) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, " ".join(words(r.text))) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    exact = {(i, k) for i, t in docs for k, x in items if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id): r for r in queries.QUERIES["op9_decontaminate"](spark, d).collect()}
    assert exact and exact <= got.keys()
    assert all(r.similarity >= 0.8 for r in got.values())


def test_edges(spark):
    docs = spark.createDataFrame(edge_rows(), DOCS)
    base = "one two three four five six seven eight nine ten eleven twelve"
    bench = with_clashes(spark.createDataFrame([(1, base), (2, None), (3, ""), (4, "two words"), (None, "nine ten eleven twelve one")], BENCH))
    got = sorted((r.doc_id or -1, r.item_id) for r in D.overlaps(docs, bench).collect())
    assert got == [(-1, 1), (1, 1), (2, 1), (2, 1)]
    assert D.overlaps(docs, bench.limit(0)).collect() == [] == D.overlaps(docs.limit(0), bench).collect()
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 9, 10]
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(edge_rows())


def test_short_items(spark):
    docs = [(1, "a b c d e"), (2, "x a b c d q y"), (3, "a b c"), (4, "p q r s t u v w"), (5, "p q r s zz u v w")]
    assert leaks(spark, docs, [(1, "a b c d e"), (2, "p q r s t u v w")]) == [(1, 1), (2, 1), (4, 2), (5, 2)]


def test_masks_leave_no_accepted_pattern_without_a_seed():
    """The base cases of the module's argument, by enumeration."""
    cases = [(n, 1) for n in range(10, 16)] + [(13, 2), (14, 2), (15, 3), (20, 4)]
    for n, k in cases:
        for subs in combinations(range(n), k):
            assert any(all(a + o not in subs for o in m) for m in D.MASKS for a in range(n - m[-1])), (n, subs)


@pytest.mark.parametrize("n, k", [(5, 1), (8, 1), (10, 2), (12, 2), (13, 2), (15, 3), (16, 3), (20, 4), (37, 7)])
def test_equals_every_alignment(n, k):
    """Each document that the verification accepts along any alignment is found."""
    rnd = random.Random(n)
    item = [f"v{i}" for i in range(n)]
    block = D.Block.build([(1, " ".join(item).encode())])
    table = block.table()
    patterns = list(combinations(range(n), k))
    for subs in patterns if len(patterns) < 700 else rnd.sample(patterns, 700):
        text = [f"z{i}" if i in subs else w for i, w in enumerate(item)]
        for around in ([], ["q"] * 3):
            got = block.overlaps(" ".join(around + text + around).encode(), table)
            assert [o[3] for o in got] == [n - k], (subs, around)
