import random

import pytest

from metamart.llm import minhash_dedup as M
from tests.llm.cases import DOCS, edge_rows, least_reachable, with_clashes, words


def brute(rows):
    """doc_id -> (set size, smallest reachable doc_id), by all pairs."""
    sets = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        sets[doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(i for i in sets if i is not None)
    links = [(a, b) for a in ids for b in ids
             if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = least_reachable(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


def variants(rnd, n_groups=12, size=14):
    """Groups of edited copies at every distance around the threshold, plus a
    passage shared by many otherwise different documents."""
    vocab = [f"t{i}" for i in range(4000)]
    passage = rnd.choices(vocab, k=40)
    rows, i = [], 100
    for g in range(n_groups):
        base = rnd.choices(vocab, k=rnd.choice([7, 30, 60, 200, 400]))
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                w = w[:-rnd.randint(1, max(1, len(w) // 8))]
            rows.append((i, " ".join(w), "en", "s", 0))
            i += rnd.randint(1, 3)
    for _ in range(60):
        rows.append((i, " ".join(passage + rnd.choices(vocab, k=rnd.randint(4, 30))), "en", "s", 0))
        i += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = variants(random.Random(seed)) + [r for r in edge_rows() if r[0] is not None]
    got = M.near_duplicates(with_clashes(spark.createDataFrame(rows, DOCS))).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def test_edges_and_empty(spark):
    got = M.near_duplicates(spark.createDataFrame(edge_rows(), DOCS)).collect()
    null = [r for r in got if r.doc_id is None]
    assert len(null) == 1 and null[0].kept and null[0].component_id is None and null[0].n_shingles == 8
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and not by[2].kept and by[1].n_copies == 2
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[3].kept and by[5].kept
    assert by[7].component_id == 6 and by[9].component_id == 8
    assert M.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_drop_keeps_one_of_each_group(spark):
    docs = with_clashes(spark.createDataFrame(edge_rows(), DOCS))
    out = M.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in out.collect()) == [-1, 1, 3, 4, 5, 6, 8, 10]
    assert M.drop_near_duplicates(docs.limit(0)).count() == 0
