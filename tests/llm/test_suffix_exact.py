"""op4 finds every repeated passage, also between many that share one side only."""

import random
from collections import defaultdict

import pytest

from metamart.llm import suffix_dedup as S
from tests.llm.cases import DOCS, words
from tests.llm.test_suffix_dedup import made, windows


def halves():
    """Passages of 50 words, each twice, between documents that quote their parts
    on either side of a place."""
    rnd = random.Random(8)
    fresh = lambda n: [f"w{rnd.randrange(10**7)}" for _ in range(n)]
    texts = []
    for _ in range(20):
        p = fresh(S.MATCH)
        for cut in range(12, 39):
            texts += [fresh(30) + p[max(0, cut - 12):] + fresh(40), fresh(40) + p[:cut + 12] + fresh(30)] * 1
        texts += [fresh(40) + p + fresh(40), fresh(40) + p + fresh(40)]
    rnd.shuffle(texts)
    return [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rows", [made(5, 400), halves()], ids=["parts", "halves"])
@pytest.mark.parametrize("near,size", [(S.NEAR, S.ROWS), (S.NEAR, 50), (1, 50)])
def test_no_repeated_window_is_missed(spark, monkeypatch, rows, near, size):
    monkeypatch.setattr(S, "NEAR", near)
    monkeypatch.setattr(S, "ROWS", size)
    docs, repeated = windows(rows)
    gone = defaultdict(set)
    for r in S.matches(spark.createDataFrame(rows, DOCS)).collect():
        gone[r.doc_id].update(range(r.a, r.z))
    may, must = defaultdict(set), defaultdict(set)
    for occ in repeated.values():
        for i, p in occ[1:]:
            may[i].update(range(p, p + S.MATCH))
            if i != occ[0][0]:
                must[i].update(range(p, p + S.MATCH))
    assert must and sum(len(m - gone[i]) for i, m in must.items()) == 0
    assert all(g <= may[i] for i, g in gone.items())


def test_the_first_place_in_a_document_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(S, "NEAR", 1)
    rnd = random.Random(3)
    p = [f"w{rnd.randrange(10**7)}" for _ in range(60)]
    text = " ".join(p * 5)
    got = S.removals(spark.createDataFrame([(1, text, "en", "s", 0)], DOCS)).collect()
    assert [words(r.text)[:60] for r in got] == [p] and len(words(got[0].text)) < 300
