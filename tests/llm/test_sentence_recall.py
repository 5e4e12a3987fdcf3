"""op8 against every passage of 50 words that occurs again, however it is cut."""

import random
import re
from collections import defaultdict

import numpy as np

from metamart.llm import sentence_dedup
from tests.llm.cases import DOCS, words

MATCH = 50


def missed_passages(rows, removed):
    """Windows of MATCH words in a later document of which nothing was removed."""
    places = defaultdict(list)
    docs = {i: words(t) for i, t, *_ in rows if i is not None}
    for i in sorted(docs):
        for p in range(len(docs[i]) - MATCH + 1):
            places[tuple(docs[i][p:p + MATCH])].append((i, p))
    texts = {i: t for i, t, *_ in rows}
    gone = {}
    for i, spans in removed.items():
        raw = texts[i].encode()
        at = [len(raw[:a].split()) for x in spans for a in x]
        gone[i] = np.zeros(len(docs[i]) + 1, int)
        for a, z in zip(at[::2], at[1::2]):
            gone[i][a:z] = 1
    again = [(i, p) for occ in places.values() for i, p in occ if i != occ[0][0]]
    return again, [(i, p) for i, p in again if i not in gone or not gone[i][p:p + MATCH].any()]


def made(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(5000)]

    def prose(n):
        """n words with sentences of any length, also without ends."""
        out = rnd.choices(vocab, k=n)
        least = rnd.choice([1, 5, 9, 15, 17, 30, 1000])
        at = 0
        while (at := at + rnd.randint(least, least + 4)) < n:
            out[at] += rnd.choice([".", "?"])
        return " ".join(out)

    passages = [prose(MATCH) for _ in range(150)]
    return [(2 * k + c, " ".join((prose(rnd.randint(0, 40)), p, prose(rnd.randint(0, 40)))).strip(), "en", "s", 0)
            for k, p in enumerate(passages) for c in range(2)]


def removed(df):
    return {r.doc_id: list(zip(r.starts, r.ends)) for r in sentence_dedup.removals(df).collect()}


def test_repeated_passages_are_found_wherever_they_begin(spark):
    # passages of exactly 50 words that begin and end inside sentences of any length
    rows = made(2)
    again, missed = missed_passages(rows, removed(spark.createDataFrame(rows, DOCS)))
    # an adverse table: most of these passages hold fewer than two whole sentences (see the README)
    assert len(again) >= 150 and len(missed) <= 0.25 * len(again)


def test_repeated_passages_of_the_table_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    again, missed = missed_passages([tuple(r) for r in docs.collect()], removed(docs))
    assert len(missed) <= 0.005 * len(again)
    assert {i for i, _ in again} == {i for i, p in set(again) - set(missed)}


def test_what_is_removed_begins_and_ends_at_sentence_ends(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    end = re.compile(rb"(?:[.!?]+[\"')\]]*\s|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f|\n)\s*$")
    edges = inside = 0
    for i, spans in removed(docs).items():
        for a, z in spans:
            for at in (a, z):
                edges += 1
                if 0 < at < len(texts[i]) and not end.search(texts[i][:at]):
                    # only in a sentence of more than WHOLE words
                    before = re.split(rb"[.!?]+[\"')\]]*\s+|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f|\n", texts[i][:at])[-1]
                    after = re.split(rb"[.!?]+[\"')\]]*\s+|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f|\n", texts[i][at:])[0]
                    assert len(before.split()) + len(after.split()) > sentence_dedup.WHOLE
                    inside += 1
    assert edges > 10 * inside or inside < 0.3 * edges


def test_short_last_sentences_of_a_passage_go_too(spark):
    rnd = random.Random(4)
    fresh = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n)) + ". "
    passage = fresh(7) + fresh(6) + fresh(8) + fresh(7) + fresh(2) + fresh(1)
    rows = [(i, fresh(8) + passage + fresh(8) + fresh(7), "en", "s", 0) for i in (1, 2)]
    got = sentence_dedup.removals(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r.doc_id, r.text) for r in got] == [(2, rows[1][1].replace(passage, ""))]
