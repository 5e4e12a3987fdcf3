import random
import re
from collections import defaultdict
from itertools import islice

import pytest

from metamart.llm import line_dedup, queries, sentence_dedup
from metamart.llm.common import mix64, word_codes
from tests.llm.cases import DOCS, edge_rows, with_clashes


def line_units(text):
    out, at = [], 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            out.append((at, min(at + len(line) + 1, len(text)), line.strip(" \t\r\x0b\x0c"), 1))
        at += len(line) + 1
    return out


def sentence_units(text):
    cuts = [0, *(m.end() for m in re.finditer(r"[.!?]+[\"')\]]*[ \t-\r]+|[。！？][ \t-\r]*|\n[ \t-\r]*", text)), len(text)]
    out = []
    for a, z in zip(cuts, cuts[1:]):
        ws = list(re.finditer(r"[^ \t-\r]+", text[a:z]))
        plain = [re.sub("[A-Z]", lambda m: m.group().lower(), w.group()) for w in ws]
        at = [0] if ws else []
        if len(ws) > 32:                # long sentences alone: before the least hash of any 16 words in a row
            h = [mix64(word_codes([w.encode()]))[0] for w in plain]
            rows = [range(i, i + 16) for i in range(len(ws) - 15)]
            at = sorted({0, *(i for r in rows for i in r if h[i] == min(h[k] for k in r))})
        for i, j in zip(at, [*at[1:], len(ws)]):
            out.append((a if i == 0 else a + ws[i].start(), z if j == len(ws) else a + ws[j].start(), " ".join(plain[i:j]), j - i))
    return out


def runs(units, least, words):
    """The shortest sufficient runs that begin and, by words, that end at every unit."""
    spans = set()
    for i in range(len(units)):
        ahead = ((i, j) for j in range(i + least, len(units) + 1) if sum(u[3] for u in units[i:j]) >= words)
        spans |= set(islice(ahead, 1))
        if words:
            back = ((j, i + 1) for j in range(i + 1 - least, -1, -1) if sum(u[3] for u in units[j:i + 1]) >= words)
            spans |= set(islice(back, 1))
    for i, j in sorted(spans):
        yield i, j, tuple(u[2] for u in units[i:j])


def brute(rows, cut, least, words):
    """doc_id -> (text that stays, first ids), over distinct named rows."""
    docs = {i: t for i, t, *_ in rows if i is not None and t is not None}
    units = {i: cut(t) for i, t in docs.items()}
    first, seen = {}, defaultdict(int)
    for i in sorted(docs):
        for a, z, key in runs(units[i], least, words):
            first.setdefault(key, (i, a))
            seen[key] += 1
    out = {}
    for i in docs:
        gone, ids = set(), set()
        for a, z, key in runs(units[i], least, words):
            f, at = first[key]
            if (i, a) != (f, at):
                new = set(range(a if i != f else max(a, at + z - a), z))
                gone |= new
                if new:
                    ids.add(f)
        if gone:
            keep, at = [], 0
            for n in sorted(gone):
                if n - 1 not in gone:       # what lies between two removed units goes too
                    keep.append(docs[i][at:units[i][n][0]])
                at = units[i][n][1]
            out[i] = ("".join(keep) + docs[i][at:], sorted(ids))
    return out


KINDS = [(line_dedup.removals, line_dedup.drop_repeated_lines, line_units, 3, 0),
         (sentence_dedup.removals, sentence_dedup.drop_repeated_sentences, sentence_units, 2, 20)]


def made(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "naïve", "x.y", "1.5"]
    sent = lambda: " ".join(rnd.choices(vocab, k=rnd.choice([2, 5, 9, 14, 40]))) + rnd.choice([".", "!", "?", ".\"", "。", ""])
    common = [sent() + "\n" for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rnd.randint(1, 12)):
            if rnd.random() < 0.35:
                k = rnd.randrange(8)
                parts += common[k:k + rnd.randint(1, 5)]
            else:
                parts.append(sent() + rnd.choice([" ", "\n", "  ", " \n\n"]))
            if rnd.random() < 0.05:
                parts += [parts[-1]] * 5
        rows.append((i * 2 + 101, "".join(parts), "en", "s", 0))
    return rows


@pytest.mark.parametrize("kind", range(2))
def test_equals_brute_force(spark, kind):
    removals, drop, cut, least, words = KINDS[kind]
    rows = made(kind + 3) + [r for r in edge_rows() if r[0] not in (1, 2)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    want = brute(rows, cut, least, words)
    got = {r.doc_id: r for r in removals(docs).collect()}
    assert want and {i: (r.text, r.first_ids) for i, r in got.items()} == want
    texts = {r[0]: r[1] for r in rows}
    for i, r in got.items():      # the spans are the difference
        raw, at, keep = texts[i].encode(), 0, b""
        for a, z in zip(r.starts, r.ends):
            keep, at = keep + raw[at:a], z
        assert keep + raw[at:] == r.text.encode()
    out = drop(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect() if r.doc_id} == {i: want[i][0] if i in want else t for i, t in texts.items() if i}
    assert removals(docs.limit(0)).collect() == [] == drop(docs.limit(0)).collect()


@pytest.mark.parametrize("kind", range(2))
def test_repeated_rows_and_nulls(spark, kind):
    removals, drop, *_ = KINDS[kind]
    docs = spark.createDataFrame(edge_rows(), DOCS)
    assert drop(docs).count() == len(edge_rows())
    assert {r.doc_id for r in removals(docs).collect()} <= {2, 9}


@pytest.mark.parametrize("name,kind", [("op2_line_dedup", 0), ("op8_sentence_dedup", 1)])
def test_query_equals_brute_force(spark, name, kind):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: (r.text, r.first_ids) for r in queries.QUERIES[name](spark, d).collect()}
    assert got == brute(rows, *KINDS[kind][2:])
