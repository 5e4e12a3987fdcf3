"""op11 against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from metamart.llm import prefix_trie, queries
from tests.conftest import SF0001
from tests.llm.cases import with_clashes

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [c.split()[0] for c in prefix_trie.NODES.split(", ")]


def code(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, code(t[1], t[2])))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole[c] = tuple(t[1:] for t in own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(whole[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def random_rows(seed, convs):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.choice([rng.randint(-250, 400), 100 * rng.randint(-2, 4)])
        for t in range(rng.randint(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "a", "bé", "", None])))
    return rows


@pytest.fixture(params=[(100_000, 2_000_000), (12, 40), (1, 9)], ids=["whole", "cut", "single"])
def sizes(request, monkeypatch):
    """Shards that hold everything, a few codes, one conversation."""
    monkeypatch.setattr(prefix_trie, "SHARD_CODES", request.param[0])
    monkeypatch.setattr(prefix_trie, "PART_CODES", request.param[1])


def test_query_equals_brute_force(spark, sizes):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_prefix_trie(spark, SF0001)) == expected(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tries(spark, sizes, seed):
    rows = random_rows(seed, 70)
    assert got(prefix_trie.nodes(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_edges(spark, sizes):
    same = [(1000 + i, t, "user", "same") for i in range(60) for t in range(3)]           # a large group of copies
    rows = same + [(1, None, "user", "before"), (1, 0, "user", "first"), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
                   (None, 0, "user", "lost"), (2, 5, None, None), (7, 0, "", ""), (300, 0, "user", "x" * 100_000), (301, 0, "user", "y"),
                   *((500, t, "user", f"t{t}") for t in range(300)), *((501, t, "user", f"t{t}") for t in range(290))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows)
    assert got(prefix_trie.nodes(df)) == want
    assert got(prefix_trie.nodes(with_clashes(df).withColumnRenamed("kept", "depth"))) == want


def test_empty_table(spark):
    assert prefix_trie.nodes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_find_close():
    rng = random.Random(3)
    for _ in range(60):
        kinds, depth = [1], 1
        for _ in range(rng.randint(0, 700)):
            kinds.append(1 if depth == 1 or rng.random() < rng.choice([.3, .5, .9]) else -1)
            depth += kinds[-1]
        kinds += [-1] * depth
        stack, want = [], {}
        for i, k in enumerate(kinds):
            if k > 0:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(np.array(kinds) > 0)
        assert prefix_trie.find_close(np.cumsum(kinds), opens).tolist() == [want[i] for i in opens]
