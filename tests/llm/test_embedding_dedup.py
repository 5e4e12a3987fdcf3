import numpy as np
import pytest

from metamart.llm import embedding_dedup as E, queries
from tests.llm.cases import least_reachable, with_clashes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.9):
    ok = {}
    for i, v, *_ in rows:
        usable = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok[i] = np.array(v) / np.linalg.norm(v) if usable else None
    ids = [i for i in ok if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and ok[a] is not None and ok[b] is not None
             and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= cosine]
    root = least_reachable(ids, links)
    return {i: (sum(i in p for p in links), root[i]) for i in ids}


def check(got, rows):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id) == want[r.vec_id], r
            assert r.kept == (r.vec_id == r.component_id)


@pytest.mark.parametrize("dim", [1, 3, 16])
def test_equals_brute_force(spark, dim, monkeypatch):
    monkeypatch.setattr(E, "TILE", 40)
    monkeypatch.setattr(E, "STRIP", 16)
    rnd = np.random.default_rng(dim)
    rows = []
    for g in range(8):
        base = rnd.normal(size=dim)
        for n in range(15):
            v = base + rnd.normal(size=dim) * rnd.choice([0, 0.05, 0.2, 0.45])
            rows.append((len(rows) * 3, (v * rnd.uniform(0.1, 9)).tolist() if n else base.tolist(), 0))
    rows += [(1000 + i, rows[0][1], None) for i in range(60)]           # identical copies
    check(E.near_duplicates(with_clashes(spark.createDataFrame(rows, SCHEMA))).collect(), rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
            (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0), (8, [2.0, 4.0], 0), (9, [1.0, 2.0, 0.0], 0), (None, [1.0, 2.0], 0),
            (10, [-1.0, -2.0], None), (11, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(E.near_duplicates(df).collect(), rows)
    assert E.near_duplicates(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.QUERIES["op7_embedding_dedup"](spark, d).collect(), rows)


def clusters(dim, groups, size, spread=(0, 0.05, 0.2, 0.45)):
    rnd = np.random.default_rng(dim)
    rows = []
    for _ in range(groups):
        base = rnd.normal(size=dim)
        rows += [(len(rows) + n, (base + rnd.normal(size=dim) * rnd.choice(spread)).tolist(), 0) for n in range(size)]
    return rows


@pytest.mark.parametrize(("dim", "tile", "blocks"), [(2, 1, 4), (5, 1, 4), (16, 1, 4), (16, 4, 3)])
def test_grid_over_several_blocks_equals_brute_force(spark, dim, tile, blocks, monkeypatch):
    monkeypatch.setattr(E, "TILE", tile)
    rows = clusters(dim, 40, 7)
    assert E.grid_blocks(len(rows)) == blocks
    check(E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_double_precision_and_mixed_lengths(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 3)
    rows = [(i, [float(np.float32(x)) for x in v] if i % 3 else v, 0) for i, v, _ in clusters(6, 8, 6)]
    rows += [(1000 + i, v, 0) for i, v, _ in clusters(4, 4, 5)]
    check(E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_pairs_of_tiles_move_no_vectors(spark, monkeypatch):
    """The join of tiles reads their files: its plan has no exchange, so disk does not grow with the pairs."""
    plans, write = {}, E.materialize

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(E, "materialize", kept)
    monkeypatch.setattr(E, "TILE", 4)
    rows = clusters(8, 10, 6)
    check(E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)
    assert "Scan parquet" in plans["found"]
    assert "Exchange" not in plans["found"]


def test_components_of_a_task_survive_reductions(monkeypatch):
    """A chain of tiles, reduced after every pair: one component, each link counted once for both ends."""
    import pyarrow as pa

    monkeypatch.setattr(E, "EDGES", 0)
    side = lambda ids, left: E.Tile(2, pa.scalar(ids), pa.scalar([1, 2]), np.array([[1, 0], [0, 1]], np.float32).tobytes(), left)
    tiles = [[9, 8], [7, 6], [5, 4]]
    links = E.Links()
    for n in range(2):
        a, b = side(tiles[n], True), side(tiles[n + 1], False)
        i, j = E._near(a, b, 0.9, False)
        links.add((n,), a, b"%d" % n * 32, (n + 1,), b, b"%d" % (n + 1) * 32, i, j)
    got = {r["id"]: (r["key"][:1], r["n"], r["root"]) for batch in links.batches() for r in batch.to_pylist()}
    assert got == {9: (b"0", 1, 5), 7: (b"1", 2, 5), 5: (b"2", 1, 5), 8: (b"0", 2, 4), 6: (b"1", 4, 4), 4: (b"2", 2, 4)}
