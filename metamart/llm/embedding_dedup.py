"""Near-duplicate embeddings by a subspace pigeonhole join (op7).

Unit vectors with cosine >= c lie within squared distance eps2 = 2 - 2c.  All
vectors are turned by one random rotation and cut into blocks of dimensions;
a block gets the budget eps2 x (its dimensions / all).  If every block of a pair
exceeded its budget the pair would exceed eps2, so a range join per block, each
under its own budget, finds every link.  The union of the blocks' candidates is
verified by the cosine in double precision of the vectors as given.

Vectors lie once, in tiles of at most about ``TILE``.  A tile is a grid cell of the
first coordinates of some blocks, one a block and as wide as the block's radius (the
more tiles, the more blocks), and spread by a hash within its cell.  A block is
joined for a pair of tiles whose bounds in it are within its radius; a pair of tiles
that no block joins, or whose bounds are too far apart over all blocks, is no work.
Nor is a strip of a pair in which every two vectors exceed eps2 in half of the blocks
alone.  Distances are matrix products in a task, in strips.

Pairs of tiles are a nested loop over the files of tiles: a task reads two files, so no
vector is shuffled or written for a pair, and disk grows with the vectors alone.  A task
returns per vector its number of links and its component there, never the
pairs, so a large group costs rows in proportion to its vectors.

Identical vectors collapse first and count by their number; they are told apart by
16 bytes of BLAKE2b.  Vectors of different lengths are never compared.  In high
dimensions the bounds exclude little: time grows with the square of
the number of distinct vectors; see the README for figures.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component link with nothing; repeated rows of a vec_id count once;
rows with a null vec_id link with nothing, n_links 0, component_id null, kept.
"""

from __future__ import annotations

import hashlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import arrow_rows, materialize, small_batches
from metamart.llm.graph import components

COSINE = 0.9
BLOCKS = 4
TILE = 2048
STRIP = 128               # rows of a product at a time: it stays in a core's cache
FILE_BYTES = 16 << 20     # of a file of tiles, about
EDGES = 1_000_000         # links of a task between two reductions to components
KEY_BYTES = 16
SLACK = 1e-6      # of squared distances: rounding never loses a candidate


@lru_cache(maxsize=16)
def rotation(dim: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q


def block_slices(dim: int) -> list[slice]:
    cuts = np.linspace(0, dim, min(BLOCKS, dim) + 1).round().astype(int)
    return [slice(a, z) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


def front_slice(dim: int) -> slice:
    """The first half of the blocks."""
    blocks = block_slices(dim)
    return slice(0, blocks[(len(blocks) - 1) // 2].stop)


def _rows(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None where a vector cannot be compared."""
    out: list[np.ndarray | None] = []
    for x in column:
        v = None
        if x.is_valid and len(x) and not x.values.null_count:
            v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
            # a norm that overflows or underflows in double precision counts as not finite or zero
            if not np.isfinite(v).all() or not (0 < np.sqrt(v @ v) < np.inf):
                v = None
        out.append(v)
    return out


def block_radius(cosine: float, block: slice, dim: int) -> float:
    return np.sqrt((2 - 2 * cosine) * (block.stop - block.start) / dim + SLACK)


KEYED = "vec_id long, dim int, key binary, " + ", ".join(f"g{n} int" for n in range(BLOCKS))


def _keyed(cosine: float):
    """The key of a vector and its grid cell by the first coordinate of each block."""
    def run(batches):
        for b in small_batches(batches, 2000):
            vecs = _rows(b.column(1))
            dims = np.array([0 if v is None else len(v) for v in vecs], np.int32)
            cells = np.zeros((len(vecs), BLOCKS), np.int32)
            for dim in np.unique(dims[dims > 0]).tolist():
                rows = np.flatnonzero(dims == dim)
                unit = _unit(np.stack([vecs[i] for i in rows]))
                for n, s in enumerate(block_slices(dim)):
                    cells[rows, n] = np.floor(unit @ rotation(dim)[:, s.start] / block_radius(cosine, s, dim))
            keys = [None if v is None else _key(_raw(v)) for v in vecs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(dims), pa.array(keys, pa.binary()), *map(pa.array, cells.T.copy())],
                                             names=["vec_id", "dim", "key", *(f"g{n}" for n in range(BLOCKS))])
    return run


def _raw(v: np.ndarray) -> bytes:
    """Components as bytes, in single precision where that is exact."""
    with np.errstate(over="ignore"):
        s = v.astype(np.float32)
    return s.tobytes() if (s == v).all() else b"d" + v.tobytes()


def _key(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=KEY_BYTES).digest()


def _packed(batches):
    for b in small_batches(batches, 2000):
        raw = [_raw(v) for v in _rows(b.column(0)) if v is not None]
        yield pa.RecordBatch.from_arrays([pa.array(map(_key, raw), pa.binary()), pa.array(raw, pa.binary())], names=["key", "raw"])


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[1:], np.float64) if len(raw) % 4 else np.frombuffer(raw, np.float32).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _pack_tiles(batches):
    """All keys and vectors of a tile as one run of bytes each."""
    for b in small_batches(batches, 8):
        out = []
        for raw in b.column(4):
            parts = raw.as_py()
            if any(len(v) % 4 for v in parts):
                parts = [_unpack(v).tobytes() for v in parts]
            out.append(b"".join(parts))
        keys = [b"".join(k.as_py()) for k in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), b.column(2), b.column(3), pa.array(out, pa.binary())],
                                         names=["t", "keys", "ids", "mult", "raw"])


class Tile:
    """Unit vectors of a tile, turned, and as one side of products in single precision."""

    def __init__(self, dim: int, ids: pa.Array, mult: pa.Array, raw: bytes, left: bool):
        self.ids = ids.values.to_numpy(zero_copy_only=False)
        self.mult = mult.values.to_numpy(zero_copy_only=False)
        x = np.frombuffer(raw, np.float32 if len(raw) == 4 * dim * len(self.ids) else np.float64)
        self.unit = _unit(x.astype(np.float64).reshape(len(self.ids), -1))
        self.turned = self.unit @ rotation(dim)
        self.low, self.high = self.turned.min(0), self.turned.max(0)
        self.left = left

    def side(self, s: slice) -> np.ndarray:
        """Extended vectors: the product of two sides is -(squared distance) / 2."""
        y = self.turned[:, s]
        half, one = -0.5 * (y * y).sum(1), np.ones(len(y))
        ext = np.column_stack((y, half, one) if self.left else (y, one, half)).astype(np.float32)
        return ext if self.left else ext.T

    @cached_property
    def front(self) -> np.ndarray:
        return self.side(front_slice(self.unit.shape[1]))

    @cached_property
    def blocks(self) -> list[np.ndarray]:
        return [self.side(s) for s in block_slices(self.unit.shape[1])]


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected to every index, by repeated minima."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _near(a: Tile, b: Tile, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the links of two tiles, each once."""
    eps2, dim = 2 - 2 * cosine, a.unit.shape[1]
    apart = np.maximum(np.maximum(a.low - b.high, b.low - a.high), 0) ** 2       # of the bounds
    work = []
    if apart.sum() <= eps2 + SLACK:
        for n, s in enumerate(block_slices(dim)):
            limit = eps2 * (s.stop - s.start) / dim + SLACK
            if apart[s].sum() <= limit:
                work.append((n, np.float32(-0.5 * limit - 1e-5)))
    whole = np.float32(-0.5 * (eps2 + SLACK) - 1e-5)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(a.unit) if work else 0, STRIP):
        front = a.front[at:at + STRIP] @ b.front
        if front.max() < whole:                             # no pair is within the whole distance over half the blocks
            continue
        near = np.zeros(front.shape, bool)                  # a candidate of any block
        for n, limit in work:
            near |= a.blocks[n][at:at + STRIP] @ b.blocks[n] >= limit
        near &= front >= whole
        i, j = np.divmod(np.flatnonzero(near), near.shape[1])
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for cut in range(0, len(i), 200_000):               # candidates of this strip, exactly
            ci, cj = i[cut:cut + 200_000], j[cut:cut + 200_000]
            ok = np.einsum("ij,ij->i", a.unit[ci], b.unit[cj]) >= cosine
            left.append(ci[ok])
            right.append(cj[ok])
    return np.concatenate(left), np.concatenate(right)


class Links:
    """Numbers of links and components of the vectors of a task's tiles that have any."""

    def __init__(self):
        self.tiles: dict[tuple, tuple[int, np.ndarray, bytes, np.ndarray]] = {}     # place, number of links, keys, ids
        self.size = self.edges = 0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def _tile(self, name: tuple, tile: Tile, keys: bytes) -> tuple[int, np.ndarray]:
        if name not in self.tiles:
            self.tiles[name] = self.size, np.zeros(len(tile.ids), np.int64), keys, tile.ids
            self.size += len(tile.ids)
        return self.tiles[name][:2]

    def add(self, name_a: tuple, a: Tile, keys_a: bytes, name_b: tuple, b: Tile, keys_b: bytes, i: np.ndarray, j: np.ndarray) -> None:
        at, n = self._tile(name_a, a, keys_a)
        n += np.bincount(i, b.mult[j], len(n)).astype(np.int64)
        at_b, n = self._tile(name_b, b, keys_b)
        n += np.bincount(j, a.mult[i], len(n)).astype(np.int64)
        self.pairs.append((i + at, j + at_b))
        self.edges += len(i)
        if self.edges > EDGES:
            self._roots()

    def _roots(self) -> np.ndarray:
        """The components so far; they replace the pairs."""
        pairs = self.pairs or [(np.empty(0, np.int64),) * 2]
        root = _local_roots(self.size, *map(np.concatenate, zip(*pairs, strict=True)))
        moved = np.flatnonzero(root != np.arange(self.size))
        self.pairs, self.edges = [(moved, root[moved])], 0
        return root

    def batches(self):
        if not self.tiles:
            return
        root = self._roots()
        ids = np.concatenate([t[3] for t in self.tiles.values()])
        low = np.full(self.size, np.iinfo(np.int64).max)
        np.minimum.at(low, root, ids)
        for at, n, keys, ids in self.tiles.values():
            has = np.flatnonzero(n)
            names = [keys[KEY_BYTES * i:KEY_BYTES * (i + 1)] for i in has.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *map(pa.array, (ids[has], n[has], low[root[at + has]]))],
                                             names=["key", "id", "n", "root"])


def _tile_links(cosine: float):
    def run(batches):
        links, last, a = Links(), None, None
        for batch in batches:
            for b in small_batches([batch], 1):
                row = {n: b.column(i)[0] for i, n in enumerate(b.schema.names)}
                names = [tuple(row[t].as_py().values()) for t in ("ta", "tb")]
                side = lambda x, left: Tile(row["dim"].as_py(), row["ids_" + x], row["mult_" + x], row["raw_" + x].as_py(), left)  # noqa: B023, E731
                if names[0] != last:                        # rows of one left tile follow each other
                    last, a = names[0], side("a", True)
                other = side("b", False)
                i, j = _near(a, other, cosine, names[0] == names[1])
                if len(i):
                    links.add(names[0], a, row["keys_a"].as_py(), names[1], other, row["keys_b"].as_py(), i, j)
        yield from links.batches()
    return run


def grid_blocks(vectors: int) -> int:
    """Blocks whose first coordinate makes the grid: about four cells a block, no more cells than tiles."""
    return min(BLOCKS, int(np.emath.logn(4, max(1, vectors // TILE))))


def _in_reach(blocks: int):
    """Can tiles of two cells hold a link?  Some block must be free or have its cells
    side by side, and all gaps together must be within the whole distance."""
    gaps = [F.greatest(F.abs(F.col(f"ta.g{n}") - F.col(f"tb.g{n}")) - 1, F.lit(0)) for n in range(blocks)]
    near = F.col("ta.dim") == F.col("tb.dim")
    if blocks:
        some = F.least(F.col("ta.dim"), F.lit(BLOCKS))          # blocks; a block's dimensions are at least this share of all
        share = F.floor(F.col("ta.dim") / some) / F.col("ta.dim")
        near &= sum((g * g for g in gaps), F.lit(0)) * share <= 1 + 1e-9
    if blocks == BLOCKS:
        near &= F.least(*gaps) == 0
    return near


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    keyed = materialize(rows.mapInArrow(_keyed(cosine), KEYED), "vectors")
    cell = [f"g{n}" for n in range(BLOCKS)]
    # a cell that rounding moved between equal vectors: any of them
    least = [F.min(g).alias(g) for g in cell]
    members = (keyed.filter("key IS NOT NULL AND vec_id IS NOT NULL").groupBy("vec_id", "dim", "key").agg(*least))
    classes = materialize(members.groupBy("dim", "key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("mult"), *least), "classes")

    vectors, components_ = classes.agg(F.count(F.lit(1)), F.sum(F.col("dim").cast("long"))).first()
    blocks = grid_blocks(vectors)
    at = ["dim", *cell[:blocks]]
    sizes = classes.groupBy(*at).agg(F.expr(f"cast(ceil(count(*) / {TILE}) AS int)").alias("tiles"))
    placed = (classes.join(sizes, at).withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
              .select("key", "id", "mult", F.struct(*at, "tile").alias("t")))
    raws = rows.filter("vec_id IS NOT NULL").select("embedding").mapInArrow(_packed, "key binary, raw binary")
    raws = raws.groupBy("key").agg(F.first("raw").alias("raw"))
    files = max(int(np.ceil(np.sqrt(8 * spark.sparkContext.defaultParallelism))), int(4 * (components_ or 0) // FILE_BYTES))
    tiles = (raws.join(placed, "key").repartition(files, "t").groupBy("t")
             .agg(F.array_sort(F.collect_list(F.struct("key", "id", "mult", "raw"))).alias("v"))
             .select("t", F.col("v.key").alias("keys"), F.col("v.id").alias("ids"), F.col("v.mult").alias("mult"), F.col("v.raw").alias("raw")))
    kind = f"struct<{', '.join(f'{c}: int' for c in (*at, 'tile'))}>"
    with arrow_rows(spark, 2):                              # tiles are large rows
        tiles = materialize(tiles.mapInArrow(_pack_tiles, f"t {kind}, keys binary, ids array<long>, mult array<long>, raw binary"), "tiles")
        left, right = (tiles.toDF("t" + x, *(f"{c}_{x}" for c in ("keys", "ids", "mult", "raw"))) for x in "ab")
        # pairs of tiles in reach, each once: a nested loop over files, nothing is shuffled
        work = (left.join(right.hint("shuffle_replicate_nl"), _in_reach(blocks) & (F.col("ta") <= F.col("tb")))
                .select(F.col("ta.dim").alias("dim"), *left.columns, *right.columns))
        found = materialize(work.mapInArrow(_tile_links(cosine), "key binary, id long, n long, root long"), "found")

    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    roots = components(found.select("id", "root"))
    by_class = (classes.select("key", "id", "mult").join(counts, "key", "left").join(roots, "id", "left")
                .select("key", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("root", "id").alias("root")))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("root", "vec_id"))
    return (keyed.join(by_class, "key", "left")
            .select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
                    component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))
