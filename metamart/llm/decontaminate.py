"""Benchmark decontamination by spaced seeds (op9).

Every window as long as a mask is hashed once per mask; a mask ignores fixed
positions, so a window whose words were substituted there still hashes alike.
Hashes of the benchmark items are looked up by the hashes of the training
texts.  Every hit fixes an alignment of item and text; the words of the whole
item are compared along it, and the best run around the hit decides.

Verified overlap: along the alignment the run that maximises matches minus
``PENALTY`` x substitutions has at least ``MIN_RUN`` words, at least 80 % of them
equal (all positions of an item of fewer words: 80 % of the item); or 80 % of
the whole item's words are equal.  Items under 5 words match nothing.

No miss.  ``MASKS`` were found by enumeration: each way to substitute 2 of 13, 3 of
15 or 4 of 20 words leaves a window that some mask hits.  Longer overlaps follow.
Let 5k words hold at most k substitutions, k > 4.  If the first five hold one, the
rest is the case k - 1; else if the first ten hold two, the rest is the case k - 2;
else the first ten hold one at most, behind five equal words, which a mask hits.
Items under 13 words use ``SHORT_MASKS``: of disjoint windows of five words one
has one substitution at most, and the masks ignore each place once.  Seeds lie
in the text, so four words at a text's end match no item of five.

The benchmark is a stated query set.  It is taken in blocks of at most
``BLOCK_WORDS`` words (plus one item), whose seeds are broadcast; every block
scans all whole texts, so no join shuffles them and any benchmark size gives
the same rows.

Defined results: null or empty texts and items overlap with nothing; repeated
rows of documents give repeated rows; every item row reports for itself; null doc_ids are reported as null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import binary_column, mix64, remembering, small_batches, word_codes, words_of

MASKS = ((0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 7, 9), (0, 1, 3, 7, 8, 9), (0, 2, 4, 5, 8, 9), (0, 2, 3, 6, 7, 9))
LONGEST = 10             # words of the longest mask
SHORT_SPAN = 5           # items of 5 to 12 words
SHORT_MASKS = ((0, 1, 2, 3), (1, 2, 3, 4), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4))
MIN_RUN = 13
SIMILAR = 0.8
PENALTY = 3.9
BLOCK_WORDS = 500_000
TABLE_BITS = 22

_ODD = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3)) & 0xFFFFFFFFFFFFFFFF | 1) for i in range(LONGEST)]

def seed_hashes(codes: np.ndarray, span: int, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """Hash of the masked window at every position with ``span`` words left."""
    m = len(codes) - span + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(m, salt, np.uint64)
    for o in mask:
        acc += codes[o:o + m] * _ODD[o]
    return mix64(acc)


def _all_masks(short: bool):
    out = [(m[-1] + 1, m, i) for i, m in enumerate(MASKS)]
    return out + ([(SHORT_SPAN, m, 100 + i) for i, m in enumerate(SHORT_MASKS)] if short else [])


@dataclass
class Block:
    """Seeds and words of some benchmark items."""

    item_ids: list
    words: np.ndarray        # codes of all items, one after the other
    first: np.ndarray        # place of every item in words
    seeds: np.ndarray        # sorted hashes
    item: np.ndarray         # item number of every seed
    at: np.ndarray           # word of the item where the seed begins
    short: bool

    @classmethod
    def build(cls, items: list[tuple[object, bytes | None]]) -> Block:
        codes = [word_codes(words_of(t)) for _, t in items]
        seeds, item, at = [], [], []
        for i, c in enumerate(codes):
            for span, mask, salt in _all_masks(True):
                if salt < 100 or len(c) < MIN_RUN:
                    h = seed_hashes(c, span, mask, salt)
                    seeds.append(h)
                    item.append(np.full(len(h), i))
                    at.append(np.arange(len(h)))
        cat = lambda xs, kind: np.concatenate([np.empty(0, kind), *xs]).astype(kind)
        seeds, item, at = cat(seeds, np.uint64), cat(item, np.int64), cat(at, np.int64)
        order = np.argsort(seeds, kind="stable")
        return cls([x for x, _ in items], cat(codes, np.uint64), np.concatenate(([0], np.cumsum([len(c) for c in codes]))).astype(np.int64),
                   seeds[order], item[order], at[order], any(SHORT_SPAN <= len(c) < MIN_RUN for c in codes))

    def table(self) -> np.ndarray:
        t = np.zeros(1 << TABLE_BITS, bool)
        t[(self.seeds >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return t

    def alignments(self, codes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Distinct (item, place of the item's first word in the text) of all hits."""
        found = []
        for span, mask, salt in _all_masks(self.short):
            h = seed_hashes(codes, span, mask, salt)
            pos = np.flatnonzero(table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(self.seeds, h[pos], "left"), np.searchsorted(self.seeds, h[pos], "right")
            n = hi - lo
            if n.any():
                k = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                found.append(np.stack((self.item[k], np.repeat(pos, n) - self.at[k]), 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)

    def overlaps(self, text: bytes | None, table: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first word in the text, words, equal words) of verified overlaps, the best per item."""
        codes = word_codes(words_of(text))
        best: dict[int, tuple[int, int, int, int]] = {}
        for item, place in self.alignments(codes, table).tolist():
            want = self.words[self.first[item]:self.first[item + 1]]
            a, z = max(0, -place), min(len(want), len(codes) - place)
            same = codes[place + a:place + z] == want[a:z]
            run = best_run(same)
            if run is None:
                continue
            start, end, equal = run
            total = int(same.sum())
            long_enough = end - start >= min(MIN_RUN, int(np.ceil(SIMILAR * len(want))))
            if total >= SIMILAR * len(want) or long_enough and equal >= SIMILAR * (end - start):
                if total >= SIMILAR * len(want):
                    start, end, equal = 0, z - a, total
                row = (item, place + a + start, end - start, equal)
                if item not in best or (row[3], -row[1]) > (best[item][3], -best[item][1]):
                    best[item] = row
        return list(best.values())


def best_run(same: np.ndarray) -> tuple[int, int, int] | None:
    """(start, end, equal) of the run with the most matches less PENALTY a substitution."""
    if not same.any():
        return None
    total = np.concatenate(([0.0], np.cumsum(np.where(same, 1.0, -PENALTY))))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmax(total[:end + 1] == low[end]))
    return start, end, int(same[start:end].sum())


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark's items in bounded blocks (driver memory: one block)."""
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (block_words * 6)))
    for i in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == i)
        rows = [(r[0], None if r[1] is None else r[1].encode()) for r in part.collect()]
        if rows:
            yield Block.build(rows)


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item with a verified overlap: doc_id, item_id,
    start_word, n_words, n_equal, similarity."""
    spark = docs.sparkSession
    item_type = benchmark.schema["item_id"].dataType
    schema = "doc_id long, item_no long, start_word long, n_words long, n_equal long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(block)

        @remembering("words")
        def run(batches, shared=shared):
            block, table = shared.value, shared.value.table()
            for b in small_batches(batches, 500):
                ids = b.column(0).to_pylist()
                rows = [(d, *o) for d, t in zip(ids, binary_column(b, 1), strict=True) for o in block.overlaps(t, table)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["doc_id", "item_no", "start_word", "n_words", "n_equal"])

        names = spark.createDataFrame(list(enumerate(block.item_ids)), f"item_no long, item_id {item_type.simpleString()}")
        found = (texts.mapInArrow(run, schema).join(F.broadcast(names), "item_no")
                 .select("doc_id", "item_id", "start_word", "n_words", "n_equal",
                         (F.col("n_equal") / F.col("n_words")).alias("similarity")))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"doc_id long, item_id {item_type.simpleString()}, start_word long, "
                                        "n_words long, n_equal long, similarity double")
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents (all columns) without a verified overlap; decided where
    the texts are read, without a join."""
    spark = docs.sparkSession
    at = docs.columns.index("text")
    for block in blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(block)

        @remembering("words")
        def run(batches, shared=shared):
            block, table = shared.value, shared.value.table()
            for b in small_batches(batches, 500):
                yield b.filter(pa.array([not block.overlaps(t, table) for t in binary_column(b, at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
