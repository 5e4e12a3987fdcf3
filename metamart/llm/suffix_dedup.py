"""Suffix-array dedup over sparse suffixes (op4).

Texts are sequences of words (A-Z lower-cased).  Only suffixes that begin at a
minimiser are kept: the smallest hash of ``GRAM`` words in any window of
``MATCH - GRAM + 1`` of them, a choice that depends on content only.  So two
equal passages of ``MATCH`` words keep a suffix at the same place (about one in
22 words).  Steps, all Spark jobs:

1. executors emit (hash, doc_id, place) of the minimisers; one aggregate finds
   the hashes that occur again, and only their suffixes go on;
2. each suffix carries the hashes of the MATCH words from its place on and of
   the words before it, as far as a window reaches, and suffixes are sorted by
   them (range partitions; ties by doc_id and place, so a group of copies is
   spread over many);
3. the nearest neighbours in the order are compared and extended right and left;
4. suffixes that share the GRAM words with more than NEAR others on a side, or with
   the first or last of their partition, go on as windows of MATCH words: each that has
   its smallest hash at the place, by a 64-bit hash.  An aggregate finds the first
   occurrence of every window, a join the others; windows in a row are one match;
5. every word that a match with an earlier occurrence covers is
   removed; the earlier occurrence (smallest doc_id, then place) stays.

A match longer than MATCH words is the union of those at its minimisers.  Two equal
windows have their minimisers in one group of equal GRAM words.  These are compared
in step 3, or both stand before a NEARth neighbour or partition end of the group and
meet in step 4, so no repeated window is missed, however the ranges fall.

Defined results: null and empty texts and texts under MATCH words change
nothing; rows without a doc_id take no part; rows with one doc_id are one
document; where a passage repeats within a document its first place stays whole;
of one word repeated on end only the first place is a suffix.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metamart.llm import spans
from metamart.llm.common import (as_long, binary_column, materialize, run_codes, small_batches, word_codes, words_of)

MATCH = 50            # words that a repeated passage has at least
GRAM = 8              # words of a minimiser
NEAR = 8              # neighbours in the order on either side
ROWS = 50_000         # sorted suffixes of a partition, about
SPREAD = MATCH - GRAM  # words before a suffix that the same window may hold


def _window(x: np.ndarray, width: int, op) -> np.ndarray:
    """Minimum or maximum of every window, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[:len(out) - step], out[step:])
        have += step
    return out


def minimisers(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the kept suffixes of a text."""
    h = as_long(run_codes(codes, GRAM)) if len(codes) >= MATCH else np.empty(0, np.int64)
    if not len(h):
        return np.empty(0, np.int64), h
    width = MATCH - GRAM + 1
    low = _window(h, width, np.minimum)
    pad = np.full(width - 1, -1, np.int64)
    high = _window(np.concatenate((pad, low, pad)), width, np.maximum)       # over the windows that hold a place
    keep = high == h
    keep[1:] &= h[1:] != h[:-1]
    at = np.flatnonzero(keep)
    return at, h[at]


def _emit(batches):
    for b in small_batches(batches):
        ids, places, hashes = [], [], []
        for doc_id, text in zip(b.column(0).to_pylist(), binary_column(b, 1), strict=True):
            at, h = minimisers(word_codes(words_of(text)))
            ids.append(np.full(len(at), doc_id, np.int64))
            places.append(at)
            hashes.append(h)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hashes, ids, places)], names=["h", "doc_id", "at"])


def _contexts(batches):
    """(key, doc_id, at, mine) of the named places: hashes of the words from there on, then of those
    before, nearest first; bit k of mine: the window that begins k words before has its smallest hash there."""
    for b in small_batches(batches, 100):
        keys, ids, places, masks = [], [], [], []
        for doc_id, text, at in zip(b.column(0).to_pylist(), binary_column(b, 1), b.column(2).to_pylist(), strict=True):
            codes = word_codes(words_of(text))
            c = (codes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)     # 0: no word
            c = np.concatenate((np.zeros(SPREAD, np.uint32), c, np.zeros(MATCH, np.uint32)))
            at = np.unique(np.array([x for x in at if x + SPREAD + MATCH <= len(c)], np.int64))
            right = np.lib.stride_tricks.sliding_window_view(c, MATCH)[at + SPREAD]
            left = np.lib.stride_tricks.sliding_window_view(c, SPREAD)[at][:, ::-1]
            rows = np.concatenate((right, left), axis=1).astype(">u4")
            keys += [r.tobytes() for r in rows]
            ids.append(np.full(len(at), doc_id, np.int64))
            places.append(at)
            h = as_long(run_codes(codes, GRAM))
            low = _window(h, MATCH - GRAM + 1, np.minimum)
            begin = at[:, None] - np.arange(SPREAD + 1)
            inside = (begin >= 0) & (begin < len(low))
            mine = inside & (low[np.where(inside, begin, 0)] == h[at][:, None])
            masks.append((mine << np.arange(SPREAD + 1)).sum(1))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), *(pa.array(np.concatenate(x)) for x in (ids, places, masks))], names=["key", "doc_id", "at", "mine"])


def shared(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that rows of contexts share to the right and to the left."""
    same = (x == y) & (x > 0)
    right = np.where(same[:, :MATCH].all(1), MATCH, np.argmin(same[:, :MATCH], 1))
    left = np.where(same[:, MATCH:].all(1), SPREAD, np.argmin(same[:, MATCH:], 1))
    return right, left


_OUT = "doc_id long, a long, z long, first_id long, at long, w long"


def _neighbours(batches, alone: bool):
    """One sorted partition: matches of neighbours with earlier occurrences (a to z),
    and windows (at, w) of the suffixes that have more partners than neighbours.
    ``alone``: there is no other partition."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    n = table.num_rows
    doc, at = table["doc_id"].to_numpy(), table["at"].to_numpy()
    raw = table["key"].combine_chunks()
    keys = np.frombuffer(b"".join(raw.to_pylist()), ">u4").reshape(n, MATCH + SPREAD)
    order = np.empty(n, np.int64)
    order[np.lexsort((at, doc))] = np.arange(n)                      # smaller: earlier occurrence

    def matches(i: np.ndarray, j: np.ndarray):
        """Later member of pairs (i, j) that share MATCH words: row, range, earlier document."""
        late = np.where(order[i] > order[j], i, j)
        early = i + j - late
        right, left = shared(keys[late], keys[early])
        ok = (right + left >= MATCH) & (late != early)
        late, early, right, left = late[ok], early[ok], right[ok], left[ok]
        a, z = at[late] - left, at[late] + right
        # within a document the earlier place stays whole
        a = np.where(doc[late] == doc[early], np.maximum(a, at[early] + right), a)
        keep = a < z
        return doc[late[keep]], a[keep], z[keep], doc[early[keep]]

    out = []
    for d in range(1, min(NEAR, n - 1) + 1):
        for s in range(0, n - d, 10_000):
            i = np.arange(s, min(n - d, s + 10_000))
            out.append(matches(i, i + d))
    cols = [np.concatenate([o[k] for o in out]) for k in range(4)] if out else [np.empty(0, np.int64)] * 4
    names = ["doc_id", "a", "z", "first_id", "at", "w"]
    none = pa.nulls(len(cols[0]), pa.int64())
    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), none, none], names=names)

    start = np.flatnonzero(np.append(True, (keys[1:, :GRAM] != keys[:-1, :GRAM]).any(1)))
    size = np.diff(np.append(start, n))
    first, last = np.repeat(start, size), np.repeat(start + size - 1, size)      # of the group of equal GRAM words
    row = np.arange(n)
    rest = (last - row > NEAR) | (row - first > NEAR)
    if not alone:
        rest |= (first == 0) | (last == n - 1)
    rest = np.flatnonzero(rest)
    mine = table["mine"].to_numpy()
    wide = 4 * (SPREAD + MATCH)
    for s in range(0, len(rest), 10_000):
        part = rest[s:s + 10_000]
        text = np.concatenate((keys[part, MATCH:][:, ::-1], keys[part, :MATCH]), axis=1).tobytes()
        i, back = np.nonzero((mine[part][:, None] >> np.arange(SPREAD + 1)) & 1)
        # where a window has its smallest hash at several places, one row is enough
        one = np.unique(np.stack((doc[part[i]], at[part[i]] - back)), axis=1, return_index=True)[1]
        i, back = i[one], back[one]
        begin = i * wide + 4 * (SPREAD - back)
        w = np.fromiter((xxhash.xxh3_64_intdigest(text[x:x + 4 * MATCH]) >> 1 for x in begin.tolist()), np.int64, len(i))
        none = pa.nulls(len(i), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(doc[part[i]]), none, none, none, pa.array(at[part[i]] - back), pa.array(w)], names=names)


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, a, z, first_id): ranges of words that occur before, and where."""
    texts = spans._named(docs)
    found = materialize(texts.mapInArrow(_emit, "h long, doc_id long, at long"), "minimisers")
    again = found.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    places = (found.join(again, "h").groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("at").alias("at")))
    rows = (texts.dropDuplicates(["doc_id"]).join(places, F.col("doc_id") == F.col("id")).select("doc_id", "text", "at")
            .mapInArrow(_contexts, "key binary, doc_id long, at long, mine long"))
    rows = materialize(rows, "suffixes")
    parts = max(1, -(-rows.count() // ROWS))
    sort = ["key", "doc_id", "at"]
    done = (rows.repartitionByRange(parts, *sort) if parts > 1 else rows.repartition(1)).sortWithinPartitions(*sort)
    done = materialize(done.mapInArrow(lambda b: _neighbours(b, parts == 1), _OUT), "neighbours")
    near = done.filter("a IS NOT NULL").select("doc_id", "a", "z", "first_id")
    return near.unionByName(_repeated(done.filter("w IS NOT NULL").select("w", "doc_id", "at")))


def _repeated(windows: DataFrame) -> DataFrame:
    """Matches of equal windows with their first occurrence; those in a row are one."""
    first = (windows.groupBy("w").agg(F.min(F.struct("doc_id", "at")).alias("f"), F.count(F.lit(1)).alias("c")).filter("c > 1")
             .select("w", F.col("f.doc_id").alias("first_id"), F.col("f.at").alias("first_at")))
    later = (windows.join(first, "w").filter("doc_id <> first_id OR at <> first_at")
             .select("doc_id", "first_id", "at", (F.col("at") - F.col("first_at")).alias("shift")))
    line = Window.partitionBy("doc_id", "first_id", "shift").orderBy("at")        # within one document
    # within a document the earlier place stays whole
    return (later.withColumn("row", F.col("at") - F.dense_rank().over(line)).groupBy("doc_id", "first_id", "shift", "row")
            .agg(F.min("at").alias("a"), (F.max("at") + MATCH).alias("z"))
            .select("doc_id", F.expr("if(doc_id = first_id, greatest(a, z - shift), a)").alias("a"), "z", "first_id").filter("a < z"))


_WORD = re.compile(rb"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*")


def _words(text: bytes) -> spans.Units:
    at = [m.span() for m in _WORD.finditer(text)]
    n = len(at)
    return spans.Units(np.array([a for a, _ in at], np.int64), np.array([z for _, z in at], np.int64), np.zeros(n, np.uint64), np.ones(n, np.int64))


WORDS = spans.Runs(_words, 1)


def _covers(docs: DataFrame) -> DataFrame:
    return (matches(docs).groupBy(F.col("doc_id").alias("id"))
            .agg(F.collect_set(F.struct("a", "z")).alias("covers"), F.array_sort(F.collect_set("first_id")).alias("first_ids")))


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, first_ids, starts, ends, text of every document that loses words."""
    rows = spans._named(docs).join(_covers(docs), F.col("doc_id") == F.col("id")).select("doc_id", "text", "first_ids", "covers")
    out = rows.mapInArrow(spans._clean(WORDS, 1, 3), "doc_id long, text string, first_ids array<long>, starts array<long>, ends array<long>")
    return out.filter("size(starts) > 0").select("doc_id", "first_ids", "starts", "ends", "text")
