"""Near-duplicate documents by bottom-k sketches of one hash function (op10).

Method.  Every document's set of 5-word shingles is hashed by one 64-bit
function; the k smallest hashes are its sketch.  Inverted lists of retained
values generate candidates, the sketch of the union estimates the similarity
and drops hopeless pairs, and the exact Jaccard of the full sets decides.

Lossless candidates without hot lists.  Two sets with J >= 0.85 share at least
``SHARED`` of their K=32 sketch values but for a chance of about 4e-7 (binomial
tail at the threshold itself).  So, in any common order of values, the first
K - SHARED + 1 values of both sketches share one.  The order used is rare
values first, hence a passage that many documents share is no list unless it
makes up half a document.  Sets of up to 27 shingles have complete sketches and the
exact prefix.

No pairs within a group.  Identical sets collapse first.  In a list every
member is compared with one leader, its least edited member.  Members that the
leader does not confirm meet the rest of the list, but for pairs that are
connected already and pairs whose own shingles exclude a link (an exact bound).
Components need no more links than these.

Defined results: null or empty texts have no shingles and no link; documents
of fewer than 5 words have one shingle; rows with a null doc_id take part in
nothing and keep a null component_id and kept = true; repeated rows of a doc_id
give one result row each and share its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metamart.llm.common import (arrow_rows, as_long, binary_column, list_array, materialize, remembering, run_codes,
                                 small_batches, word_codes, words_of)
from metamart.llm.graph import components

WIDTH = 5           # words of a shingle
K = 32              # values of a sketch
SHARED = 16         # sketch values that two similar sets share at least
EXACT = 27          # sets up to this size have partners with complete sketches
NUM, DEN = 85, 100  # link if DEN * intersection >= NUM * union


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes (63-bit) of a whole text."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int64)
    codes = word_codes(words)
    return np.unique(as_long(run_codes(codes, min(width, len(codes)))))


@remembering("words")
def _profile(batches):
    for b in small_batches(batches):
        sets = [shingle_set(t) for t in binary_column(b, 1)]
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
             list_array([s[:K] for s in sets], pa.int64())], names=["doc_id", "n", "digest", "sketch"])


@remembering("words")
def _sets(batches):
    for b in small_batches(batches, 200):
        yield pa.RecordBatch.from_arrays(
            [b.column(0), list_array([shingle_set(t) for t in binary_column(b, 1)], pa.int64())],
            names=["doc_id", "shingles"])


def _id_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest of the set, sketch) of every row, on shared storage."""
    with arrow_rows(docs.sparkSession):
        return materialize(_id_text(docs).mapInArrow(
            _profile, "doc_id long, n long, digest binary, sketch array<long>"), "sketches")


def _sizes_fit(a: str, b: str):
    return F.expr(f"{DEN} * least({a}, {b}) >= {NUM} * greatest({a}, {b})")


def _estimate_fits(a: str, b: str):
    """Share of the union's sketch that lies in both; complete sketches are exact."""
    return F.expr(f"""
        size(array_intersect(array_intersect(slice(array_sort(array_union({a}, {b})), 1, {K}), {a}), {b}))
        >= {SHARED / K} * least({K}, size(array_union({a}, {b})))""")


def postings(reps: DataFrame) -> DataFrame:
    """(v, id, n, own): the retained values that generate candidates, rare ones
    first within every document; values of a single document are no list.
    ``own`` counts a sketch's values that no other document has."""
    post = reps.select(F.col("doc_id").alias("id"), "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    shared = post.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = (post.join(shared, "v").groupBy("id", "n", "k")
              .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs")))
    prefix = F.expr(f"CASE WHEN n <= {EXACT} THEN n - (n * {NUM} + {DEN - 1}) DIV {DEN} + 1 "
                    f"ELSE k - {SHARED} + 1 END")
    room = F.greatest(F.lit(0), prefix - (F.col("k") - F.size("vs"))).cast("int")
    return (ranked.select("id", "n", (F.col("k") - F.size("vs")).alias("own"),
                          F.explode(F.slice("vs", F.lit(1), room)).alias("x")).select("x.v", "id", "n", "own"))


def _scored(pairs: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, linked) of the pairs that the sketches do not exclude:
    the exact size of the intersection of their full sets."""
    sk = reps.select("doc_id", "sketch")
    near = (pairs.join(sk.toDF("a", "sa"), "a").join(sk.toDF("b", "sb"), "b")
            .filter(_estimate_fits("sa", "sb")).select("a", "b"))
    near = materialize(near, "near")
    both = (near.join(sets.toDF("b", "tb"), "b").join(sets.toDF("a", "ta"), "a")
            .withColumn("common", F.expr("size(array_intersect(ta, tb))")))
    fits = F.expr(f"{DEN} * common >= {NUM} * (size(ta) + size(tb) - common)")
    return both.select("a", "b", F.col("common").cast("long").alias("common"), fits.alias("linked"))


def link_classes(docs: DataFrame, prof: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between class representatives, enough of them
    to connect whatever the threshold connects."""
    classes = prof.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    reps = materialize(prof.join(classes, ["digest", "doc_id"]).dropDuplicates(["doc_id"])
                       .select("doc_id", "n", "sketch"), "reps")
    post = materialize(postings(reps), "postings")
    # the leader has the fewest values of its own: of edited copies, the least edited one
    lists = (post.groupBy("v").agg(F.min(F.struct("own", "id", "n")).alias("lead"), F.count(F.lit(1)).alias("members"))
             .filter("members > 1").select("v", F.col("lead.id").alias("lead"), F.col("lead.n").alias("lead_n")))
    led = materialize(post.join(lists, "v").filter("id <> lead"), "led")
    pairs = led.filter(_sizes_fit("n", "lead_n")).select(F.least("lead", "id").alias("a"),
                                                              F.greatest("lead", "id").alias("b")).distinct()

    members = led.select("id").union(led.select("lead")).distinct().withColumnRenamed("id", "doc_id")
    texts = _id_text(docs).join(members, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    with arrow_rows(docs.sparkSession):
        sets = materialize(texts.mapInArrow(_sets, "doc_id long, shingles array<long>"), "sets")
    scored = materialize(_scored(pairs, reps, sets), "scored")
    star = scored.filter("linked").select("a", "b")

    root = materialize(components(star), "roots")
    rest = _unconfirmed(led, scored, root, sets)
    return star.unionByName(_scored(rest, reps, sets).filter("linked").select("a", "b"))


def _unconfirmed(led: DataFrame, scored: DataFrame, root: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of a list's members, one of them not connected to the
    list's leader, that may still be links.

    A shingle that no other document of these lists has cannot be common to a
    pair.  With f = n less such shingles, a pair shares at most
    least(f_x, f_y) shingles; most members drop out on their own, against the
    smallest set of the list, before any pair is formed.  Of the shingles that a pair
    shares, at most least(c_x, c_y) are the leader's, c being the exact number
    that a member shares with the leader, and at most least(f_x - c_x, f_y - c_y) are not."""
    common = scored.select("a", "b", "common")
    placed = (led.withColumns({"a": F.least("id", "lead"), "b": F.greatest("id", "lead")})
              .join(common, ["a", "b"], "left")
              .join(root.toDF("id", "r"), "id", "left").join(root.toDF("lead", "lr"), "lead", "left")
              .withColumn("open", F.expr("r IS NULL OR lr IS NULL OR r <> lr"))
              .select("v", "id", "lead", "n", "common", F.coalesce("r", "id").alias("r"), "open"))
    unsure = placed.filter("open").select("v").distinct()
    placed = materialize(placed.join(unsure, "v"), "placed")
    ids = placed.select(F.col("id").alias("doc_id")).union(placed.select("lead")).distinct()
    lone = (sets.join(ids, "doc_id").select("doc_id", F.explode("shingles").alias("s"))
            .groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("id")).filter("c = 1")
            .groupBy("id").agg(F.count(F.lit(1)).alias("lone")))
    able = (placed.join(lone, "id", "left").withColumn("f", F.col("n") - F.coalesce("lone", F.lit(0))).drop("lone")
            .filter(f"{DEN} * f >= {NUM} * n"))
    able = materialize(able, "able")
    least = able.groupBy("v").agg(F.min("n").alias("least_n"), F.max("open").alias("open_left")).filter("open_left")
    able = able.join(least, "v").filter(f"{DEN} * f >= {NUM} * (n + least_n - f)")
    # without an exact count (the sketches excluded the leader) the second bound is f itself
    able = able.select("v", "id", "n", "r", "open", "f", F.coalesce("common", F.lit(0)).alias("c"))
    able = materialize(able, "able-pairs")
    loose = able.filter("open").select("v", F.col("id").alias("x"), F.col("n").alias("xn"), F.col("r").alias("xr"),
                                       F.col("f").alias("xf"), F.col("c").alias("xc"))
    shared = "least(f, xf, least(c, xc) + least(f - c, xf - xc))"
    shared = f"if(c = 0 OR xc = 0, least(f, xf), {shared})"
    may = F.expr(f"{DEN} * {shared} >= {NUM} * (n + xn - {shared})")
    return (loose.join(able, "v").filter(F.expr("x <> id AND xr <> r AND (NOT open OR x < id)")).filter(may)
            .select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, n_copies
    (documents with the same shingle set, itself included)."""
    prof = profiles(docs)
    root = components(link_classes(docs, prof))
    named = prof.filter("n > 0 AND doc_id IS NOT NULL")
    by_set = (named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies")))
    classes = (by_set.join(root.toDF("rep", "root"), "rep", "left")
               .select("digest", F.coalesce("root", "rep").alias("root"), "copies"))
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return (prof.select("doc_id", "n", "digest").join(classes, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                    F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"),
                    F.when(F.col("doc_id").isNotNull() | (F.col("n") == 0), F.coalesce("copies", F.lit(1)))
                    .otherwise(F.lit(1)).alias("n_copies")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Documents with one document of each group left; repeated rows of a kept
    doc_id are one document, of which one row stays; null ids all stay."""
    gone = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
    once = kept.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return once.unionByName(kept.filter(F.col("doc_id").isNull()))
