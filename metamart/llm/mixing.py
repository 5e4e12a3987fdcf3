"""Mixing sources to target weights by proportionate-fair scheduling (op3, native).

The documents of a source, in the order of md5(doc_id), form blocks of
``BLOCK_DOCS``.  Time is slots of one block.  In the ideal mix all sources that
still have blocks advance at once, each in proportion to its target weight: at
virtual time v source s has had min(blocks, w v), and C(v), the sum over the
sources, is the slot.  C is concave and piecewise linear, one piece for every
time at which sources run out.  Block j of s must be served inside
[floor(C(j / w)), ceil(C((j + 1) / w))); in every slot the earliest deadline
among the released blocks is served (ties: the source's name).  The ideal mix
shows that all deadlines can be met, so at any slot each source is less than one
block away from its share by the given weights, over the whole timeline.

Scale.  The timeline is cut into segments.  Each first runs alone on the blocks
released in it, which tells the blocks that must be done in it, those done in it
whose deadline lies behind it, and those left.  A fold over these summaries (at
most one block a source each) gives the blocks that every segment inherits: of
the inherited and the optional blocks, the earliest deadlines fill the free
slots, the others move on.  Then every segment runs again with what it inherits,
which is the one schedule of the whole timeline.  Both runs are parallel; the fold is too,
by groups of ``GROUP`` segments, and only the groups' summaries meet in one row.
The work is slots x sources; a step that changes a source costs the pieces of C.

Main path: DataFrame functions only.  Row numbers come from counts per (source,
md5 prefix) plus a window inside one prefix, so a source that holds a third of
all rows is spread over many tasks.  Windows are exact whole-number fractions;
weights are whole numbers of 1e-12 of the largest one.

Defined results: a null source is a source of its own; sources without a given
weight, or with a null, non-finite or non-positive one, get the smallest share (1e-12 of the largest
weight: about one block, the others follow when the weighted sources have run out);
without any weights a source's weight is the square root of its documents;
repeated rows of a doc_id are one document of the smallest of their sources; null
doc_ids are not scheduled: ``schedule`` leaves them out, ``mixed`` puts them last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metamart.llm.common import materialize

BLOCK_DOCS = 8
SEGMENT = 256
GROUP = 256
CHUNK_ROWS = 20_000


def _sources(ids: DataFrame, weights: DataFrame | None, block_docs: int) -> DataFrame:
    """(src, s: number in name order, docs, blocks, w) of every source."""
    rows = ids.groupBy("src").agg(F.count(F.lit(1)).alias("docs"))
    if weights is None:       # square root of the size: between natural and uniform
        rows = rows.withColumn("w", F.expr("cast(round(sqrt(docs) * 1e6) AS long)"))
    else:
        given = (weights.select(_src(F.col("source")).alias("src"), F.col("weight").cast("double").alias("weight"))
                 .filter("weight > 0 AND weight < double('infinity')").groupBy("src").agg(F.sum("weight").alias("weight")))
        rows = (rows.join(given, "src", "left")
                .withColumn("most", F.max("weight").over(Window.partitionBy()))      # one row per source
                .withColumn("w", F.expr("greatest(1L, coalesce(cast(round(weight / most * 1e12) AS long), 1L))")))
    return rows.select("src", (F.row_number().over(Window.orderBy("src")) - 1).alias("s"), "docs",
                       F.expr(f"(docs + {block_docs - 1}) DIV {block_docs}").alias("blocks"),
                       F.col("w").cast("decimal(18,0)").alias("w"))


def _src(source):
    """Sources as strings that keep null apart from every name."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _pieces(sources: DataFrame) -> DataFrame:
    """(b, a, vb, vw): from virtual time vb / vw on, C(v) = b + a v."""
    times = (sources.withColumn("v0", F.expr("blocks DIV w")).withColumn("r0", F.expr("blocks % w"))
             .withColumn("v1", F.expr("(r0 * 1000000000000000000BD) DIV w"))
             .withColumn("r1", F.expr("(r0 * 1000000000000000000BD) % w"))
             .withColumn("v2", F.expr("(r1 * 1000000000000000000BD) DIV w"))     # 36 digits tell all fractions apart
             .groupBy("v0", "v1", "v2")
             .agg(F.min(F.struct("w", "blocks")).alias("at"), F.sum("blocks").alias("blocks"), F.sum("w").alias("w")))
    upto = Window.orderBy("v0", "v1", "v2")        # at most one row per source
    ends = times.select(F.sum("blocks").over(upto).alias("b"),
                        (F.sum("w").over(Window.partitionBy()) - F.sum("w").over(upto)).cast("decimal(20,0)").alias("a"),
                        F.col("at.blocks").alias("vb"), F.col("at.w").alias("vw"))
    start = sources.agg(F.lit(0).cast("long").alias("b"), F.sum("w").cast("decimal(20,0)").alias("a"),
                        F.lit(0).cast("long").alias("vb"), F.lit(1).cast("decimal(18,0)").alias("vw"))
    return start.unionByName(ends).filter("a > 0")


# block j of source x = all[i]; a source without further blocks is never released
_JOB = """named_struct(
    'dl', array_min(transform(pieces, c -> c.b + (c.a * cast({j} + 1 AS decimal(17,0)) + {x}.w - 1) DIV {x}.w)),
    's', {x}.s,
    'rel', if({j} < {x}.blocks,
              array_min(transform(pieces, c -> c.b + (c.a * cast({j} AS decimal(17,0))) DIV {x}.w)), 9000000000000000000L),
    'j', {j})"""
_JOB_TYPE = "struct<dl:bigint,s:int,rel:bigint,j:bigint>"


# blocks of every source that the ideal mix has begun before the segment
_BEGUN = """transform(
    array(element_at(filter(pieces, c -> cast(t0 - c.b AS decimal(18,0)) * c.vw >= c.a * cast(c.vb AS decimal(17,0))), -1)),
    at -> transform(all, x -> least(x.blocks, (cast(t0 - at.b AS decimal(18,0)) * x.w + at.a - 1) DIV at.a)))[0]"""


def _run(owed: str) -> str:
    """Earliest deadline first over the slots of a segment, with the blocks of
    sources ``owed`` inherited.  A slot with nothing released is null.  (A
    one-element array is evaluated once; a column would be in every lambda call.)"""
    first = "(k.begun[x.s] - if(array_contains(k.owed, x.s), 1L, 0L))"
    return f"""
        transform(array(named_struct('begun', {_BEGUN}, 'owed', {owed})), k -> aggregate(
          sequence(t0, t1 - 1),
          named_struct('next', transform(all, x -> {_JOB.format(x='x', j=first)}),
                       'out', cast(array() AS array<{_JOB_TYPE}>)),
          (acc, t) -> transform(
            array(array_min(filter(acc.next, n -> n.rel <= t))),
            p -> named_struct(
              'next', if(p IS NULL, acc.next, transform(acc.next, (n, i) -> if(n.s = p.s, {_JOB.format(x='all[i]', j='(n.j + 1L)')}, n))),
              'out', concat(acc.out, array(p))))[0]))[0]"""


# what a row of segments leaves undone, before each of them
_BEFORE = """aggregate({nodes}, named_struct('late', {late}, 'out', cast(array() AS array<array<struct<dl:bigint,s:int>>>)),
    (acc, n) -> transform(
      array(array_sort(concat(acc.late, n.opt))),
      pool -> named_struct(
        'late', concat(slice(pool, cast(n.cap AS int) + 1, size(pool)), n.late),
        'out', concat(acc.out, array(acc.late))))[0],
    acc -> acc.out)"""

# one summary of a row of segments
_MERGE = """aggregate(slice(nodes, 2, size(nodes)), nodes[0],
    (l, n) -> transform(
      array(array_sort(concat(l.late, n.opt))),
      pool -> named_struct(
        'p', n.p, 't0', l.t0, 't1', n.t1,
        'cap', l.cap + n.cap - size(filter(concat(l.opt, l.late), x -> x.dl <= n.t1)),
        'opt', filter(concat(l.opt, slice(pool, 1, cast(n.cap AS int))), x -> x.dl > n.t1),
        'late', concat(slice(pool, cast(n.cap AS int) + 1, size(pool)), n.late)))[0])"""


def schedules(spark: SparkSession, sources: DataFrame, segment: int = SEGMENT, group: int = GROUP) -> DataFrame:
    """(s, block, slot, release, deadline): one row per block of every source."""
    every = sources.agg(F.array_sort(F.collect_list(F.struct("s", "w", "blocks")))).scalar()   # one entry a source
    # pieces in the order of their times; b grows with them
    pieces = _pieces(sources).agg(F.array_sort(F.collect_list(F.struct("b", "a", "vb", "vw")))).scalar()
    slots, names = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count(F.lit(1))).first()
    length = max(segment, names)
    rows = (spark.range(0, -(-slots // length), 1, max(1, min(-(-slots // (length * 8)), 10_000))).withColumnRenamed("id", "p")
            .withColumn("t0", F.expr(f"p * {length}L")).withColumn("t1", F.expr(f"least(t0 + {length}L, {slots}L)"))
            .withColumn("all", every).withColumn("pieces", pieces))
    alone = (rows.withColumn("r", F.expr(_run("cast(array() AS array<int>)")))
             .select("p", "t0", "t1",
                     F.expr("t1 - t0 - size(filter(r.out, x -> x.dl <= t1))").alias("cap"),
                     F.expr("transform(filter(r.out, x -> x.dl > t1), x -> named_struct('dl', x.dl, 's', x.s))").alias("opt"),
                     F.expr("transform(filter(r.next, x -> x.rel < t1), x -> named_struct('dl', x.dl, 's', x.s))").alias("late")))
    node = F.struct("p", "t0", "t1", "cap", "opt", "late")
    groups = materialize(alone.withColumn("g", F.expr(f"p DIV {group}")).groupBy("g")
                         .agg(F.array_sort(F.collect_list(node)).alias("nodes")), "mix-segments")
    merged = groups.select("g", F.expr(_MERGE).alias("n"))
    none = "cast(array() AS array<struct<dl:bigint,s:int>>)"
    tops = (merged.agg(F.array_sort(F.collect_list("n")).alias("nodes"))        # one entry a group
            .select(F.posexplode(F.expr(_BEFORE.format(nodes="nodes", late=none))).alias("g", "late0")))
    inherited = (groups.join(tops.withColumn("g", F.col("g").cast("long")), "g")
                 .select("g", F.posexplode(F.expr(_BEFORE.format(nodes="nodes", late="late0"))).alias("i", "late"))
                 .select(F.expr(f"g * {group} + i").alias("p"), "late"))
    inherited = materialize(inherited, "mix-inherited")
    return (rows.join(inherited, "p")
            .withColumn("r", F.expr(_run("transform(late, x -> x.s)")))
            .select("t0", F.posexplode("r.out").alias("t", "x"))
            .select("x.s", F.col("x.j").alias("block"), (F.col("t0") + F.col("t")).alias("slot"),
                    F.col("x.rel").alias("release"), F.col("x.dl").alias("deadline")))


def schedule(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS,
             segment: int = SEGMENT) -> DataFrame:
    """One row per document: doc_id, source, block (of the source), slot,
    release and deadline (of the block, in slots), position (in the mix)."""
    ids = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _src(F.col("source")).alias("src"))
           .filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("src").alias("src")))
    ids = materialize(ids.withColumn("h", F.md5(F.col("doc_id").cast("string").cast("binary"))), "mix-ids")
    n, digits = ids.count(), 1
    while n > CHUNK_ROWS * 16 ** digits:
        digits += 1
    ids = ids.withColumn("chunk", F.substring("h", 1, digits))
    sources = materialize(_sources(ids, weights, block_docs), "mix-sources")
    plan = materialize(schedules(docs.sparkSession, sources, segment), "mix-plan")

    before = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ids.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("c"))
               .select("src", "chunk", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
               .join(sources.select("src", "s"), "src"))
    inside = Window.partitionBy("src", "chunk").orderBy("h", "doc_id")
    placed = (ids.withColumn("r", F.row_number().over(inside) - 1).join(offsets, ["src", "chunk"])
              .withColumn("rank", F.col("before") + F.col("r"))
              .withColumn("block", F.expr(f"rank DIV {block_docs}")))
    out = (placed.join(plan, ["s", "block"])
           .select("doc_id", F.expr("if(src = '', NULL, substr(src, 2))").alias("source"), "block",
                   "slot", "release", "deadline", F.expr(f"rank % {block_docs}").alias("within")))
    # the last block of a source may be short: position is the place in whole blocks, so it may skip numbers
    return out.withColumn("position", F.expr(f"slot * {block_docs} + within")).drop("within")


def mixed(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS,
          segment: int = SEGMENT) -> DataFrame:
    """All documents (all columns) in the order of the mix: partitions and rows
    within them ascend; rows without a doc_id come last."""
    plan = materialize(schedule(docs, weights, block_docs, segment)
                       .select(F.col("doc_id").alias("_mix_id"), F.col("position").alias("_mix_at")), "mix-positions")
    named = docs.filter(F.col("doc_id").isNotNull())
    placed = (named.join(plan, named["doc_id"].cast("long") == plan["_mix_id"])
              .unionByName(docs.filter(F.col("doc_id").isNull())
                           .withColumns({"_mix_id": F.lit(None).cast("long"), "_mix_at": F.lit(2**63 - 1).cast("long")})))
    return (placed.repartitionByRange("_mix_at", "_mix_id").sortWithinPartitions("_mix_at", "_mix_id")
            .select(*docs.columns))
