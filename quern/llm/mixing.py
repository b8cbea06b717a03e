"""Mixing sources to target weights along a low-discrepancy schedule, in DataFrame operations only.

The mix is a row of slots, each of BLOCK_WORDS words. Slot t maps the golden-ratio point
frac(t * phi) through the cumulative target weights to a source, so that every prefix of the mix, not
only its whole, is near the weights. Slots are ranked within their source, and rank r takes block r of
that source: its documents in a seeded random order, end to end and again from the start after the
last, cut into blocks of equal numbers of words.

Scale. Nothing is keyed by source alone where rows are many: places in a source's order and ranks of
slots are running sums in two levels, over small buckets and then within a bucket, so a source
with a third of all rows is spread over many tasks. Slots meet blocks by (source, block number). The
cumulative weights are cut into cells, so a point finds its source by an equi-join, not a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import pick, stored, table

BLOCK_WORDS = 64
#: Of the seeded order of a source's documents.
SEED = "mix-1"
#: Documents in a bucket of a source's order, about.
BUCKET_ROWS = 4096
#: Slots that are ranked together.
CHUNK_SLOTS = 1 << 16
#: A source is repeated so many times at most.
MOST_TIMES = 3
#: The golden ratio's fractional part, and that of 2**20 times it.
PHI = 0.6180339887498949
PHI_20 = 648055.9997461303 % 1


def word_count(text: Column) -> Column:
    """Number of runs of other than U+0020 and U+0009 to U+000D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, k, weight, target).

    Sources by code point, null last, weigh 1, 2, 3, repeating. The targets sum to all sizes; none is
    above MOST_TIMES its source's size: what is over goes to the others by weight. That fixed point
    is min(limit, level * weight), with the level found from sources in the order of limit / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("k", F.row_number().over(order)).withColumn("weight", ((F.col("k") - 1) % 3 + 1).cast("long"))
    w = w.withColumn("limit", MOST_TIMES * F.col("source_size"))
    by = Window.orderBy((F.col("limit") / F.col("weight")).asc(), "k")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (
        w.withColumn("all", F.sum("source_size").over(every))
        .withColumn("filled", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("all") - F.col("filled")) / F.col("open"))
        # The level is the first at which the source next in line isn't full yet.
        .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), F.col("k"), F.col("level").alias("level")))).over(every)["level"])
    )
    return w.select("source", "source_size", "k", "weight", F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _shuffled(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """Each document's place in its source: (k, bucket, n) names it; off is the words of the source before it."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED)))
    d = docs.withColumn("key", key).join(per_source.select(F.col("source").alias("s"), "k", "docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    d = d.withColumn("bucket", F.floor(place * F.ceil(F.col("docs") / BUCKET_ROWS)).cast("long"))
    sums = d.groupBy("k", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("k").alias("bk"), F.col("bucket").alias("bb"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("k", "bucket").orderBy("key", "doc_id", "size")
    d = d.withColumn("n", F.row_number().over(inside)).withColumn("inner", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return d.join(sums, (F.col("k") == F.col("bk")) & (F.col("bucket") == F.col("bb"))).select("doc_id", "source", "size", "k", "bucket", "n", (F.col("base") + F.col("inner")).alias("off"))


def _slots(targets: DataFrame, n_slots: int, n_sources: int) -> DataFrame:
    """(slot, k, rank): the source of each slot, and its rank among that source's slots."""
    cells = max(4096, 4 * n_sources)
    run = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = targets.where("target > 0").withColumn("upto", F.sum("target").over(run)).withColumn("all", F.sum("target").over(every))
    w = w.select("k", ((F.col("upto") - F.col("target")) / F.col("all")).alias("lo"), (F.col("upto") / F.col("all")).alias("hi"), F.max("k").over(every).alias("last"))
    # One chain of bounds: each source starts where the one before ends, and the last ends at 1.
    w = w.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("k")), F.lit(0.0))).withColumn("hi", F.when(F.col("k") == F.col("last"), F.lit(1.0)).otherwise(F.col("hi")))
    bounds = w.select("k", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))).alias("cell"))
    spark = targets.sparkSession
    point = ((F.shiftright("slot", 20) * PHI_20) + F.col("slot").bitwiseAND((1 << 20) - 1) * PHI) % 1
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("u", point).withColumn("cell", F.floor(F.col("u") * cells))
    drawn = slots.join(bounds, "cell").where("u >= lo and u < hi").select("slot", "k", F.shiftright("slot", CHUNK_SLOTS.bit_length() - 1).alias("chunk"))
    counts = drawn.groupBy("k", "chunk").agg(F.count("*").alias("slots"))
    before = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("k").alias("ck"), F.col("chunk").alias("cc"), F.coalesce(F.sum("slots").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("k", "chunk").orderBy("slot")
    ranked = drawn.withColumn("inner", F.row_number().over(inside) - 1)
    return ranked.join(counts, (F.col("k") == F.col("ck")) & (F.col("chunk") == F.col("cc"))).select("slot", "k", (F.col("base") + F.col("inner")).alias("block"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix's pieces and its documents: one row for each document and slot that takes from it.

    docs: doc_id, text, source. Columns: doc_id, source, size (words), source_size, target, k, bucket,
    n (these three name the document), slot, words (that the slot takes of it, in which pass: passed).
    A document that no slot takes has one row with a null slot and 0 words; so has one without words
    (a null text has none). A null source is a source of its own, the last one. Rows that repeat are
    documents of their own; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    d = stored(pick(docs, "doc_id", "text", "source").select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = stored(source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size"))).join(d.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("docs")), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-sources")
    every, n = sources.agg(F.sum("source_size"), F.count("*")).first()
    slots = _slots(sources, -(-(every or 0) // block_words), n)
    shares = sources.select(F.col("k").alias("sk"), "source_size", "target")
    placed = _shuffled(d, sources).join(shares, F.col("k") == F.col("sk")).drop("sk")
    # A source's pass p starts at p * source_size; passes that its target can't reach aren't laid out.
    passes = F.least(F.lit(MOST_TIMES - 1), F.floor((F.col("target") + 8 * block_words) / F.greatest("source_size", F.lit(1)))).cast("int")
    laid = placed.withColumn("passed", F.explode(F.sequence(F.lit(0), passes))).withColumn("start", F.col("passed") * F.col("source_size") + F.col("off"))
    laid = laid.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))).otherwise(F.array(F.lit(-1).cast("long")))))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest("start", F.col("block") * block_words)
    return laid.join(slots, ["k", "block"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "k", "bucket", "n", "passed", "block", "slot", F.when(F.col("slot").isNotNull(), words).otherwise(F.lit(0)).cast("long").alias("words")
    )


def taken(mixed: DataFrame) -> DataFrame:
    """Of each document: doc_id, source, size, source_size, target, taken."""
    return mixed.groupBy("k", "bucket", "n").agg(*(F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")), F.sum("words").alias("taken")).drop("k", "bucket", "n")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return taken(mix(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = f"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '') || '{SEED}') as key
  from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size, count(*) as docs,
         row_number() over (order by source nulls last) as k from d group by source
), w as (
  select *, (k - 1) % 3 + 1 as weight, {MOST_TIMES} * source_size as lim from s
), f as (
  select *, (sum(source_size) over () - coalesce(sum(lim) over o, 0)) / cast(sum(weight) over () - coalesce(sum(weight) over o, 0) as double) as lv
  from w window o as (order by lim / cast(weight as double), k rows between unbounded preceding and 1 preceding)
), g as (
  select f.*, least(cast(lim as double), (select lv from f where lv * weight <= lim order by lim / cast(weight as double), k limit 1) * weight) as target from f
), c as (
  select *, sum(target) over (order by k rows unbounded preceding) as upto, sum(target) over () as total, max(k) over () as last from g where target > 0
), b as (
  select k, coalesce(lag(upto / total) over (order by k), 0.0) as lo, case when k = last then 1.0 else upto / total end as hi from c
), t as (
  select cast(range as bigint) as slot, ((slot >> 20) * cast({PHI_20!r} as double) + (slot & {(1 << 20) - 1}) * cast({PHI!r} as double)) % 1 as u
  from range((select cast((sum(size) + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} as bigint) from d))
), n as (
  select k, count(*) * {BLOCK_WORDS} as words from t join b on u >= lo and u < hi group by k
), p as (
  select d.*, g.k, g.source_size, g.target,
         sum(size) over (partition by g.k order by key, doc_id, size rows unbounded preceding) - size as off
  from d join g on d.source is not distinct from g.source
)
select doc_id, size, source_size, target,
       cast({" + ".join(f"greatest(0, least({e} * source_size + off + size, coalesce(n.words, 0)) - ({e} * source_size + off))" for e in range(MOST_TIMES))} as bigint) as taken
from p left join n using (k)
"""
