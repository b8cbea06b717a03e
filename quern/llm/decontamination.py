"""Passages of a benchmark inside documents, by winnowing, in DataFrame operations only.

Words are runs of ASCII letters and digits and of characters beyond ASCII, after lower-casing A-Z. A benchmark item's
windows are its runs of WINDOW words, or all its words if it has fewer. A document's word is hit if it is
inside any occurrence of a window.

1. Fingerprints. Every run of GRAM words has a hash; a window's fingerprint is the smallest of the
   WINDOW - GRAM + 1 hashes in it. It depends on the window's words alone, so every span of WINDOW words that a document shares
   with an item has the same fingerprint in both: none is missed. Neighbouring windows mostly have one fingerprint.
2. Fingerprints of documents are joined with those of the benchmark; what is left are places in documents.
3. There, the hit is extended to its words: the words of the window are compared with those of the benchmark's windows, as text.
   Overlapping windows are one span; its words count once.

Items of fewer than WINDOW words have no fingerprint that every document would choose, so runs of just
their number of words are hashed in documents too, one more array for each such length (there are at most WINDOW - 1).

Scale. One narrow pass over all texts, and a second over those texts only that have a place, each text once however many
copies there are. Fingerprints of the benchmark are broadcast up to MOST_BROADCAST of them; with more, documents without any common fingerprint are
found first, by a shuffle of distinct fingerprints, and only the others' places are shuffled. Windows are looked up under
their text, in SALTS parts, so a passage that many documents share is not one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import lower_az, pick, stored, table

WINDOW, GRAM = 10, 5
#: Rows of fixed size (a fingerprint, a text's hash) that are broadcast, at most: some 32 MB.
MOST_BROADCAST = 1 << 18
#: Parts of a key that many rows may have.
SALTS = 16
#: Keys among which documents' own rows are spread; no more than a few, as each is a fingerprint of its own.
SPREAD = 1024

_BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def words_of(text: Column) -> Column:
    """Split, not extracted: the extracting function copies the whole text at each match."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), f"[{_BETWEEN}]+", -1), "")


def _grams(words: Column, n: int) -> Column:
    """Hashes of all runs of n words; n is hashed too, so runs of other lengths have other hashes."""
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(firsts, lambda w, i: F.xxhash64(F.lit(n), w, *(F.get(words, i + k) for k in range(1, n))))


def _least_of_two(array: str, apart: int) -> Column:
    return F.transform(array, lambda x, i: F.least(x, F.get(F.col(array), i + apart)))


def with_fingerprints(df: DataFrame, shorter: list[int]) -> DataFrame:
    """df (with text) and words, prints0 (of each run of WINDOW words, its fingerprint) and prints1 and so on (of each run of as many words as shorter says)."""
    df = df.withColumn("words", words_of(F.col("text")))
    df = df.withColumn("prints0", _grams(F.col("words"), GRAM))
    # Smallest of 1 hash, of 2, 4 and so on: two overlapping runs of the last give any number.
    over, wanted = 1, WINDOW - GRAM + 1
    while over < wanted:
        step = min(over, wanted - over)
        df, over = df.withColumn("prints0", _least_of_two("prints0", step)), over + step
    df = df.withColumn("prints0", F.slice("prints0", F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))))
    for k, n in enumerate(shorter, 1):
        df = df.withColumn(f"prints{k}", _grams(F.col("words"), n))
    return df


def _places(df: DataFrame, shorter: list[int], *keep: str) -> DataFrame:
    """(keep, length, place, fingerprint): a row for each run of WINDOW words, and of as many as shorter says; place counts words from 0."""
    kinds = F.array(*(F.struct(F.lit(n).alias("length"), F.col(f"prints{k}").alias("prints")) for k, n in enumerate([WINDOW, *shorter])))
    each = df.select(*keep, F.explode(kinds).alias("kind")) if shorter else df.select(*keep, F.struct(F.lit(WINDOW).alias("length"), F.col("prints0").alias("prints")).alias("kind"))
    return each.select(*keep, F.col("kind.length").alias("length"), F.posexplode("kind.prints").alias("place", "fingerprint"))


def _run(words: Column, place: Column, length: Column) -> Column:
    """The words of a run as one string: words hold no spaces."""
    return F.array_join(F.slice(words, place + 1, length), " ")


def windows_of(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """The benchmark's distinct windows, stored: (window, fingerprint, items: ids, sorted as strings), and the lengths of windows under WINDOW."""
    items = stored(pick(benchmark, "item_id", "text").withColumn("n", F.size(words_of(F.col("text")))).where("n > 0"), "benchmark-items")
    # At most WINDOW - 1 numbers.
    shorter = [r.n for r in items.where(F.col("n") < WINDOW).select("n").distinct().orderBy("n").collect()]
    found = with_fingerprints(items, shorter)
    found = _places(found, shorter, "item_id", "n", "words").where(F.least("n", F.lit(WINDOW)) == F.col("length"))
    found = found.select(_run(F.col("words"), F.col("place"), F.col("length")).alias("window"), "length", "fingerprint", "item_id")
    return stored(found.groupBy("window", "length", "fingerprint").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")), "benchmark-windows"), shorter


def _text_hash(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _at_places(docs: DataFrame, windows: DataFrame, shorter: list[int]) -> DataFrame:
    """(doc_id, sha, n_words, length, place), stored: a row for each document, whose place is null, and one for each run of it that has a window's fingerprint."""
    own = F.pmod(F.xxhash64("doc_id", "sha"), F.lit(SPREAD))
    prints = windows.select("fingerprint").distinct()
    slim = docs.select("doc_id", "text", _text_hash(F.col("text")).alias("sha"))
    if prints.count() <= MOST_BROADCAST:
        # Documents' own rows go the same way, under fingerprints that are numbers below SPREAD, so that one pass over the texts gives both.
        wanted = F.broadcast(prints.unionByName(docs.sparkSession.range(SPREAD).toDF("fingerprint")).distinct())
        found = with_fingerprints(slim, shorter).withColumn("n_words", F.size("words")).drop("text", "words")
        kinds = [F.struct(F.lit(n).alias("length"), F.col(f"prints{k}").alias("prints")) for k, n in enumerate([WINDOW, *shorter])]
        each = found.select("doc_id", "sha", "n_words", F.explode(F.array(F.struct(F.lit(0).alias("length"), F.array(own).alias("prints")), *kinds)).alias("kind"))
        rows = each.select("doc_id", "sha", "n_words", F.col("kind.length").alias("length"), F.posexplode("kind.prints").alias("place", "fingerprint"))
        rows = rows.join(wanted, "fingerprint", "left_semi").withColumn("place", F.when(F.col("length") > 0, F.col("place")))
        return stored(rows.select("doc_id", "sha", "n_words", "length", "place"), "places")
    found = with_fingerprints(slim, shorter)
    distinct = found.select("sha", F.explode(F.array_distinct(F.flatten(F.array(*(F.col(f"prints{k}") for k in range(1 + len(shorter))))))).alias("fingerprint"))
    some = stored(distinct.join(prints, "fingerprint", "left_semi").select("sha").distinct(), "texts-with-fingerprints")
    places = _places(found.drop("text").join(some, "sha", "left_semi"), shorter, "doc_id", "sha").join(prints, "fingerprint", "left_semi")
    every = slim.select("doc_id", "sha", F.size(words_of(F.col("text"))).alias("n_words"))
    none = F.lit(None).cast("int")
    return stored(every.select("*", F.lit(0).alias("length"), none.alias("place")).unionByName(places.select("doc_id", "sha", none.alias("n_words"), "length", "place")), "places")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit: words inside an occurrence of a window of any item of benchmark (item_id, text). n_items: items of which a window
    occurs; items_sha256: of their ids, sorted as strings and joined with commas. A null or empty text has no words; nor has
    a null or empty item a window. Items that repeat an id are one item; one without an id hits words, but isn't counted or named. Rows that repeat,
    and rows without a doc_id, are documents of their own. An empty benchmark hits nothing; an empty table gives no rows;
    other columns are not looked at.
    """
    windows, shorter = windows_of(benchmark)
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    rows = _at_places(d, windows, shorter)
    # Each text once: the places of one of its documents, whose text is fetched.
    found = rows.where("place is not null").groupBy("sha").agg(F.min("doc_id").alias("first"), F.collect_set(F.struct("length", "place")).alias("at"))
    found = stored(found, "places-of-texts")
    keys = found.select(F.col("first").alias("f"), F.col("sha").alias("s"))
    texts = d.withColumn("sha", _text_hash(F.col("text")))
    if found.count() <= MOST_BROADCAST:
        texts = texts.join(F.broadcast(keys), F.col("doc_id").eqNullSafe(F.col("f")) & (F.col("sha") == F.col("s")), "left_semi")
    at = found.select(F.col("first").alias("f"), F.col("sha").alias("s"), "at")
    texts = texts.join(at, F.col("doc_id").eqNullSafe(F.col("f")) & (F.col("sha") == F.col("s"))).select("sha", words_of(F.col("text")).alias("words"), "at")
    runs = texts.select("sha", "words", F.explode("at").alias("p")).select("sha", F.col("p.length").alias("length"), F.col("p.place").alias("place"), _run(F.col("words"), F.col("p.place"), F.col("p.length")).alias("run"))
    # Windows of one passage mostly have the same items: a set of items is looked at once for each text.
    sets = stored(windows.select("items").distinct().select(F.monotonically_increasing_id().alias("set"), "items"), "item-sets")
    named = windows.join(sets, "items").select(F.col("window").alias("run"), "set")
    hits = stored(_salted(runs, "place").join(_in_salts(named), ["run", "salt"]).select("sha", "place", "length", "set").distinct(), "hits")
    before = Window.partitionBy("sha").orderBy("place", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("place") + F.col("length")
    new = hits.withColumn("new", F.greatest(F.lit(0), end - F.greatest(F.col("place"), F.coalesce(F.max(end).over(before), F.lit(0)))))
    covered = new.groupBy("sha").agg(F.sum("new").alias("n_hit"))
    items = _salted(hits.select("sha", "set").distinct(), "sha").join(_in_salts(sets), ["set", "salt"]).select("sha", F.explode("items").alias("item")).distinct()
    items = items.groupBy("sha").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    result = stored(covered.join(items, "sha", "left"), "contaminated-texts")
    out = _salted(rows.where("place is null").select("doc_id", "sha", "n_words"), "doc_id").join(_in_salts(result), ["sha", "salt"], "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


def _salted(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))


def _in_salts(df: DataFrame) -> DataFrame:
    """Each row once for each salt: the small side of a join whose other side has hot keys."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = f"""
with w as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_BETWEEN}]+') as w from documents
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_BETWEEN}]+') as w from benchmark
), k as (
  select item_id, w, least(len(w), {WINDOW}) as n from i where len(w) > 0
), b as (
  select distinct item_id, n, array_to_string(w[p : p + n - 1], ' ') as run from (select *, unnest(range(1, len(w) - n + 2)) as p from k)
), n as (select distinct n from b
), d as (
  select r, n, p, array_to_string(w[p : p + n - 1], ' ') as run from (select r, n, w, unnest(range(1, len(w) - n + 2)) as p from w, n)
), h as (
  select r, p, d.n, item_id from d join b using (run)
), c as (
  select r, count(*) as n_hit from (select distinct r, unnest(range(p, p + n)) as p from h) group by r
), t as (
  select r, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct r, cast(item_id as varchar) as x from h where item_id is not null) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from w left join c using (r) left join t using (r)
"""
