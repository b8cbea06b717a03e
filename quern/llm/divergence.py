"""Which sources of a language differ, and by which terms: sketch-prefiltered counting and sparse pair joins.

Terms are runs of ASCII letters and of characters beyond ASCII, after lower-casing A-Z. A language keeps the
terms that at least LEAST_DOCUMENTS of its documents have.

1. Sketch. Every task counts documents by (language, term) in a count-min sketch of DEPTH rows; the sketches are added up,
   block by block. A cell never shows less than what fell into it, so a term whose smallest cell is under
   LEAST_DOCUMENTS can't be kept. Cells stop at 255, which changes nothing below that.
2. Counting. Texts are read once more; terms that the sketch rules out are discarded before anything is shuffled.
   What is left is counted exactly by (language, source, term), first in each batch, and kept or not by exact numbers of documents.
3. Pairs. A term that a source has never used has one and the same share p0 in it, so two sources' distance is

       G(a, p0 of b) + G(b, p0 of a) + (V - n(a) - n(b)) * |p0 of a - p0 of b| + a correction for each term that both have,

   with G(a, x) the sum of |p - x| over the n(a) terms that a has. Only terms that both have are joined. G is a running sum
   over the source's distinct shares, which are far fewer than its terms.

Exactness. Terms are compared as bytes; only the sketch hashes. Shares are integers, by decimal division.

Scale. A sketch has one byte for each of at most MOST_CELLS cells, so what is broadcast is bounded, whatever the corpus; how many
cells there are follows the size of the input's files. Where there are more terms than cells, fewer terms are ruled out,
and results are the same. Blocks of the sketch are added up in a stream of one block after another, not held as a group.
Sources and languages may be as many as there are documents: what is joined by them is shuffled. The pairs themselves are the square of a
language's sources, as every source's distance to each other is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import file_bytes, in_slices, pick, small_batches, stored, table

LEAST_DOCUMENTS = 30
#: A share is one more than the floor of this many parts of (count + SMOOTH) / (all + SMOOTH * V).
PARTS, SMOOTH = 1_000_000_000, 5
MOST_TERMS = 50
#: The sketch: its rows, the cells of one (a power of two), and the cells that are sent together.
DEPTH, LEAST_CELLS, MOST_CELLS, BLOCK = 4, 1 << 18, 1 << 22, 1 << 16
#: Bytes of the input's files for each cell of a row.
BYTES_PER_CELL = 256
#: Bytes of text that are counted at once.
LUMP = 6 << 20
#: Parts of a key that many rows may have.
SALTS = 16

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"

#: ASCII other than letters.
_GAP = np.zeros(256, bool)
for _span in ((0, 65), (91, 97), (123, 128)):
    _GAP[slice(*_span)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Terms:
    """The terms of texts: distinct ones as an array of strings, and the number and the document of each place."""

    def __init__(self, texts: pa.Array) -> None:
        binary = pc.fill_null(texts.cast(pa.binary()), b"")
        lengths = pc.binary_length(binary).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = _LOWER[np.frombuffer(b"\n".join(binary.to_pylist()) + b"\n", np.uint8)]
        inside = ~_GAP[raw]
        # A text ends with a gap, and so do all together.
        edges = np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32) + 1
        edges = np.concatenate([np.zeros(1, np.int32), edges]) if inside[0] else edges
        starts, sizes = edges[0::2], edges[1::2] - edges[0::2]
        offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
        each = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
        del raw, inside, sizes
        coded = each.dictionary_encode()
        self.distinct, self.number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        ends = np.searchsorted(starts, np.cumsum(lengths + 1))
        self.document = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
        self.many = max(1, len(self.distinct))

    def by_document(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of (document, term) pairs, as document * many + term, and how often each is there."""
        return np.unique(self.document * np.int64(self.many) + self.number, return_counts=True)


def _tally(keys: np.ndarray, size: int, *weights: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Distinct keys, of size possible ones, and of each the sums of weights (None: 1 each)."""
    if size <= 1 << 21:
        at = np.flatnonzero(np.bincount(keys, minlength=size))
        return at, *(np.bincount(keys, w, size)[at].astype(np.int64) for w in weights)
    at, where = np.unique(keys, return_inverse=True)
    return at, *(np.bincount(where, w, len(at)).astype(np.int64) for w in weights)


def _codes(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values of a string column, null as empty, and each row's number among them."""
    coded = pc.fill_null(column.cast(pa.string()), "").dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _lumps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut to LUMP bytes of text or so: many documents share their terms."""
    held, size = [], 0
    for batch in in_slices(batches, "text", LUMP):
        own = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if held and size + own > LUMP:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _cells(langs: pa.Array, terms: Terms, pairs: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each pair in each row of the sketch."""
    many = terms.many
    names, words = [f"{x}\0".encode() for x in langs.to_pylist()], terms.distinct.to_pylist()
    h = np.fromiter((xxhash.xxh3_64_intdigest(names[i] + words[j]) for i, j in zip((pairs // many).tolist(), (pairs % many).tolist())), np.uint64, len(pairs))
    # Rows of the sketch by double hashing.
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(k) * high) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - cells.bit_length()) for k in range(DEPTH)]).astype(np.int64)


def sketch_cells(df: DataFrame) -> int:
    """Cells of a row, by the size of the files that df is read from."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (file_bytes(df) // BYTES_PER_CELL).bit_length()))


def document_sketch(docs: DataFrame, cells: int) -> np.ndarray:
    """A count-min sketch of how many documents of docs (text, lang) have each term of each language: DEPTH rows of cells, up to 255."""

    size = min(BLOCK, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((DEPTH, cells), np.uint8)
        for batch in _lumps(batches):
            terms, (langs, lang) = Terms(batch.column("text")), _codes(batch.column("lang"))
            once, _ = terms.by_document()
            pairs, n = _tally(lang[once // terms.many] * terms.many + once % terms.many, len(langs) * terms.many, None)
            for row, at in zip(held, _cells(langs, terms, pairs, cells)):
                touched, where = np.unique(at, return_inverse=True)
                row[touched] = np.minimum(row[touched] + np.bincount(where, n).astype(np.int64), 255)
        for i, block in enumerate(held.reshape(-1, size)):
            if block.any():
                yield pa.record_batch({"block": [i], "counts": [block.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for i, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                new = np.frombuffer(counts, np.uint8).astype(np.uint16)
                if at is not None and at != i:
                    yield pa.record_batch({"block": [at], "counts": [total.astype(np.uint8).tobytes()]})
                    at = None
                total, at = new if at is None else np.minimum(total + new, 255), i
        if at is not None:
            yield pa.record_batch({"block": [at], "counts": [total.astype(np.uint8).tobytes()]})

    kind = "block bigint, counts binary"
    parts = docs.select("text", "lang").mapInArrow(count, kind)
    out = np.zeros((DEPTH * cells // size, size), np.uint8)
    merged = parts.repartition(min(len(out), 64), "block").sortWithinPartitions("block").mapInArrow(add, kind)
    # As many bytes as the sketch has cells.
    for r in merged.toLocalIterator():
        out[r.block] = np.frombuffer(r.counts, np.uint8)
    return out.reshape(DEPTH, cells)


def term_counts(docs: DataFrame, sketch: np.ndarray, least: int) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term that the sketch doesn't rule out, and a row without a term for each language and source; in parts, to be added up."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in _lumps(batches):
            terms, (langs, lang), (sources, source) = Terms(batch.column("text")), _codes(batch.column("lang")), _codes(batch.column("source"))
            many, groups = terms.many, lang * len(sources) + source
            once, times = terms.by_document()
            document, term = once // many, once % many
            (pairs,) = _tally(lang[document] * many + term, len(langs) * many)
            estimate = np.min([row[at] for row, at in zip(sketch, _cells(langs, terms, pairs, sketch.shape[1]))], 0) if len(pairs) else np.empty(0)
            kept = pairs[estimate >= min(least, 255)]
            there = np.unique(groups)
            possible = np.isin(lang[document] * many + term, kept)
            document, term, times = document[possible], term[possible], times[possible]
            own, n, in_docs = _tally(groups[document] * many + term, len(langs) * len(sources) * many, times, None)
            every = np.concatenate([own // many, there])
            yield pa.record_batch(
                {
                    "lang": langs.take(pa.array(every // len(sources))),
                    "source": sources.take(pa.array(every % len(sources))),
                    "term": pa.concat_arrays([terms.distinct.take(pa.array(own % many)).cast(pa.binary()).cast(pa.string()), pa.nulls(len(there), pa.string())]),
                    "n": pa.array(np.concatenate([n, 0 * there]).astype(np.int64)),
                    "docs": pa.array(np.concatenate([in_docs, 0 * there]).astype(np.int64)),
                }
            )

    return docs.select("text", "lang", "source").mapInArrow(run, _COUNTS)


def _share(n: Column, every: Column, kept: Column) -> Column:
    whole = lambda c: c.cast("decimal(20,0)")
    parts = F.lit(PARTS).cast("decimal(10,0)") * (whole(n) + SMOOTH)
    return F.call_function("div", parts, whole(every) + SMOOTH * whole(kept)) + 1


def _kept(df: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored: groups (lang, source, v: kept terms of the language, p0, nz: kept terms that the group has), their terms (lang, source, term, p) and those of languages (lang, term, q)."""
    rows = stored(term_counts(df, document_sketch(df, sketch_cells(df)), least).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    counts = rows.where("term is not null")
    terms = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term", "all"), "kept-terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("every"))
    own = counts.join(terms, ["lang", "term"], "left_semi").select("lang", "source", "term", "n")
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count("*").alias("nz"))
    zero = F.lit(0).cast("long")
    groups = rows.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("own", "nz", "v")))
    p0 = F.when(F.col("v") > 0, _share(F.lit(0), F.col("own"), F.col("v"))).otherwise(0)
    groups = stored(groups.withColumn("p0", p0), "groups")
    q = terms.join(langs, "lang").select("lang", "term", _share(F.col("all"), F.col("every"), F.col("v")).alias("q"))
    shares = own.join(groups, ["lang", "source"]).select("lang", "source", "term", _share(F.col("n"), F.col("own"), F.col("v")).alias("p"), "p0")
    return groups, stored(shares, "shares"), q


def _pairs(groups: DataFrame) -> DataFrame:
    """Every ordered pair of two sources of a language, as is asked for: (lang, source, item, p0, other0, nz, other_nz, v). Spread over SALTS parts of a language."""
    a = groups.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)).cast("int"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("other0"), F.col("nz").alias("other_nz"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return a.join(b, ["lang", "salt"]).where("source != item").drop("salt", "own")


def _to_others(shares: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, source, x, g): the sum of |p - x| over the terms that a source has, for each x that is another source's p0."""
    steps = shares.groupBy("lang", "source", F.col("p").alias("at")).agg(F.count("*").alias("m")).withColumn("asked", F.lit(False))
    asked = pairs.select("lang", "source", F.col("other0").alias("at")).distinct().select("lang", "source", "at", F.lit(0).cast("long").alias("m"), F.lit(True).alias("asked"))
    w = Window.partitionBy("lang", "source")
    upto = w.orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    both = steps.unionByName(asked).withColumn("sum", F.col("m") * F.col("at"))
    for c in ("m", "sum"):
        both = both.withColumn(f"{c}_all", F.sum(c).over(w)).withColumn(f"{c}_upto", F.sum(c).over(upto))
    g = F.col("at") * F.col("m_upto") - F.col("sum_upto") + (F.col("sum_all") - F.col("sum_upto")) - F.col("at") * (F.col("m_all") - F.col("m_upto"))
    return both.where("asked").select("lang", "source", F.col("at").alias("x"), g.alias("g"))


def source_distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum of |p - q| over all kept terms of the language, for each other source."""
    pairs = stored(_pairs(groups), "pairs")
    to = stored(_to_others(shares, pairs), "to-others")
    a = shares.select("lang", "term", "source", "p", "p0")
    b = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("other"), F.col("p0").alias("other0"))
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "other", "other0"))
    correction = F.sum(F.abs(p - q) - F.abs(p - q0) - F.abs(p0 - q) + F.abs(p0 - q0)).alias("both")
    both = a.join(b, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(correction)
    both = both.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("s"), "both").select("lang", "s.*", "both")
    own = to.select("lang", "source", F.col("x").alias("other0"), F.col("g").alias("g1"))
    theirs = to.select("lang", F.col("source").alias("item"), F.col("x").alias("p0"), F.col("g").alias("g2"))
    found = pairs.join(own, ["lang", "source", "other0"], "left").join(theirs, ["lang", "item", "p0"], "left").join(both, ["lang", "source", "item"], "left")
    zero = F.lit(0).cast("long")
    rest = (F.col("v") - F.col("nz") - F.col("other_nz")) * F.abs(F.col("p0") - F.col("other0"))
    return found.select("lang", "source", "item", F.when(F.col("v") > 0, F.coalesce("g1", zero) + F.coalesce("g2", zero) + F.coalesce("both", zero) + rest).otherwise(0).cast("long").alias("value"))


def telling_terms(shares: DataFrame, q: DataFrame, most: int = MOST_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms whose share in a source exceeds that in its language most."""
    found = shares.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return found.withColumn("rank", _rank()).where(F.col("rank") <= most)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = MOST_TERMS) -> DataFrame:
    """Sources of docs (text, lang, source) against each other and against their language: lang, source, part, item, value, rank.

    Part pair: item is each other source of the language, value the sum of the differences of the two sources' shares over all
    kept terms, 0 if there are none. Part term: item is a kept term whose share in the source exceeds that in the language by value; the
    most_terms largest. Ranks are from 1 within source and part, larger values first, then by the item's bytes. Null text, lang
    and source are empty ones. A source alone in its language has no pair. Rows that repeat are documents each. An empty table
    gives no rows; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    d = pick(docs, "text", "lang", "source")
    d = d.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in d.columns))
    groups, shares, q = _kept(d, least_documents)
    pairs = source_distances(groups, shares).withColumn("rank", _rank())
    both = (("pair", pairs), ("term", telling_terms(shares, q, most_terms)))
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in both]
    return out[0].unionByName(out[1])


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents
), t as (select r, lang, source, unnest(w) as term from d
), k as (select lang, term, count(*) as n from t group by 1, 2 having count(distinct r) >= {LEAST_DOCUMENTS}
), v as (select lang, count(*) as v, sum(n) as n from k group by 1
), g as (select distinct lang, source from d
), c as (select lang, source, term, count(*) as n from t group by 1, 2, 3
), f as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
), s as (select *, sum(n) over (partition by lang, source) as own from f
), p as (
  select s.lang, s.source, s.term, s.n, 1 + cast({PARTS} as hugeint) * (s.n + {SMOOTH}) // cast(s.own + {SMOOTH} * v.v as hugeint) as p,
         1 + cast({PARTS} as hugeint) * (k.n + {SMOOTH}) // cast(v.n + {SMOOTH} * v.v as hugeint) as q
  from s join v using (lang) join k on k.lang = s.lang and k.term = s.term
), x as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(sum(abs(a.p - b.p)) as bigint) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source != b.source group by 1, 2, 4
  union all select a.lang, a.source, 'pair', b.source, 0 from g a join g b on a.lang = b.lang and a.source != b.source where a.lang not in (select lang from v)
  union all select lang, source, 'term', term, cast(p - q as bigint) from p where n > 0 and p > q
)
select * from (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from x) where part = 'pair' or rank <= {MOST_TERMS}
"""
