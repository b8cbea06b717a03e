"""Near-duplicate documents by MinHash, with sequential Bayesian verification.

1. Words are runs of other than white space, after lower-casing A-Z; a document's set is its distinct
   runs of five. Equal texts (by SHA-256) are one class.
2. Each class gets BANDS * ROWS minima. Classes that agree in all rows of a band share a bucket: at the
   threshold a pair shares none with probability (1 - 0.75**ROWS)**BANDS, 2e-5.
3. Candidates' sketches (one byte of each minimum) are compared BATCH minima at a time. After each, a pair
   is dropped if the posterior probability that its similarity reaches the threshold is under MISS.
4. The sets of what is left are compared in full, word by word. Equal sets of unlike texts share all bands,
   and are linked in the same way.

Links join components; see links.py for buckets of any size. Texts are shuffled only for documents that
share a bucket. Equal texts never meet in one task: their class is made by partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import as_bytes, discard, in_slices, lower_az, pick, small_batches, stored, table
from .links import Joined, by_cell, linked_components, with_copies
from .words import Words, mixed, shingles

SHINGLE = 5
#: A pair is linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 40, 5
#: Minima compared between two looks at the posterior, and the chosen probability to miss a pair at each look.
BATCH, MISS = 20, 1e-5
SEED = 42
#: Texts whose signatures a task keeps at hand, in case they come again.
REMEMBERED = 4096

_K = BANDS * ROWS
_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 1 << 32, _K, np.uint32)
_TIMES = _RNG.integers(0, 1 << 31, _K, np.uint32) * np.uint32(2) + np.uint32(1)
#: Hashes that are in the work array at once.
_SPAN = 4096


def minima(hashes: np.ndarray) -> np.ndarray:
    """_K minima of 64-bit hashes, each over another permutation."""
    x, low = (hashes >> np.uint64(32)).astype(np.uint32), np.full(_K, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), _SPAN):
        np.minimum(low, ((x[i : i + _SPAN] ^ _XOR[:, None]) * _TIMES[:, None]).min(1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; bands differ in their keys."""
    key = mixed(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
    for r in low.reshape(BANDS, ROWS).T:
        key = mixed(key ^ (r.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return key


def sketch(low: np.ndarray) -> bytes:
    return ((low * np.uint32(2654435769)) >> np.uint32(24)).astype(np.uint8).tobytes()


@cache
def least_matches(percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """For each number of minima compared (a multiple of BATCH), the fewest matches at which a pair stays.

    The similarity's prior is uniform. Bytes of different minima agree in one case of 256.
    """
    s = (np.arange(1000) + 0.5) / 1000
    q = s + (1 - s) / 256
    over = s >= percent / 100
    out = []
    for n in range(BATCH, _K + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(q) + (n - m) * np.log1p(-np.minimum(q, 1 - 1e-12))
        p = np.exp(log - log.max(1, keepdims=True))
        out.append(int(np.argmax(p[:, over].sum(1) / p.sum(1) >= miss)))
    return np.array(out)


def may_link(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of two arrays of sketches, which stay to the end, and in how many minima they agree."""
    stay, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, few in enumerate(least):
        span = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[stay, span] == b[stay, span]).sum(1)
        keep = matches >= few
        stay, matches = stay[keep], matches[keep]
        if not len(stay):
            break
    return stay, matches


def sizes_allow(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of the distinct shingles of each text."""
    hashes, runs = shingles(Words(texts), SHINGLE)
    return [np.unique(x) for x in np.split(hashes, np.cumsum(runs)[:-1])] if len(texts) else []


def in_common(a: bytes, b: bytes) -> tuple[int, int]:
    """How many shingles two normalised texts share, and how many there are in either. Words are compared, not hashes.

    Runs are named like blocks of exact dedup: words get numbers, distinct pairs of numbers get numbers,
    then pairs of pairs, and those with the fifth word.
    """
    x, y = a.split(), b.split()
    if min(len(x), len(y)) < SHINGLE:
        sizes = [max(1, len(w) - SHINGLE + 1) if w else 0 for w in (x, y)]
        if x and x == y:
            return 1, 1
        return 0, sum(sizes)
    names: dict[bytes, int] = {}
    words = np.fromiter((names.setdefault(w, len(names)) for w in chain(x, y)), np.int64, len(x) + len(y))

    def named(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.unique(p * (int(q.max()) + 1) + q, return_inverse=True)[1]

    two = named(words[:-1], words[1:])
    four = named(two[:-2], two[2:])
    five = named(four[:-1], words[SHINGLE - 1 :])
    own, other = np.unique(five[: len(x) - SHINGLE + 1]), np.unique(five[len(x) :])
    both = len(np.intersect1d(own, other, assume_unique=True))
    return both, len(own) + len(other) - both


def _linked(a: bytes, b: bytes) -> bool:
    both, either = in_common(a, b)
    return both > 0 and 100 * both >= PERCENT * either


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, tuple] = {}
    for batch in in_slices(batches, "text", 1 << 20):
        texts, shas = as_bytes(batch.column("text")), batch.column("sha").to_pylist()
        if len(held) > REMEMBERED:
            held = {}
        # Copies of a text are signed once in a while, not each time.
        new = {sha: i for i, sha in enumerate(shas) if sha not in held}
        for sha, s in zip(new, _sets([texts[i] for i in new.values()])):
            low = minima(s) if len(s) else None
            held[sha] = (len(s), [], b"") if low is None else (len(s), band_keys(low).view(np.int64), sketch(low))
        found = [held[sha] for sha in shas]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "sha": batch.column("sha"),
                "n": pa.array([n for n, *_ in found], pa.int64()),
                "bands": pa.array([x for _, x, _ in found], pa.list_(pa.int64())),
                "sketch": pa.array([x for *_, x in found], pa.binary()),
            }
        )


def _array(column: pa.Array) -> np.ndarray:
    """Sketches of a column as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), _K)


def _probable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least = least_matches()
    for batch in batches:
        at = np.flatnonzero(sizes_allow(batch.column("na").to_numpy(), batch.column("nb").to_numpy()))
        if len(at):
            at = at[may_link(_array(batch.column("ka"))[at], _array(batch.column("kb"))[at], least)[0]]
        yield batch.select(["a", "b", "sa", "sb"]).take(pa.array(at, pa.int64()))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [_linked(ta, tb) for ta, tb in zip(as_bytes(batch.column("ta")), as_bytes(batch.column("tb")))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _candidates(cell: pa.Table) -> pa.RecordBatch:
    """A cell's members to those that have a pair across components that may be a link; strays with the ids they may be linked with.

    A pair is looked at in the first band that it shares, and in no other; of two strays, once.
    """
    least, (ids, component, n, stray, asks) = least_matches(), (cell.column(k).to_numpy() for k in ("id", "component", "size", "stray", "asks"))
    band = cell.column("band")[0].as_py()
    rows = _array(cell.column("sketch").combine_chunks())
    answers, lists = np.flatnonzero(~asks), {}
    own, n_own, stray_own = rows[answers], n[answers], stray[answers]
    for i in np.flatnonzero(asks):
        # The first look is at all, without a copy of them; most end there.
        few = (own[:, :BATCH] == rows[i, :BATCH]).sum(1) >= least[0]
        at = np.flatnonzero(few & (component[answers] != component[i]) & sizes_allow(n_own, n[i]) & (~stray_own | (ids[answers] > ids[i])))
        stay, matches = may_link(np.broadcast_to(rows[i], (len(at), _K)), own[at], least)
        at = at[stay]
        first = (own[at].reshape(len(at), BANDS, ROWS) == rows[i].reshape(BANDS, ROWS)).all(2).argmax(1) == band
        at, matches = at[first], matches[first]
        if len(at):
            lists[int(i)] = ids[answers[at[np.argsort(-matches, kind="stable")]]]
    wanted = np.isin(ids, np.concatenate(list(lists.values()))) & ~asks if lists else np.zeros(len(ids), bool)
    kept = sorted([*lists, *np.flatnonzero(wanted).tolist()])
    out = cell.select(["key", "row", "column", "id", "component", "asks"]).take(pa.array(kept, pa.int64()))
    out = out.append_column("others", pa.array([lists.get(i) for i in kept], pa.list_(pa.int64())))
    return out.combine_chunks().to_batches()[0] if kept else pa.RecordBatch.from_pylist([], schema=out.schema)


def _settled(cell: pa.Table) -> pa.RecordBatch:
    """A cell's candidates with their texts, to linked pairs that join different components."""
    ids, asks, others = (cell.column(k).to_pylist() for k in ("id", "asks", "others"))
    joined, out = Joined(cell.column("component").to_pylist()), []
    sets = _sets(as_bytes(cell.column("text")))
    place = {x: i for i, x in enumerate(ids) if not asks[i]}
    texts, sizes = as_bytes(cell.column("text")), np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.zeros(len(values), bool)
    for i in (i for i, x in enumerate(asks) if x):
        at = np.array([place[x] for x in others[i]])
        mine = number[starts[i] : starts[i] + sizes[i]]
        own[mine] = True
        both = np.array([np.count_nonzero(own[number[starts[j] : starts[j] + sizes[j]]]) for j in at])
        own[mine] = False
        for j in at[100 * both >= PERCENT * (sizes[i] + sizes[at] - both)].tolist():
            # Word by word: a link that hashes alone tell must not hide another.
            if joined.top(i) != joined.top(j) and _linked(texts[i], texts[j]):
                joined.join(i, j)
                out.append((ids[i], ids[j]))
    return pa.record_batch({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def text_hash(text: Column) -> Column:
    """SHA-256 of the normalised text. With the doc_id, what a row's decision is known by: rows that agree in both are decided alike."""
    return F.unhex(F.sha2(lower_az(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_shingles, component_id, kept, hash (text_hash).

    A text of fewer than five words has one shingle, all of them; a null or empty one none, and no links.
    component_id is the smallest doc_id reachable over links, kept says whether it's the row's own. A row
    with a null doc_id takes part; its component_id is the smallest doc_id that isn't null, and it is
    kept if there is none. Rows that repeat are copies like others; all rows of a kept doc_id are kept.
    An empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("sha"), lower_az(F.coalesce("text", F.lit(""))).alias("text"))
    signed = stored(slim.mapInArrow(_signatures, "doc_id bigint, sha binary, n bigint, bands array<bigint>, sketch binary"), "signatures")
    # One row for each text, numbered; the number is kept in the written table, so it's the same ever after.
    one = signed.where("n > 0").groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = stored(one.select(F.monotonically_increasing_id().alias("id"), "*"), "classes")
    rows = classes.select("id", F.col("n").alias("size"), F.posexplode("bands").alias("band", "key"))
    # Most buckets have one member; the two ends of the others are joined back to their members.
    ends = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("members")).where("low != high")
    members = stored(rows.join(ends.select("key", "low", "high", (F.col("members") > 3).alias("many")), "key"), "members")
    sketches = classes.select("id", "n", "sketch")
    # Of each class that shares a bucket, the text of one document that has it.
    shared = members.select("id").distinct().join(classes, "id").select("id", F.col("doc_id").alias("first"), F.col("sha").alias("own"))
    texts = stored(slim.join(shared, F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("sha") == F.col("own"))).select("id", "text").dropDuplicates(["id"]), "texts")

    dead = [members, texts]

    def stored_here(df: DataFrame, name: str) -> DataFrame:
        dead.append(stored(df, name))
        return dead[-1]

    def verify(pairs: DataFrame, hubs: DataFrame) -> DataFrame:
        sketch, text = with_copies(sketches, hubs), with_copies(texts, hubs)
        a, b = sketch.toDF("a", "na", "ka", "sa"), sketch.toDF("b", "nb", "kb", "sb")
        probable = stored_here(pairs.join(a, ["a", "sa"]).join(b, ["b", "sb"]).mapInArrow(_probable, "a bigint, b bigint, sa int, sb int"), "probable")
        full = probable.join(text.toDF("b", "tb", "sb"), ["b", "sb"]).join(text.toDF("a", "ta", "sa"), ["a", "sa"])
        return full.select("a", "b", "ta", "tb").mapInArrow(_exact, "a bigint, b bigint")

    def settle(cells: DataFrame) -> DataFrame:
        schema = "key bigint, row int, column int, id bigint, component bigint, asks boolean, others array<bigint>"
        maybe = stored_here(by_cell(cells.join(classes.select("id", "sketch"), "id"), schema, _candidates), "candidates")
        return by_cell(maybe.join(texts, "id"), "a bigint, b bigint", _settled)

    found = linked_components(members, verify, settle)
    discard(*dead)
    named = classes.select("id", "sha", "doc_id").join(found, "id", "left").select("sha", "doc_id", F.coalesce("component", "id").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_text = named.join(least, "component").select("sha", "component_id")
    out = signed.where("n > 0").select("doc_id", "sha", "n").join(by_text, "sha").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "sha")
    out = out.unionByName(signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "sha"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.col("sha").alias("hash"))


def op8_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("hash")


OP8_SQL = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
), s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < {SHINGLE} then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' '))) end as s from d
), n as (select doc_id, len(s) as n from s
), u as (select doc_id, unnest(s) as x from s
), p as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from u a join u b on a.x = b.x and a.doc_id != b.doc_id group by 1, 2
), l as (
  select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * common >= {PERCENT} * (na.n + nb.n - common)
), r as (
  select doc_id as id, doc_id as reached from n union select r.id, l.b from r join l on l.a = r.reached
), c as (select id, min(reached) as component_id from r group by id)
select doc_id, cast(n as bigint) as n_shingles, component_id, doc_id = component_id as kept from n join c on id = doc_id
"""
