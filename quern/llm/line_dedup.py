"""Line de-duplication: equal lines, and lines within a small edit distance, by a segment-partition join.

A line of at least LEAST_CHARS characters is split into DISTANCE + 1 segments. If two lines are within
DISTANCE edits, one of the shorter line's segments is in the longer one unchanged, near its own
place. So each line is entered in an index under (length, segment number, segment), and each line
probes the entries of every length it can be linked to (its own or up to DISTANCE less) with those of its substrings that can stand
for a segment: how far one may be shifted follows from the segments before and after it (12 probes in
all for a distance of 2). What meets is verified by a banded bit-parallel edit distance.

Linked lines form classes; of a class the first occurrence, by doc_id and line number, stays. Shorter
lines are compared for equality alone, and blank ones are left as they are.

Scale. Distinct lines come first: lines are known by a 128-bit hash, copies of a hot line are combined in
each task before they are shuffled, and each distinct line gets a number, under which it is indexed and probes.
Index entries become one row for each key, whatever their number; buckets of any size are settled as in
links.py. Two different lines have one hash with a chance of n**2 / 2**129 among n lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import by_place, discard, in_slices, pick, position, small_batches, stored, table
from .links import Joined, by_cell, linked_components, with_copies
from .words import mixed

DISTANCE = 2
LEAST_CHARS = 32
#: Ids of lines that are broadcast, at most: some 32 MB.
MOST_BROADCAST = 1 << 20


def within(a: str, b: str, most: int = DISTANCE) -> bool:
    """Whether a and b are within so many edits (insertions, deletions, substitutions of one character).

    Of the table of edit distances only the band of 2 * most + 1 diagonals is looked at. For each number
    of edits e one integer holds, for a row of the table, which places of the band are within e edits:
    a row follows from the one above by a few operations on whole integers.
    """
    if abs(len(a) - len(b)) > most:
        return False
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        # Equal beginnings and ends don't change the distance; long ones are skipped in steps.
        step = 1
        while start + 2 * step <= end and a[start : start + 2 * step] == b[start : start + 2 * step]:
            step *= 2
        start += step
    a, b = a[start:], b[start:]
    stop = 0
    while stop < min(len(a), len(b)) and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[: len(a) - stop], b[: len(b) - stop]
    if not a or not b:
        return len(a) + len(b) <= most
    width = 2 * most + 1
    full = (1 << width) - 1
    # Bit o of a row i stands for place i + o - most of b; places before b's beginning are never reached.
    rows = [sum(1 << (most + k) for k in range(e + 1)) for e in range(most + 1)]
    places: dict[str, int] = {}
    for j, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << (j + most)
    for i, c in enumerate(a):
        same = places.get(c, 0) >> i & full
        above, rows = rows, []
        for e in range(most + 1):
            now = above[e] & same
            if e:
                now |= above[e - 1] | above[e - 1] >> 1 | rows[e - 1] << 1
            rows.append(now & full)
        if not rows[most]:
            return False
    return bool(rows[most] >> (len(b) - len(a) + most) & 1)


_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _powers(base: int, n: int) -> np.ndarray:
    """The first powers of base, n at least, modulo 2**64."""
    if len(_POWERS[base]) < n:
        most = 1 << (n - 1).bit_length()
        _POWERS[base] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(most - 1, base, np.uint64))])
    return _POWERS[base]


class Substrings:
    """Hashes of substrings of lines, for all lines at once: sums of characters times powers, so any substring's is a difference.

    Lines lie end to end, so powers follow one another without a gap; a substring's sum is divided by the power at its beginning.
    """

    def __init__(self, lines: list[str]) -> None:
        joined = "".join(lines)
        codes = np.frombuffer(joined.encode(), np.uint8) if joined.isascii() else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        self.length = np.fromiter(map(len, lines), np.int64, len(lines))
        self.start = np.cumsum(self.length) - self.length
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(_BASE, len(codes) + 1)[: len(codes)], out=self.sums[1:])
        self.inverse = _powers(_INVERSE, len(codes) + 1)

    def of(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        first, last = self.start + np.clip(begin, 0, self.length), self.start + np.clip(begin + size, 0, self.length)
        return (self.sums[last] - self.sums[first]) * self.inverse[first]


def _segments(length: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Begin and size of each segment of lines of these lengths: as even as can be, the longer ones last."""
    n = distance + 1
    short, longer = length // n, length % n
    return [(i * short + np.maximum(0, i - (n - longer)), short + (i >= n - longer)) for i in range(n)]


def _key(segment: np.ndarray, i: int, length: np.ndarray) -> np.ndarray:
    return mixed(segment ^ ((length * 64 + i).astype(np.uint64) * np.uint64(_BASE)))


def index_keys(lines: list[str], distance: int = DISTANCE) -> np.ndarray:
    """Of each line, the keys that it is indexed under."""
    s = Substrings(lines)
    return np.stack([_key(s.of(begin, size), i, s.length) for i, (begin, size) in enumerate(_segments(s.length, distance))], 1)


def probe_keys(lines: list[str], distance: int = DISTANCE) -> np.ndarray:
    """Of each line, the keys under which lines of its length, or up to distance less, may be indexed."""
    s, keys = Substrings(lines), []
    for less in range(distance + 1):
        n = s.length - less
        for i, (begin, size) in enumerate(_segments(n, distance)):
            # Edits before a segment shift it by at most their number, i; those after it, by what is left.
            for shift in range(max(-i, less - (distance - i)), min(i, less + distance - i) + 1):
                keys.append(_key(s.of(begin + shift, size), i, n))
    return np.stack(keys, 1)


def _keyed(distinct: DataFrame, of: Callable[[list[str], int], np.ndarray], distance: int) -> DataFrame:
    """(id, line) to (id, size, key), a row for each of a line's different keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "line", 1 << 20):
            lines = batch.column("line").to_pylist()
            keys = np.sort(of(lines, distance).view(np.int64), 1)
            new = np.ones(keys.shape, bool)
            new[:, 1:] = keys[:, 1:] != keys[:, :-1]
            ends = np.concatenate([[0], np.cumsum(new.sum(1))]).astype(np.int32)
            sizes = np.fromiter(map(len, lines), np.int64, len(lines))
            yield pa.record_batch({"id": batch.column("id"), "size": pa.array(sizes), "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[new]))})

    return distinct.select("id", "line").mapInArrow(run, "id bigint, size bigint, keys array<bigint>").select("id", "size", F.explode("keys").alias("key"))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to (doc_id, text_hash, line_no from 0, line), lines that aren't blank."""
    # The text's hash is made before the text is taken apart, so once.
    hashed = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), line_hash(F.col("text")).alias("text_hash"), "text")
    split = hashed.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return split.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _exact(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [within(a, b, distance) for a, b in zip(batch.column("la").to_pylist(), batch.column("lb").to_pylist())]
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    return run


def bags(lines: list[str]) -> np.ndarray:
    """How often each line has characters of each of 64 kinds. An edit changes a bag by 2 at most."""
    return np.stack([np.bincount(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") & 63, minlength=64) for x in lines]).astype(np.int32)


def _settled(distance: int):
    """A cell's members with their lines, to linked pairs that join different components."""

    def pairs(cell: pa.Table) -> pa.RecordBatch:
        ids, component, stray, asks = (cell.column(k).to_pylist() for k in ("id", "component", "stray", "asks"))
        lines, joined, out = cell.column("line").to_pylist(), Joined(component), []
        answers = np.array([i for i, x in enumerate(asks) if not x], np.int64)
        lengths, bag = np.array([len(x) for x in lines]), bags(lines)
        for i in (i for i, x in enumerate(asks) if x):
            # What these exclude is further apart; what is left is compared in full.
            at = answers[np.abs(lengths[answers] - lengths[i]) <= distance]
            at = at[np.abs(bag[at] - bag[i]).sum(1) <= 2 * distance]
            for j in at.tolist():
                if not (stray[j] and ids[j] <= ids[i]) and joined.top(i) != joined.top(j) and within(lines[i], lines[j], distance):
                    joined.join(i, j)
                    out.append((ids[i], ids[j]))
        return pa.record_batch({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return pairs


def line_hash(line: Column) -> Column:
    return F.unhex(F.md5(line))


def line_classes(docs: DataFrame, distance: int = DISTANCE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row for each line of docs (doc_id, text) that isn't blank: doc_id, line_no, class_doc_id, class_line_no, kept, hash, and text_hash, the hash of the whole text.

    The class is named by its first line's place, and that line is kept. A null doc_id comes first. A
    null or empty text has no lines. Rows that repeat a doc_id share their lines' places: of such, equal lines in one
    place are one. An empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    lines = lines_of(docs).withColumn("hash", line_hash(F.col("line")))
    places = stored(lines.select("doc_id", "text_hash", "line_no", "hash"), "line-places")
    # Numbered where they are written, so a line's number is the same ever after.
    long = lines.where(F.length("line") >= least_chars).groupBy("hash").agg(F.first("line").alias("line"))
    distinct = stored(long.select(F.monotonically_increasing_id().alias("id"), "hash", "line"), "distinct-lines")
    index = _keyed(distinct, index_keys, distance)
    ends = index.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("members"))
    probes = _keyed(distinct, probe_keys, distance)
    # A line finds itself; what finds nothing else is dropped in the join.
    met = probes.join(ends, "key").where("low != id or high != id").select("key", "id", "size", "low", "high", (F.col("members") > 2).alias("many"))
    members = stored(met, "line-members")
    # A line that is only found, or only one end of a bucket, takes part too.
    ids = stored(members.select(F.explode(F.array("id", "low", "high")).alias("id")).distinct(), "line-ids")
    # Few ids are sent to the lines; with many, lines are shuffled to them.
    found = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    texts = stored(distinct.join(found, "id").select("id", "line"), "lines")

    def verify(pairs: DataFrame, hubs: DataFrame) -> DataFrame:
        text = with_copies(texts, hubs)
        full = pairs.join(text.toDF("a", "la", "sa"), ["a", "sa"]).join(text.toDF("b", "lb", "sb"), ["b", "sb"])
        return full.select("a", "b", "la", "lb").mapInArrow(_exact(distance), "a bigint, b bigint")

    def settle(cells: DataFrame) -> DataFrame:
        return by_cell(cells.join(texts, "id"), "a bigint, b bigint", _settled(distance))

    found = linked_components(members, verify, settle)
    discard(members, ids, texts)
    linked = distinct.select("id", "hash").join(found, "id").select("hash", "component")
    first = places.groupBy("hash").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    named = first.join(linked, "hash", "left")
    firsts = named.where("component is not null").groupBy("component").agg(F.min("first").alias("of"))
    by_hash = named.join(firsts, "component", "left").select("hash", F.coalesce("of", "first").alias("of"))
    by_hash = by_hash.select("hash", F.col("of.doc_id").alias("class_doc_id"), F.col("of.line_no").alias("class_line_no"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("line_no") == F.col("class_line_no"))
    return places.join(by_hash, "hash").select("doc_id", "line_no", "class_doc_id", "class_line_no", kept.alias("kept"), "hash", "text_hash")


def drop_lines(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """docs (all columns) without the lines that classes doesn't keep; n_chars, if there, is made anew.

    A document of which no line is left, though it had some, goes: it is all in others. Documents without a line (null or
    blank texts) stay as they are. A document is known by its doc_id and its text, so those without a doc_id are each
    left by what they have themselves; lines that two of them have at one and the same number are one place, and stay in both. Rows that repeat both
    are left alike. The work is linear in a document's lines.
    """
    dropped = classes.where("not kept").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.collect_set("line_no").alias("dropped"))
    d, names = by_place(docs), docs.columns
    id_, text = f"c{position(docs, 'doc_id')}", f"c{position(docs, 'text')}"
    joined = d.join(dropped, F.col(id_).cast("long").eqNullSafe(F.col("__id")) & (line_hash(F.col(text)) == F.col("__hash")), "left").drop("__id", "__hash")
    split = joined.withColumn("__split", F.when(F.col("dropped").isNotNull(), F.split(text, "\n", -1)))
    numbers = split.withColumn("__left", F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), F.col("dropped")))
    changed = numbers.withColumn("__lines", F.transform("__left", lambda i: F.get(F.col("__split"), i)))
    gone = F.col("__lines").isNotNull() & ~F.exists("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = changed.where(~F.coalesce(gone, F.lit(False))).withColumn(text, F.coalesce(F.array_join("__lines", "\n"), F.col(text)))
    if "n_chars" in names:
        n = f"c{position(docs, 'n_chars')}"
        out = out.withColumn(n, F.when(F.col("dropped").isNotNull(), F.length(text).cast(docs.schema[position(docs, "n_chars")].dataType)).otherwise(F.col(n)))
    return out.select(*d.columns).toDF(*names)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents")).drop("hash", "text_hash")


OP3_SQL = f"""
with recursive d as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as line_no from documents
), l as (select * from d where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), u as (select distinct line, len(line) as n from l
), p as (
  select a.line as a, b.line as b from u a join u b on b.n between a.n - {DISTANCE} and a.n + {DISTANCE} and a.line != b.line
  where a.n >= {LEAST_CHARS} and b.n >= {LEAST_CHARS} and levenshtein(a.line, b.line) <= {DISTANCE}
), r as (
  select line, line as reached from u union select r.line, p.b from r join p on p.a = r.reached
), f as (select line, min({{'d': doc_id, 'n': line_no}}) as first from l group by line
), c as (select r.line, min(f.first) as first from r join f on f.line = r.reached group by r.line)
select l.doc_id, cast(l.line_no as integer) as line_no, c.first.d as class_doc_id, cast(c.first.n as integer) as class_line_no,
       l.doc_id = c.first.d and l.line_no = c.first.n as kept
from l join c on l.line = c.line
"""
