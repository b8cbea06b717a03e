"""Exact de-duplication by deterministic block naming.

A normalised text is cut into fixed-size blocks. All blocks are sorted, and each distinct block gets
an integer name: the number of the partition it is dealt to, and its rank in that partition's sorted
order. Equal blocks meet in one partition and are compared byte by byte there, so they have equal
names, and different blocks different ones: no collision is possible. Then adjacent names of a document are paired, and the distinct pairs are sorted and named in
the same way, again and again, until each document has one name. Documents are equal exactly when
they were done in the same round with the same name.

Scale. Each round shuffles distinct contents, and places by other keys. A map task gives each distinct
content of a chunk of its rows (bounded by COMBINE_BYTES) a number, and sends it once with that number to be named; the places where it stands
keep the number, and are joined to its name by it. So a block that a third of all documents share is sent once by each
chunk, and its places never meet in one task. Texts
are shuffled once; later rounds move names only, and their number is the logarithm of the longest
document's blocks. Every round is written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import lower_az, partitions_for, pick, settled, small_batches, stored, table

BLOCK_BYTES = 16 << 10
#: What a map task holds before it sends its combined rows on.
COMBINE_BYTES = 32 << 20
#: Bits of a name for the rank in its partition.
RANK_BITS = 40

#: Two kinds of rows: contents with their numbers, and places, whose content is their number again, so that they are dealt evenly.
_PLACE = {"row": pa.int64(), "doc_id": pa.int64(), "pos": pa.int32(), "blocks": pa.int32(), "sha": pa.binary()}
_ROWS = pa.schema({"place": pa.bool_(), "content": pa.binary(), "number": pa.int64(), **_PLACE})
_NUMBERED = "place boolean, content binary, number bigint, row bigint, doc_id bigint, pos int, blocks int, sha binary"
_NAMED = "place boolean, number bigint, name bigint, row bigint, doc_id bigint, pos int, blocks int, sha binary"


class _Numbered:
    """Contents and places of a task, in chunks."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << RANK_BITS
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.places: list[tuple] = []
        self.bytes = 0

    def add(self, content: bytes, *place: object) -> None:
        number = self.numbers.get(content)
        if number is None:
            number = self.numbers[content] = self.next
            self.next += 1
            self.bytes += len(content) + 100
        self.places.append((number, *place))
        self.bytes += 150

    def full(self) -> bool:
        return self.bytes > COMBINE_BYTES

    def batches(self) -> Iterator[pa.RecordBatch]:
        contents, size = [], 0
        for content, number in self.numbers.items():
            contents.append((content, number))
            size += len(content) + 8
            if size > 4 << 20:
                yield _rows(False, contents)
                contents, size = [], 0
        if contents:
            yield _rows(False, contents)
        for i in range(0, len(self.places), 10_000):
            yield _rows(True, [(x[0].to_bytes(8, "big"), *x) for x in self.places[i : i + 10_000]])
        self._clear()


def _rows(place: bool, rows: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*rows), *[[None] * len(rows)] * (len(_ROWS) - 1 - len(rows[0]))]
    return pa.record_batch([pa.array([place] * len(rows)), *(pa.array(x, f.type) for x, f in zip(columns, list(_ROWS)[1:]))], schema=_ROWS)


def _blocks(block_bytes: int):
    """Normalised texts (doc_id, text) to numbered blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held = TaskContext.get().partitionId() << RANK_BITS, _Numbered()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = max(1, -(-len(text) // block_bytes))
                for pos in range(n):
                    sha = hashlib.sha256(text).digest() if pos == 0 else None
                    held.add(bytes(text[pos * block_bytes : (pos + 1) * block_bytes]), row, doc_id, pos, n, sha)
                row += 1
                if held.full():
                    yield from held.batches()
        yield from held.batches()

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of one round, two by two in each row (left null beyond the end), to numbered pairs."""
    held = _Numbered()
    for batch in batches:
        for left, right, *place in zip(*(batch.column(k).to_pylist() for k in ("left", "right", *_PLACE))):
            held.add(np.array([left, -1 if right is None else right], ">i8").tobytes(), *place)
            if held.full():
                yield from held.batches()
    yield from held.batches()


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one partition, sorted: contents to their names, and places as they are."""
    name, last = (TaskContext.get().partitionId() << RANK_BITS) - 1, None
    for batch in batches:
        places, names = batch.column("place").to_pylist(), []
        for place, content in zip(places, batch.column("content").to_pylist()):
            if not place and content != last:
                name, last = name + 1, content
            names.append(None if place else name)
        yield pa.record_batch({"place": batch.column("place"), "number": batch.column("number"), "name": pa.array(names, pa.int64()), **{k: batch.column(k) for k in _PLACE}})


def _named(numbered: DataFrame, partitions: int, round_: int) -> DataFrame:
    """Numbered rows to places with their contents' names, stored."""
    rows = stored(numbered.repartition(partitions, "place", "content").sortWithinPartitions("place", "content").mapInArrow(_names, _NAMED), f"numbers{round_}")
    names = rows.where("not place").select("number", "name")
    return stored(rows.where("place").drop("place", "name").join(names, "number").drop("number"), f"names{round_}")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared after lower-casing A-Z; a null text is empty. Of equal texts the row with the
    largest doc_id stays (a null doc_id is the smallest); of rows that repeat both, one stays. An empty
    table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), lower_az(F.coalesce("text", F.lit(""))).cast("binary").alias("text"))
    parts = partitions_for(docs)
    # Numbers are given in the order of rows, so a task that runs again must see the same order.
    named = _named(settled(slim).mapInArrow(_blocks(block_bytes), _NUMBERED), parts, 0)
    most = named.agg(F.max("blocks")).first()[0] or 0
    rounds = math.ceil(math.log2(most)) if most > 1 else 0
    done = [named.where("blocks = 1").withColumn("round", F.lit(0))]
    for k in range(1, rounds + 1):
        # A row's two halves meet under its own key; a document has few names, however common its text is.
        paired = (
            named.where(f"blocks > {1 << (k - 1)}")
            .groupBy("row", "blocks", (F.col("pos").cast("long") / 2).cast("int").alias("half"))
            .agg(F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"), F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"), F.max(F.when(F.col("pos") == 0, F.col("sha"))).alias("sha"))
            .withColumnRenamed("half", "pos")
        )
        named = _named(paired.sortWithinPartitions("row", "pos").mapInArrow(_pairs, _NUMBERED), parts, k)
        done.append(named.where(f"blocks <= {1 << k}").withColumn("round", F.lit(k)))
    one = done[0]
    for x in done[1:]:
        one = one.unionByName(x)
    one = one.select("row", "doc_id", "sha", "name", "round")
    # Partial sums in each map task, then a join that the adaptive planner splits where one name is hot.
    groups = one.groupBy("round", "name").agg(F.max(F.struct("doc_id", (-F.col("row")).alias("first"))).alias("keep"), F.count("*").alias("group_size"))
    return one.join(groups, ["round", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("keep.first") == -F.col("row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
)
select doc_id,
       max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from d
"""
