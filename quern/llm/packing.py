"""Packing documents into training sequences: first-fit decreasing with a tournament tree of bins.

A document of n ids gives n // SEQUENCE whole sequences and one rest. The rests are dealt at random
(by a hash, so always alike) into groups of about GROUP_ROWS, and each group is packed on its own: its
rests from long to short, each into the first bin that has room. The bins' free space is in a
tournament tree, in which every node holds the larger of its two children, so the first bin with
room is found in a walk from the root, in logarithmic time.

A bin that ends at a power of two is a sequence of that length; others are padded to SEQUENCE.

Scale. Ids are made once, where the text is read; a document's pieces follow from its number of ids,
so only lengths are dealt to the groups. Groups have a bounded mean size whatever the keys' skew: their number follows
the number of rests, and the key is a hash of a piece's own number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_bytes, in_slices, pick, small_batches, stored, table
from .tokenizing import SLICE, crc32, ids_by

SEQUENCE = 2048
END_ID = 1
#: Rests in a group, about.
GROUP_ROWS = 4096
SEED = 20_011

_PIECES = "piece bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Bins:
    """Free space of bins that are opened as needed, in a tournament tree."""

    def __init__(self, capacity: int, most: int) -> None:
        self.leaves = 1 << max(0, (max(1, most) - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """The first bin with room for size, and the place in use there before."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        bin_, left = at - self.leaves, free[at]
        free[at] = left - size
        while at > 1:
            at //= 2
            larger = max(free[2 * at], free[2 * at + 1])
            if free[at] == larger:
                break
            free[at] = larger
        return bin_, left


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1 to capacity); of equal lengths the earlier comes first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree = Bins(capacity, len(lengths))
    for i in np.argsort(-lengths, kind="stable"):
        bin_, left = tree.first_fit(int(lengths[i]))
        bins[i], offsets[i] = bin_, capacity - left
    return bins, offsets


def cut_documents(docs: DataFrame, tokenizer: str, white_space: str = "lead", end_id: int = END_ID, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """(doc_id, text) to pieces: piece (its own number), doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for.

    A null text is empty: its document is the end id alone.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, piece = ids_by(tokenizer, white_space), TaskContext.get().partitionId() << 40
        for batch in in_slices(batches, "text", SLICE):
            rows = []
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), ids.of(as_bytes(batch.column("text")))):
                x += end
                for start in range(0, len(x), 4 * sequence):
                    part = x[start : start + 4 * sequence]
                    rows.append((piece, doc_id, start // 4, len(part) // 4, crc32(part), len(x) // 4, part if with_ids else None))
                    piece += 1
            columns = list(zip(*rows))
            out = {k: pa.array(columns[i], pa.int64()) for i, k in enumerate(("piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens"))}
            yield pa.record_batch(out | ({"ids": pa.array(columns[6], pa.binary())} if with_ids else {}))

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, _PIECES + ", ids binary" * with_ids)


def pack(pieces: DataFrame, sequence: int = SEQUENCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces (as of cut_documents, stored) with sequence_id and offset.

    Pieces as long as a sequence are one, with an odd sequence_id of their own number. Others are packed
    in their group; their sequence_id, even, is of the group's number and the bin's, so reruns agree. No piece is lost or cut again. An empty table gives no rows.
    """
    n = pieces.where(F.col("length") < sequence).count()
    groups = max(1, round(n / group_rows))
    columns = pieces.columns
    whole = pieces.where(F.col("length") >= sequence).select(*columns, (2 * F.col("piece") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = pieces.where(F.col("length") < sequence).withColumn("group", F.pmod(F.xxhash64("piece", F.lit(SEED)), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rests.schema.fields) + ", sequence_id bigint, offset bigint"

    def run(keys: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("piece")
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), sequence)
        return group.append_column("sequence_id", pa.array(2 * ((keys[0].as_py() << 24) + bins))).append_column("offset", pa.array(offsets))

    packed = rests.groupBy("group").applyInArrow(run, schema)
    return whole.unionByName(packed.select(*whole.columns))


def op9_packing(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    pieces = stored(cut_documents(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("byte_bpe_50k.json")), "pieces")
    return pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
