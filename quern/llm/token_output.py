"""Token ids in binary files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are renumbered by how often the corpus has them, most frequent first, so common ids are small.
Four numbers share one control byte, two bits each: the number of data bytes less one. Control bytes
and data bytes are kept apart, so a reader finds every number's place from the control bytes alone: a
table of 256 rows gives the four lengths, their running sum gives the offsets, and numpy gathers all
numbers of a shard at once.

A shard file, all integers little-endian:

    magic "QTOK0001"; u64 documents; u64 numbers; u64 control bytes; u64 data bytes
    i64 doc_id, then u64 numbers, of each document (with a bitmap for null ids before: one byte each)
    control bytes; data bytes

The vocabulary's ranks are in one file beside the shards, `ranks`: u32 id of each rank. Shards hold
documents in ascending doc_id, and shard n+1 follows shard n; the index lists their totals.

Scale. Texts are encoded once, to a written table of 2 or 4 byte ids. One range shuffle by doc_id puts
them in order. The rank table is as large as the vocabulary, never the corpus. Readers take one shard
each, and a shard is cut at SHARD_NUMBERS.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import MOST_PARTITIONS, as_bytes, discard, in_slices, partitions_for, pick, scratch, small_batches, stored, table
from .files import Reader, new_file
from .tokenizing import SLICE, crc32, ids_by

MAGIC = b"QTOK0001"
END_ID = 2
#: Numbers in a shard file, about: a task cuts its documents into several files beyond that.
SHARD_NUMBERS = 4_000_000
#: Numbers that are coded at once, a multiple of four.
AT_ONCE = 1 << 18

_COUNTED = "doc_id bigint, ids binary, id array<bigint>, n array<bigint>"

#: Of each control byte, the lengths of its four numbers.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    controls, datas = [], []
    for i in range(0, len(numbers), AT_ONCE):
        x = numbers[i : i + AT_ONCE].astype("<u4")
        more = (x > 0xFF).astype(np.uint8) + (x > 0xFFFF) + (x > 0xFFFFFF)
        padded = np.zeros(-(-len(x) // 4) * 4, np.uint8)
        padded[: len(x)] = more
        four = padded.reshape(-1, 4)
        controls.append((four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes())
        datas.append(x.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]].tobytes())
    return b"".join(controls), b"".join(datas)


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers again, by table lookup of control bytes."""
    raw, out, at = np.frombuffer(data + b"\0\0\0", np.uint8), np.empty(n, np.uint32), 0
    for i in range(0, n, AT_ONCE):
        lengths = _LENGTHS[np.frombuffer(control, np.uint8)[i // 4 : (i + AT_ONCE) // 4]].ravel()[: n - i]
        ends = np.cumsum(lengths, dtype=np.int64) + at
        if ends[-1] > len(data):
            break
        starts, at = ends - lengths, int(ends[-1])
        x = raw[starts].astype(np.uint32)
        for k in (1, 2, 3):
            some = np.flatnonzero(lengths > k)
            if not len(some):
                break
            x[some] |= raw[starts[some] + k].astype(np.uint32) << np.uint32(8 * k)
        out[i : i + len(x)] = x
    if at != len(data) or len(control) != -(-n // 4):
        raise ValueError("data bytes don't match the control bytes")
    return out


def encode_texts(docs: DataFrame, tokenizer: str, white_space: str = "drop", end_id: int = END_ID, counted: bool = False) -> DataFrame:
    """(doc_id, text) to (doc_id, ids): the text's ids and end_id, as little-endian unsigned 32-bit bytes. A null text is empty.

    counted: as write_token_files stores them, with their counts, so that it need not read them once more.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
        ids = ids_by(tokenizer, white_space)
        for batch in in_slices(batches, "text", SLICE):
            yield batch.column("doc_id"), [x + end for x in ids.of(as_bytes(batch.column("text")))]

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, found in encoded(batches):
            yield pa.record_batch({"doc_id": doc_id, "ids": pa.array(found, pa.binary())})

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(lambda x: _counted(encoded(x)), _COUNTED) if counted else slim.mapInArrow(plain, "doc_id bigint, ids binary")


def _narrowed(x: bytes) -> bytes:
    """Ids to 2 bytes each where they all fit: half of what is stored and shuffled."""
    ids = np.frombuffer(x, "<u4")
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\4" + x


def _wide(x: bytes) -> np.ndarray:
    return np.frombuffer(x, "<u2" if x[0] == 2 else "<u4", offset=1).astype(np.uint32)


def _counted(documents: Iterator[tuple[pa.Array, list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """Documents' ids, narrowed, and after them one row of the task's counts: the ids it met, and how often."""
    total, longs = np.zeros(1 << 16, np.int64), pa.list_(pa.int64())
    for doc_id, found in documents:
        counts = np.bincount(np.frombuffer(b"".join(found), "<u4"), minlength=len(total))
        counts[: len(total)] += total
        total = counts
        none = pa.nulls(len(found), longs)
        yield pa.record_batch({"doc_id": doc_id, "ids": pa.array([_narrowed(x) for x in found], pa.binary()), "id": none, "n": none})
    at = np.flatnonzero(total)
    yield pa.record_batch({"doc_id": pa.nulls(1, pa.int64()), "ids": pa.nulls(1, pa.binary()), "id": pa.array([at], longs), "n": pa.array([total[at]], longs)})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _counted((b.column("doc_id"), b.column("ids").to_pylist()) for b in batches)


def write_token_files(encoded: DataFrame, folder: str, counted: bool = False) -> DataFrame:
    """(doc_id, ids) to shard files in folder; the index: shard, part, path, documents, numbers. counted: as of encode_texts.

    encoded is stored and counted first, and written when all counts are known. A file's name holds its task's attempt, so one that is
    late or repeated replaces nothing: the index names the files that count. Documents are in ascending
    doc_id, null first; of equal ones the order is by their ids. An empty table writes no shard.
    """
    spark = encoded.sparkSession
    kept = stored(encoded if counted else encoded.select("doc_id", "ids").mapInArrow(_count, _COUNTED), "ids", "zstd")
    # As many rows as the vocabulary has ids: bounded by the tokenizer.
    counts = kept.where("id is not null").select(F.explode(F.arrays_zip("id", "n")).alias("c")).groupBy("c.id").agg(F.sum("c.n").alias("n")).collect()
    by_rank = np.array([r.id for r in sorted(counts, key=lambda r: (-r.n, r.id))], "<u4")
    with new_file(f"{folder}/ranks") as out:
        out.write(by_rank.tobytes())
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, attempt, part, ids, numbers, size = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/shard-{shard:06d}-{part:06d}-{attempt}"
            control, data = encode_numbers(shared.value[np.concatenate(numbers)])
            with new_file(path) as out:
                out.write(MAGIC + np.array([len(ids), size, len(control), len(data)], "<u8").tobytes())
                out.write(np.array([x is None for x in ids], np.uint8).tobytes())
                out.write(np.array([x or 0 for x in ids], "<i8").tobytes() + np.array([len(x) for x in numbers], "<u8").tobytes())
                out.write(control)
                out.write(data)
            return pa.record_batch({"shard": [shard], "part": [part], "path": [path], "documents": [len(ids)], "numbers": [size]})

        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids.append(doc_id)
                numbers.append(_wide(x))
                size += len(numbers[-1])
                if size >= SHARD_NUMBERS:
                    yield flush()
                    part, ids, numbers, size = part + 1, [], [], 0
        if ids:
            yield flush()

    ordered = kept.where("ids is not null").select("doc_id", "ids").repartitionByRange(partitions_for(kept), "doc_id", F.crc32("ids")).sortWithinPartitions("doc_id", F.crc32("ids"))
    index = stored(ordered.mapInArrow(run, "shard bigint, part bigint, path string, documents bigint, numbers bigint"), "token-index")
    discard(kept)
    return index


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards that index lists: doc_id, start (numbers of all documents before it), ids."""
    spark = index.sparkSession
    # The one window without a partition has a row for each partition of the writing shuffle.
    before = lambda n, w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = index.groupBy("shard").agg(F.sum("numbers").alias("all")).select("shard", before("all", Window.orderBy("shard")).alias("base"))
    own = index.select("shard", "path", before("numbers", Window.partitionBy("shard").orderBy("part")).alias("own"))
    totals = own.join(shards, "shard").select("path", (F.col("base") + F.col("own")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = None
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                if by_rank is None:
                    file = Reader(f"{folder}/ranks")
                    by_rank = np.frombuffer(file.file.read(), "<u4")
                    file.close()
                file = Reader(path)
                if file.read(0, 8) != MAGIC:
                    raise ValueError(f"{path} is no token file")
                n, size, controls, datas = map(int, np.frombuffer(file.read(8, 32), "<u8"))
                null = np.frombuffer(file.read(40, n), np.uint8)
                doc_ids = np.frombuffer(file.read(40 + n, 8 * n), "<i8")
                lengths = np.frombuffer(file.read(40 + 9 * n, 8 * n), "<u8").astype(np.int64)
                ids = by_rank[decode_numbers(file.read(40 + 17 * n, controls), file.read(40 + 17 * n + controls, datas), size)]
                file.close()
                ends = np.cumsum(lengths)
                for i in range(0, n, 500):
                    at = slice(i, min(n, i + 500))
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array(doc_ids[at], mask=null[at].astype(bool)),
                            "start": pa.array(base + ends[at] - lengths[at]),
                            "ids": pa.array([ids[e - m : e].tobytes() for e, m in zip(ends[at], lengths[at])], pa.binary()),
                        }
                    )

    # A row for each file, in as many parts: what is dealt to a number of partitions isn't put together again.
    parts = max(1, min(index.count(), MOST_PARTITIONS))
    return totals.repartitionByRange(parts, "base").mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def digest(documents: DataFrame) -> DataFrame:
    """(doc_id, start, ids) to (doc_id, start, n_tokens, ids_crc32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "start": batch.column("start"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_crc32": pa.array([crc32(x) for x in ids], pa.int64())})

    return documents.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op4_token_output(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    folder = scratch(spark, "tokens")
    encoded = encode_texts(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"), counted=True)
    return digest(read_token_files(write_token_files(encoded, folder, counted=True), folder))
