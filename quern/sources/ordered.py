"""Records in the order of rows, in files that are written side by side.

Ranges of the order go to tasks, and each writes one part, under its attempt's name. How many records and bytes a part has is all that
leaves a task; their running sums say where each part begins. The manifest, which names the parts that count, is written last and
renamed into place, so a reader sees a whole version or the one before; parts of attempts that were lost or repeated are in no manifest.

One file of all parts: in a local (or mounted) file system each task writes its part at its own place in a file of the right size, which
is renamed when all are there. Stores without writes at a place (object stores) get the parts' bytes one after another, through one
task that holds a few megabytes of them; there, read the parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import files_in, store_of, whole_file

MANIFEST = "_manifest.json"
#: Bytes that are copied at once.
COPIED = 4 << 20

_PARTS = "part bigint, file string, records bigint, bytes bigint"


def _with_ends(lines: pa.Array) -> Iterator[tuple[memoryview, int]]:
    """The bytes of lines that aren't null, each with a line end, and how many they are; never a Python object for each line."""
    lines = lines.drop_null().cast(pa.large_binary())
    if len(lines):
        ended = pc.binary_join_element_wise(lines, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
        first, last = (int.from_bytes(memoryview(ended.buffers()[1])[8 * i : 8 * i + 8], "little") for i in (ended.offset, ended.offset + len(ended)))
        yield memoryview(ended.buffers()[2])[first:last], len(ended)


def write_ordered(lines: DataFrame, folder: str, order_by: str, column: str = "line", parts: int | None = None) -> list[dict]:
    """The lines, in order, as the parts of a new version of folder; its manifest: part, file, records, bytes, offset and first (of its bytes and records in the whole).

    parts: as many tasks, and files, at most; None: as the session's shuffle partitions. Equal keys of order_by are in one part, in any order. A null line is none.
    """
    version, spark = uuid.uuid4().hex[:12], lines.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, records, size = f"part-{task.partitionId():06d}-{version}-{task.taskAttemptId()}.jsonl", 0, 0
        with whole_file(f"{folder}/{name}") as out:
            for batch in batches:
                # Nulls are left out here: a filter would make each line once more.
                for data, n in _with_ends(batch.column(0)):
                    out.write(data)
                    records, size = records + n, size + len(data)
        if records:
            yield pa.record_batch({"part": [task.partitionId()], "file": [name], "records": [records], "bytes": [size]})

    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.select(F.col(order_by).alias("k"), F.col(column).alias("line")).repartitionByRange(n, "k").sortWithinPartitions("k")
    # A row for each part.
    found = sorted((r.asDict() for r in dealt.select("line").mapInArrow(run, _PARTS).collect()), key=lambda r: r["part"])
    offset = first = 0
    for r in found:
        r |= {"offset": offset, "first": first}
        offset, first = offset + r["bytes"], first + r["records"]
    with whole_file(f"{folder}/{MANIFEST}") as out:
        out.write(json.dumps({"version": version, "bytes": offset, "records": first, "parts": found}).encode())
    _forget(folder, {r["file"] for r in found})
    return found


def _forget(folder: str, kept: set[str]) -> None:
    """Deletes parts that no manifest names any more."""
    store, _ = store_of(folder)
    for uri in files_in(folder):
        if uri.rpartition("/")[2] not in kept:
            store.delete_file(store_of(uri)[1])


def manifest_of(folder: str) -> dict:
    store, path = store_of(f"{folder}/{MANIFEST}")
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


def read_ordered(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """(position, line) of the version that the manifest names: position counts from 0 in the written order. Parts are read side by side, each as a stream."""
    manifest = manifest_of(folder)["parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                store, path = store_of(f"{folder}/{name}")
                with store.open_input_stream(path) as f:
                    rest, at = b"", first
                    while data := f.read(COPIED):
                        *lines, rest = (rest + data).split(b"\n")
                        for i in range(0, len(lines), 1000):
                            some = lines[i : i + 1000]
                            yield pa.record_batch({"position": pa.array(range(at, at + len(some)), pa.int64()), "line": pa.array([x.decode() for x in some], pa.string())})
                            at += len(some)

    index = spark.createDataFrame([(r["file"], r["first"]) for r in manifest], "file string, first bigint")
    return index.repartitionByRange(max(1, parts or len(manifest)), "first").mapInArrow(run, "position bigint, line string")


def assemble(spark: SparkSession, folder: str, path: str) -> str:
    """The parts of folder as one file at path, which is there when it is whole; what was there before stays till then."""
    manifest = manifest_of(folder)
    store, target = store_of(path)
    where, _, name = target.rpartition("/")
    work = f"{where}/.{name}.{uuid.uuid4().hex[:12]}"
    store.create_dir(where or ".", recursive=True)
    local = isinstance(store, fs.LocalFileSystem)
    if local:
        with open(work, "wb") as f:
            f.truncate(manifest["bytes"])

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, offset, size in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "bytes"))):
                source, at = store_of(f"{folder}/{name}")
                with source.open_input_stream(at) as f, open(work, "r+b") as out:
                    out.seek(offset)
                    copied = 0
                    while data := f.read(COPIED):
                        out.write(data)
                        copied += len(data)
                if copied != size:
                    raise EOFError(f"{name}: {copied} of {size} bytes")
                yield pa.record_batch({"bytes": [copied]})

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store_, copied = store_of(path)[0], 0
        with store_.open_output_stream(work) as out:
            for batch in batches:
                for name in batch.column("file").to_pylist():
                    source, at = store_of(f"{folder}/{name}")
                    with source.open_input_stream(at) as f:
                        while data := f.read(COPIED):
                            out.write(data)
                            copied += len(data)
        yield pa.record_batch({"bytes": [copied]})

    try:
        index = spark.createDataFrame([(r["file"], r["offset"], r["bytes"]) for r in manifest["parts"]], "file string, offset bigint, bytes bigint")
        if local:
            done = index.repartitionByRange(max(1, len(manifest["parts"])), "offset").mapInArrow(copy, "bytes bigint")
        else:
            done = index.repartition(1).sortWithinPartitions("offset").mapInArrow(chain, "bytes bigint")
        copied = done.agg(F.sum("bytes")).first()[0] or 0
        if copied != manifest["bytes"]:
            raise EOFError(f"{copied} of {manifest['bytes']} bytes")
        store.move(work, target)
    except BaseException:
        if store.get_file_info(work).is_file:
            store.delete_file(work)
        raise
    return path
