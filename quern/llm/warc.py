"""WARC archives, written with an index first and read back by coalesced byte ranges.

Each page is one record, gzipped on its own, so a record can be read without what is before it. The
index has a row for each record: file, offset, length, URL and digest. To read, records are selected
from the index alone, sorted by place, and neighbouring ones (up to GAP_BYTES apart) become one read of
up to READ_BYTES, which is then cut into records.

Of pages with equal payloads the one with the smallest page_id is a response record with the payload;
the others are revisit records, which name that response and have no payload.

Scale. Digests are made where pages are read. The smallest page_id of each digest is found by partial
sums in each task, and joined back by digest, which the adaptive planner splits where one payload is
hot. Archives are written by each task, in files of about FILE_BYTES, whose names hold the task's attempt: a repeated or
late attempt replaces no file, and the index names those that count. Reads are dealt by ranges of the
index, so a long archive is read by many tasks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_bytes, in_slices, partitions_for, pick, scratch, small_batches, stored, table
from .files import Reader, new_file

FILE_BYTES = 32 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Of the index, the bytes that one reading task takes: some 100,000 records.
INDEX_BYTES = 4 << 20
#: A payload of fewer bytes is written again rather than revisited.
LEAST_BYTES = 0
#: The date of records; pages have none of their own, and archives of equal pages are to be equal.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SCHEMA = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])
_INDEX = "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str | None) -> str:
    """A header's value: no line ends, which would end it."""
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value or "")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    name = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: bool, of: int | None = None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisits else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisits else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(of)), ("WARC-Truncated", "length")] if revisits else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + body + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    first, *lines = raw.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)} | {"": first}


def parse_record(data: bytes) -> dict:
    """What a record says and holds; raises ValueError if it isn't whole or its digest isn't its payload's."""
    head, _, rest = data.partition(b"\r\n\r\n")
    h = _headers(head)
    if h[""] != "WARC/1.1":
        raise ValueError("no WARC record")
    body, end = rest[: int(h["content-length"])], rest[int(h["content-length"]) :]
    if end != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    inner, _, payload = body.partition(b"\r\n\r\n")
    kind, digest = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:")
    size = int(_headers(inner)["content-length"])
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("a record's payload isn't what its headers say")
    return {
        "page_id": _page_of(h["warc-record-id"]),
        "url": h["warc-target-uri"],
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": _page_of(h["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html) to .warc.gz files in folder; their index, stored.

    Payloads are equal when their SHA-256 and lengths are (unlike ones of one SHA-1 are known). A null html is an empty payload. Equal payloads
    of at least least_bytes: the smallest page_id (null last) is the response. Rows that repeat the
    response's page_id and payload are responses again. An empty table writes no archive.
    """
    spark = pages.sparkSession
    small_batches(spark)
    slim = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    key = F.unhex(F.sha2(payload, 256))
    digests = stored(slim.select("page_id", key.alias("key"), F.octet_length(payload).alias("size")), "digests")
    # Only payloads that come back need a join; the pages that revisit are found among the digests alone.
    firsts = digests.where(F.col("size") >= least_bytes).groupBy("key", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = digests.join(firsts, ["key", "size"]).where(~F.col("page_id").eqNullSafe(F.col("first")))
    again = stored(again.select(F.col("page_id").alias("pid"), F.col("key").alias("again"), "first").distinct(), "revisits")
    keyed = slim.withColumn("sha", F.sha1(payload)).join(again, F.col("page_id").eqNullSafe(F.col("pid")) & (key == F.col("again")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt, number, held, rows, at = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/pages-{task:06d}-{number:06d}-{attempt}.warc.gz"
            with new_file(path) as out:
                for x in held:
                    out.write(x)
            return pa.RecordBatch.from_pylist([{"file": path, **r} for r in rows], schema=_SCHEMA)

        for batch in in_slices(batches, "html"):
            for page_id, url, payload, sha1, revisits, of in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), as_bytes(batch.column("html")), batch.column("sha").to_pylist(), batch.column("revisits").to_pylist(), batch.column("first").to_pylist()):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                member = gzip.compress(record(page_id, url, payload, digest, revisits, of), 1, mtime=0)
                rows.append({"offset": at, "length": len(member), "url": url, "digest": digest, "page_id": page_id, "record_type": "revisit" if revisits else "response"})
                held.append(member)
                at += len(member)
                if at >= FILE_BYTES:
                    yield flush()
                    number, held, rows, at = number + 1, [], [], 0
        if rows:
            yield flush()

    return stored(keyed.select("page_id", "url", "html", "sha", F.col("again").isNotNull().alias("revisits"), "first").mapInArrow(run, _INDEX), "warc-index")


def coalesced(places: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) to reads: start, end, and the numbers of the places within."""
    reads: list[tuple[int, int, list[int]]] = []
    for i, (offset, length) in enumerate(places):
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            start, end, within = reads[-1]
            within.append(i)
            reads[-1] = (start, max(end, offset + length), within)
        else:
            reads.append((offset, offset + length, [i]))
    return reads


def read_archives(selected: DataFrame, with_payload: bool = True) -> DataFrame:
    """Rows of an index to their records: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload."""
    kinds = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint" + ", payload binary" * with_payload
    names = [x.split()[0] for x in kinds.split(", ")]
    schema = pa.schema([(x.split()[0], {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for x in kinds.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, offsets, lengths = (batch.column(k).to_pylist() for k in ("file", "offset", "length"))
            i = 0
            while i < len(files):
                j = i
                while j < len(files) and files[j] == files[i]:
                    j += 1
                reader = Reader(files[i])
                for start, end, within in coalesced(list(zip(offsets[i:j], lengths[i:j]))):
                    data = reader.read(start, end - start)
                    found = []
                    for k in within:
                        at = offsets[i + k] - start
                        one = parse_record(zlib.decompress(data[at : at + lengths[i + k]], 31))
                        found.append({n: one[n] for n in names})
                    yield pa.RecordBatch.from_pylist(found, schema=schema)
                reader.close()
                i = j

    slim = selected.select("file", "offset", "length")
    return slim.repartitionByRange(partitions_for(selected, INDEX_BYTES), "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, kinds)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read_archives(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
