"""Datasets behind a web server, as a Spark data source: spark.read.format("quern").load(url).

The server need only answer ranges of bytes. A Parquet file's footer says where its row groups and columns are, so of a column list and a row range only
their bytes are asked for: columns by the option columns (or the schema that is read with), rows by filters on row_index, which
Spark pushes into the scan. JSON Lines files are cut by bytes; a part has the lines that begin in it. Parts are read side by side, on executors.

Path: a file, more of them between commas, an index (a .json of {"files": [...]}, names or addresses), or a folder of a file system that pyarrow knows.
"""

from __future__ import annotations

import http.client
import io
import json
import time
import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.json
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from .files import files_in, store_of

ROW_INDEX = "row_index"
#: Bytes of one part, about; bytes of a JSON Lines file that its schema is inferred from; attempts at a request, and bytes that are asked for at once.
PART_BYTES, INFERRED_BYTES, ATTEMPTS, READ_BYTES = 64 << 20, 1 << 20, 4, 1 << 20


class HttpFile(io.RawIOBase):
    """A remote file, of which ranges are read when they are wanted."""

    def __init__(self, url: str, token: str | None = None, timeout: float = 60.0) -> None:
        self.url, self.at = urllib.parse.urlsplit(url), 0
        self.headers = {"Authorization": f"Bearer {token}"} if token else {}
        self.timeout, self.connection = timeout, None
        _, headers = self._ask(0, 1)
        self.size = int(headers["Content-Range"].rpartition("/")[2])

    def _ask(self, first: int, n: int) -> tuple[bytes, http.client.HTTPMessage]:
        kind = http.client.HTTPSConnection if self.url.scheme == "https" else http.client.HTTPConnection
        target = (self.url.path or "/") + (f"?{self.url.query}" if self.url.query else "")
        for left in range(ATTEMPTS - 1, -1, -1):
            try:
                self.connection = self.connection or kind(self.url.netloc, timeout=self.timeout)
                self.connection.request("GET", target, headers=self.headers | {"Range": f"bytes={first}-{first + n - 1}"})
                answer = self.connection.getresponse()
                data = answer.read()
                if answer.status == 416 and not first:
                    return b"", {"Content-Range": "bytes */0"}
                if answer.status != 206:
                    raise FileNotFoundError(self.url.geturl()) if answer.status == 404 else OSError(f"HTTP {answer.status} for a range of {self.url.geturl()}")
                return data, answer.headers
            except (http.client.HTTPException, OSError) as e:
                self.connection = None
                if not left or isinstance(e, FileNotFoundError):
                    raise
                time.sleep(0.2 * (ATTEMPTS - left))
        raise AssertionError

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence]
        return self.at

    def read(self, n: int = -1) -> bytes:
        n = self.size - self.at if n is None or n < 0 else min(n, self.size - self.at)
        if n <= 0:
            return b""
        data, _ = self._ask(self.at, n)
        self.at += len(data)
        return data

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _open(url: str, token: str | None):
    if url.startswith(("http://", "https://")):
        return HttpFile(url, token)
    store, path = store_of(url)
    return store.open_input_file(path)


def _size(file) -> int:
    return file.size if isinstance(file, HttpFile) else file.size()


def files_of(path: str, token: str | None = None) -> list[str]:
    """Addresses of a path's files, in the dataset's order."""
    out = []
    for one in (x.strip() for x in path.split(",") if x.strip()):
        if one.endswith(".json"):
            file = _open(one, token)
            out += [urllib.parse.urljoin(one, x) if "://" in one else f"{one.rpartition('/')[0]}/{x}" for x in json.loads(file.read())["files"]]
        elif not one.startswith(("http://", "https://")) and store_of(one)[0].get_file_info(store_of(one)[1]).type == fs.FileType.Directory:
            out += files_in(one)
        else:
            out.append(one)
    return out


@dataclass
class Part(InputPartition):
    """Row groups of a Parquet file, the first row of each in the dataset, or bytes of a JSON Lines file."""

    file: str
    groups: tuple[int, ...] = ()
    firsts: tuple[int, ...] = ()
    begin: int = 0
    end: int = 0


class RemoteSource(DataSource):
    """Options: path; columns (names between commas); token; partition_bytes."""

    @classmethod
    def name(cls) -> str:
        return "quern"

    def _files(self) -> list[str]:
        found = files_of(self.options["path"], self.options.get("token"))
        if not found:
            raise FileNotFoundError(f"no files at {self.options['path']}")
        return found

    def schema(self) -> T.StructType:
        first = self._files()[0]
        file = _open(first, self.options.get("token"))
        if first.endswith(".parquet"):
            own = from_arrow_schema(pq.read_schema(pa.PythonFile(file, "r") if isinstance(file, HttpFile) else file))
            own = own.add(ROW_INDEX, T.LongType()) if ROW_INDEX not in own.names else own
        else:
            head = file.read(INFERRED_BYTES)
            head = head[: head.rfind(b"\n") + 1] or head
            own = from_arrow_schema(pyarrow.json.read_json(io.BytesIO(head)).schema) if head else T.StructType()
        wanted = [x.strip() for x in self.options.get("columns", "").split(",") if x.strip()]
        return T.StructType([own[x] for x in wanted]) if wanted else own

    def reader(self, schema: T.StructType) -> RemoteReader:
        return RemoteReader(self._files(), schema, self.options.get("token"), int(self.options.get("partition_bytes", PART_BYTES)))


class RemoteReader(DataSourceReader):
    def __init__(self, files: list[str], schema: T.StructType, token: str | None, part_bytes: int) -> None:
        self.files, self.schema, self.token, self.part_bytes = files, schema, token, part_bytes
        self.low, self.high = 0, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes bounds of row_index; hands back the rest."""
        for f in filters:
            value = getattr(f, "value", None)
            if not self.files[0].endswith(".parquet") or getattr(f, "attribute", None) != (ROW_INDEX,) or not isinstance(value, int):
                yield f
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self._upto(value + isinstance(f, LessThanOrEqual))
            elif isinstance(f, EqualTo):
                self.low = max(self.low, value)
                self._upto(value + 1)
            else:
                yield f

    def _upto(self, stop: int) -> None:
        self.high = stop if self.high is None else min(self.high, stop)

    def partitions(self) -> list[Part]:
        """Of each file's row groups those that the row range reaches, or its bytes; on the driver, which reads footers alone."""
        out, row = [], 0
        for name in self.files:
            file = _open(name, self.token)
            if not name.endswith(".parquet"):
                size = _size(file)
                n = max(1, -(-size // self.part_bytes))
                out += [Part(name, begin=size * i // n, end=size * (i + 1) // n) for i in range(n)]
                continue
            about = pq.read_metadata(pa.PythonFile(file, "r") if isinstance(file, HttpFile) else file)
            groups, firsts, held = [], [], 0
            for i in range(about.num_row_groups):
                group = about.row_group(i)
                if row + group.num_rows > self.low and (self.high is None or row < self.high) and group.num_rows:
                    groups.append(i)
                    firsts.append(row)
                    held += group.total_byte_size
                row += group.num_rows
                if groups and (held >= self.part_bytes or i == about.num_row_groups - 1):
                    out.append(Part(name, tuple(groups), tuple(firsts)))
                    groups, firsts, held = [], [], 0
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if part is None:  # Spark asks once even if there is no part
            return
        yield from self._rows(part) if part.groups else self._lines(part)

    def _rows(self, part: Part) -> Iterator[pa.RecordBatch]:
        names, wanted = self.schema.names, to_arrow_schema(self.schema)
        file = _open(part.file, self.token)
        parquet = pq.ParquetFile(pa.PythonFile(file, "r") if isinstance(file, HttpFile) else file, pre_buffer=True)
        own = [n for n in names if n in parquet.schema_arrow.names]
        for group, row in zip(part.groups, part.firsts):
            batches = parquet.iter_batches(1000, row_groups=[group], columns=own) if own else _blank(parquet.metadata.row_group(group).num_rows)
            for batch in batches:
                a, b = max(0, self.low - row), batch.num_rows if self.high is None else min(batch.num_rows, self.high - row)
                if a < b:
                    some = batch.slice(a, b - a)
                    index = pa.array(range(row + a, row + b), pa.int64())
                    yield pa.RecordBatch.from_arrays([(some.column(n) if n in own else index if n == ROW_INDEX else pa.nulls(b - a)).cast(wanted.field(n).type) for n in names], schema=wanted)
                row += batch.num_rows

    def _lines(self, part: Part) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        for block in _line_blocks(_open(part.file, self.token), part.begin, part.end):
            parsed = pyarrow.json.read_json(io.BytesIO(block), parse_options=pyarrow.json.ParseOptions(explicit_schema=wanted, unexpected_field_behavior="ignore"), read_options=pyarrow.json.ReadOptions(block_size=max(1 << 20, len(block) + 1)))
            yield from parsed.cast(wanted).to_batches()


def _blank(rows: int) -> Iterator[pa.RecordBatch]:
    for i in range(0, rows, 1000):
        yield pa.record_batch({"_": pa.nulls(min(1000, rows - i))})


def _line_blocks(file, begin: int, end: int) -> Iterator[bytes]:
    """Whole lines that begin from begin up to before end, about READ_BYTES at a time."""
    size = _size(file)
    # The byte before tells whether a line begins at begin.
    at, rest, skip = max(0, begin - 1), b"", begin > 0
    file.seek(at)
    while at < size:
        data = rest + file.read(min(READ_BYTES, size - at))
        at = file.tell()
        if skip:
            cut = data.find(b"\n") + 1
            if not cut:
                rest = b""
                continue
            data, skip = data[cut:], False
        start = at - len(data)
        if start >= end:
            return
        # Up to the end of the line that has the last byte before end.
        last = data.find(b"\n", max(0, end - 1 - start)) + 1 if at >= end else 0
        cut = last or (len(data) if at >= size else data.rfind(b"\n", 0, max(0, end - start)) + 1)
        if data[:cut].strip():
            yield data[:cut]
        if last or at >= size:
            return
        rest = data[cut:]


def read_remote(spark: SparkSession, path: str, columns: list[str] | None = None, token: str | None = None, partition_bytes: int = PART_BYTES) -> DataFrame:
    """The rows at path. Bounds of row_index that are filtered by afterwards reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RemoteSource)
    reader = spark.read.format("quern").option("partition_bytes", partition_bytes)
    for key, value in (("columns", ",".join(columns or [])), ("token", token)):
        reader = reader.option(key, value) if value else reader
    return reader.load(path)
