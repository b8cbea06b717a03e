"""Named datasets, as folders or files under a root that Spark can read."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .remote import ROW_INDEX, read_remote

LOG = logging.getLogger("quern.datasets")
FORMATS = ("parquet", "json", "csv", "text", "orc")
_SUFFIXES = {"parquet": ("parquet",), "json": ("jsonl", "json"), "csv": ("csv",), "text": ("txt",), "orc": ("orc",)}


class NoDataFiles(FileNotFoundError):
    """The dataset has no file of a known format for the split."""


def parse_dataset_list(text: str | None) -> list[str]:
    """Names between commas; spaces go, and so do empty names."""
    return [x for x in (text or "").replace(" ", "").split(",") if x]


def find_split(spark: SparkSession, root: str, dataset: str, split: str = "train") -> tuple[str, str]:
    """(path, format) of a dataset's split, found through Hadoop's file system, so in any store that Spark reads.

    Looked for, in this order: <root>/<dataset>/<split>.<suffix>, <root>/<dataset>/<split>/ with such files, and
    <root>/<dataset>.<suffix>, a dataset of one split.
    """
    jvm = spark.sparkContext._jvm
    base = f"{root.rstrip('/')}/{dataset}" if root else dataset
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    exists = lambda p: fs.exists(jvm.org.apache.hadoop.fs.Path(p))
    for name in (f"{base}/{split}", base):
        for kind in FORMATS:
            for suffix in _SUFFIXES[kind]:
                if exists(f"{name}.{suffix}"):
                    return f"{name}.{suffix}", kind
    for folder in (f"{base}/{split}", base):
        if exists(folder):
            names = [f.getPath().getName() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder))]
            for kind in FORMATS:
                if any(n.endswith(tuple(f".{s}" for s in _SUFFIXES[kind])) for n in names):
                    return folder, kind
    raise NoDataFiles(f"no data files for {dataset!r}, split {split!r}, under {root!r}")


Reader = Callable[..., DataFrame]
_READERS: dict[str, Reader] = {}


def register_reader(prefix: str, reader: Reader | None) -> None:
    """From now on datasets named <prefix>:<name> are read by reader(spark, name, split, revision=..., token=...); None takes it back.

    For datasets that aren't files under a root: a hub's client, a catalog. http and https are built in; see remote.
    """
    if reader is None:
        _READERS.pop(prefix, None)
    else:
        _READERS[prefix] = reader


def _web(scheme: str) -> Reader:
    def read(spark: SparkSession, name: str, split: str, revision: str | None = None, token: str | None = None) -> DataFrame:
        """http://host/path: the index at http://host/path/<split>.json, or the file itself if path names one."""
        address = f"{scheme}:{name}"
        return read_remote(spark, address if name.endswith((".parquet", ".jsonl", ".json")) else f"{address.rstrip('/')}/{split}.json", token=token).drop(ROW_INDEX)

    return read


_READERS.update({x: _web(x) for x in ("http", "https")})


def is_registered(dataset: str) -> bool:
    prefix, colon, _ = dataset.partition(":")
    return bool(colon) and prefix in _READERS


def read_dataset(spark: SparkSession, dataset: str, split: str = "train", root: str = "", fmt: str | None = None, revision: str | None = None, token: str | None = None) -> DataFrame:
    """The split's rows. fmt: the path <root>/<dataset> is of this format, and holds the split alone.

    revision, token: for registered readers; a revision of files is warned about, as there is none.
    """
    prefix, _, name = dataset.partition(":")
    if is_registered(dataset):
        return _READERS[prefix](spark, name, split, revision=revision, token=token)
    if revision:
        LOG.warning("%s: files have no revisions; %s is not looked at", dataset, revision)
    path, kind = (f"{root.rstrip('/')}/{dataset}" if root else dataset, fmt) if fmt else find_split(spark, root, dataset, split)
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    if kind == "text":
        return reader.text(path).withColumnRenamed("value", "text")
    return reader.format(kind).load(path)
