"""What a model replied, kept outside of the tasks that asked.

A reply is filed under the SHA-256 of what it answers: the model's settings and the prompt. A task adds its replies to files of its own,
EVERY at a time or each SECONDS, under the run's and its partition's name. If it dies, the task that is run in its place reads them before it asks;
so what is asked again is what was in flight or not yet written. A later run, of whatever partitions, joins all that is filed.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import files_in, store_of, whole_file

#: Replies in a file, at most, and seconds that a reply waits for others.
EVERY, SECONDS = 64, 5.0


def reply_key_of(backend: object) -> str:
    """What tells one backend's replies from another's: its kind and settings, but neither its key nor its address or patience."""
    own = {k: v for k, v in vars(backend).items() if k not in ("api_key", "api_base", "timeout_seconds") and isinstance(v, (str, int, float, bool, type(None)))}
    return json.dumps([type(backend).__name__, own], sort_keys=True)


def with_known_replies(df: DataFrame, log: str, backend: object, prompt: str = "prompt") -> DataFrame:
    """df with __reply, what the log has for the row's prompt, else null."""
    try:
        known = df.sparkSession.read.schema("key string, reply string").option("recursiveFileLookup", True).parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return df.withColumn("__reply", F.lit(None).cast("string"))  # nothing was filed yet
    known = known.groupBy(F.col("key").alias("__key")).agg(F.first("reply").alias("__reply"))
    keyed = df.withColumn("__own", F.sha2(F.concat(F.lit(reply_key_of(backend) + "\n"), F.col(prompt)).cast("binary"), 256))
    return keyed.join(known, F.col("__own") == F.col("__key"), "left").drop("__own", "__key")


class TaskLog:
    """A task's part of the log, on its executor. It holds its partition's replies of earlier attempts, which its partition bounds."""

    def __init__(self, log: str, run_id: str, settings: str) -> None:
        self.folder, self.settings = f"{log.rstrip('/')}/run-{run_id}/{TaskContext.get().partitionId():06d}", settings
        self.old: dict[str, str] = {}
        self.new: list[tuple[str, str]] = []
        self.since = time.monotonic()
        for uri in files_in(self.folder):
            store, path = store_of(uri)
            with store.open_input_file(path) as f:
                found = pq.read_table(f)
            self.old.update(zip(found.column("key").to_pylist(), found.column("reply").to_pylist()))

    def key(self, prompt: str) -> str:
        return hashlib.sha256(f"{self.settings}\n{prompt}".encode()).hexdigest()

    def found(self, key: str) -> str | None:
        return self.old.get(key)

    def add(self, key: str, reply: str) -> None:
        try:
            reply.encode()
        except UnicodeEncodeError:
            return  # a lone surrogate has no place in a file
        self.new.append((key, reply))
        if len(self.new) >= EVERY or time.monotonic() - self.since >= SECONDS:
            self.flush()

    def flush(self) -> None:
        if self.new:
            with whole_file(f"{self.folder}/{uuid.uuid4().hex}.parquet") as out:
                pq.write_table(pa.table({"key": [k for k, _ in self.new], "reply": [r for _, r in self.new]}), out)
        self.new, self.since = [], time.monotonic()
