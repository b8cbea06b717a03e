"""The same stages on a stream of rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.extract import SOURCE_CHARS, with_row_id, with_source_text
from ..operators.inference import Backend
from ..operators.prompts import user_prompt
from ..operators.rows import numbered_stored, select_rows, stored, with_blocks
from ..plans.generate import prepare_numbered, records, statuses
from ..sources.hadoop import Store


def prepare_stream(rows: DataFrame, max_source_chars: int = SOURCE_CHARS) -> DataFrame:
    """As plans.prepare, of rows that have an id column: a stream by itself has no ordinal, and row_index is null. See generate_stream for one.

    Stateless, so no watermark and no state store.
    """
    numbered_ = rows.withColumn("__row_index", F.lit(None).cast("long"))
    texts = with_row_id(with_source_text(numbered_, max_source_chars, skip=("__row_index",)), "__row_index", "__row_id")
    return texts.select(F.col("__row_index").alias("row_index"), F.col("__row_id").alias("row_id"), "source_fields", "source_text", user_prompt(F.col("source_text")).alias("prompt"))


class Ordinals:
    """Of each micro-batch its first row's ordinal, kept beside the stream's checkpoint.

    A batch's record is written once its rows are numbered and never changes: a batch that is run again begins where it began before.
    Only the last KEPT records stay.
    """

    KEPT = 10

    def __init__(self, checkpoint: str) -> None:
        self.folder = f"{checkpoint.rstrip('/')}/ordinals"

    def _records(self, store: Store) -> list[int]:
        return sorted(int(n.removeprefix("batch-").removesuffix(".json")) for n in store.names(self.folder) if n.startswith("batch-"))

    def select(self, batch: DataFrame, number: int, start_row: int = 0, max_rows: int | None = None, by: int = 0) -> DataFrame | None:
        """The batch's rows whose ordinals are in the range (see select_rows), stored, with __row_index first; None if none can be, which counting the batch says. by: as of numbered_stored()."""
        store = Store(batch.sparkSession)
        before = [n for n in self._records(store) if n < number]
        first = json.loads(store.read(f"{self.folder}/batch-{before[-1]}.json"))["next"] if before else 0
        kept = stored(batch, f"{self.folder}/rows-{number}")
        stop = first + kept.count()
        store.write(f"{self.folder}/batch-{number}.json", json.dumps({"first": first, "next": stop}))
        if stop <= start_row or max_rows is not None and first >= start_row + max_rows:
            return None
        return select_rows(numbered_stored(kept, batch.columns, "__row_index", first, by), start_row, max_rows, "__row_index")

    def done(self, batch: DataFrame, number: int) -> None:
        """Forgets the batch's rows, and records of batches long ago."""
        store = Store(batch.sparkSession)
        store.delete(f"{self.folder}/rows-{number}")
        for n in self._records(store)[: -self.KEPT]:
            store.delete(f"{self.folder}/batch-{n}.json")


def generate_stream(
    rows: DataFrame, backend: Backend, out: str, checkpoint: str, dataset: str, split: str = "train", parallelism: int | None = None, start_row: int = 0, max_rows: int | None = None, max_source_chars: int = SOURCE_CHARS, log: str | None = None, **trigger
) -> StreamingQuery:
    """Asks the model about each micro-batch and writes its records to <out>/batch=<n>.

    A row's ordinal is its place in the stream: its place in its batch, and the rows of all batches before. Of a batch of files, which Spark
    takes in the order of their times, the rows are in that order too, then in that of paths. start_row and max_rows are of ordinals, over
    batches; a batch without any of them is counted alone. A batch that is run again after a failure has the ordinals
    that it had, if its source gives its rows in the same order (files and logs do), and overwrites its own folder, so each row's record is
    there once. log: as of infer().
    """
    ordinals = Ordinals(checkpoint)
    rows, by = with_blocks(rows)

    def write(batch: DataFrame, number: int) -> None:
        some = ordinals.select(batch, number, start_row, max_rows, by)
        if some is None:
            lines = batch.sparkSession.createDataFrame([], "line string")
        else:
            lines = records(statuses(prepare_numbered(some, max_source_chars), backend, parallelism, log=log), dataset, split)
        lines.select(F.col("line").alias("value")).write.mode("overwrite").text(f"{out.rstrip('/')}/batch={number}")
        ordinals.done(batch, number)

    stream = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return stream.trigger(**(trigger or {"availableNow": True})).start()
