"""JSON Lines: rendered lines appended to a folder, and its one-file copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import store_of
from .ordered import assemble, write_ordered


def default_output_name(dataset: str, model: str, job: str | None = None) -> str:
    """A file name with no slashes in it."""
    return f"synthetic_{dataset.replace('/', '_')}_{model.replace('/', '_')}_{job or 'manual'}.jsonl"


def write_jsonl(lines: DataFrame, path: str, column: str = "line") -> None:
    """Appends the lines to the folder at path, which is made if need be.

    Escaped line ends make a text sink safe. Spark's committer shows a task's lines all or not at all.
    """
    lines.select(F.col(column).alias("value")).write.mode("append").text(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The lines at path, as column line."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def export_single_file(lines: DataFrame, path: str, order_by: str, column: str = "line") -> str:
    """All lines in one file at path, in order, written side by side; see ordered. What was at path stays until the new file is whole."""
    parts = f"{path}.parts"
    write_ordered(lines, parts, order_by, column)
    assemble(lines.sparkSession, parts, path)
    store, at = store_of(parts)
    store.delete_dir(at)
    return path
