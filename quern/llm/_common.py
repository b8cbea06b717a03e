"""What the training-data operators share: input columns, shared scratch tables, row batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_bytes, shared_root, small_batches

#: Of a table's files, the bytes that one partition of a shuffle takes.
PARTITION_BYTES, MOST_PARTITIONS = 64 << 20, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, opened by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(df: DataFrame, name: str) -> int:
    """Where the column of this exact name is (else of this name in another case); the first, if it repeats."""
    found = [i for i, c in enumerate(df.columns) if c == name] or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name!r} in {df.columns}")
    return found[0]


def by_place(df: DataFrame) -> DataFrame:
    """The columns named c0, c1 and so on, so that names that clash don't matter."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, whatever other columns are called."""
    return by_place(df).select(*(F.col(f"c{position(df, n)}").alias(n) for n in names))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under the application's own name; see clear_scratch."""
    return f"{shared_root(spark)}/quern/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df as a written table in the shared folder: its lineage is cut, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def settled(df: DataFrame) -> DataFrame:
    """df itself if its tasks see their rows in the same order whenever they run, as scans do; after a shuffle, a stored copy."""
    return stored(df, "settled") if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def discard(*frames: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in frames:
        _delete(df.sparkSession, df.stored_at)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all that this application's operators stored. Frames that they returned, and that aren't written yet, can't be read after."""
    _delete(spark, f"{shared_root(spark)}/quern/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def partitions_for(df: DataFrame, each: int = PARTITION_BYTES) -> int:
    """How many partitions to deal a scan's rows to: as the session has it, but more where that would make them large.

    The planner coalesces what it deals by itself; what is dealt to a number of partitions it doesn't split.
    """
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-file_bytes(df) // each), MOST_PARTITIONS))


#: Keys that join_hot broadcasts, at most.
HOT = 1000


def join_hot(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """rows joined with table (one row for each key), of which a key meets weight rows at most and all weights add up to total at most.

    Keys of more than one row in HOT of all, which are fewer than HOT, are broadcast; rows of others meet in a shuffle, so none is hot there.
    """
    hot, rest = (table.where(F.col(weight) * HOT > total).drop(weight), table.where(F.col(weight) * HOT <= total).drop(weight))
    first = rows.join(F.broadcast(hot), key)
    return first.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key).select(*first.columns))


def lower_az(c: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each have most_bytes or so (one long text can have more)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = [x or 0 for x in pa.compute.binary_length(batch.column(column)).to_pylist()]
        start = total = 0
        for i, n in enumerate(lengths):
            if i > start and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether a row is in the held-out fold: crc32 of its id as text, modulo folds. A null id is not."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(False))
