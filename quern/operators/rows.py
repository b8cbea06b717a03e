"""Row ordinals and row ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_root

ROW_INDEX = "row_index"
#: Files and splits whose row counts are broadcast, or looked through on the driver, at most; beyond that they are joined.
MOST_BLOCKS = 100_000


def _has(df: DataFrame, column: str) -> bool:
    """Whether the frame is a plain scan of files that has this hidden column."""
    try:
        df.select(column).schema  # noqa: B018
    except Exception:  # the analyzer's error for other sources
        return False
    return True


def _placed(df: DataFrame) -> tuple[DataFrame, bool] | None:
    """A scan of files with its columns by place (names that differ only in case would be ambiguous), and each row's file, block and number; whether numbers begin at 0 in each block.

    A block is a file (Parquet, whose reader numbers rows) or a split of one (other formats, whose rows are numbered by the scan; the
    numbers of a block have no gaps).
    """
    if _has(df, "_metadata.row_index"):
        block, number = F.lit(0).cast("long"), F.col("_metadata.row_index")
    elif _has(df, "_metadata.file_block_start"):
        block, number = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    else:
        return None
    own = [f"c{i}" for i in range(len(df.columns))]
    placed = df.select("*", F.col("_metadata.file_path").alias("f"), block.alias("b"), number.alias("r")).toDF(*own, "f", "b", "r")
    return placed, _has(df, "_metadata.row_index")


def _blocks(placed: DataFrame) -> DataFrame:
    """Of each block its rows and first number; a pass that reads no column."""
    return placed.select("f", "b", "r").groupBy("f", "b").agg(F.count("*").alias("rows"), F.min("r").alias("first"))


def _are_few(df: DataFrame) -> bool:
    """Whether there are so few files and splits that a row for each is surely small."""
    return len(df.inputFiles()) + df.rdd.getNumPartitions() <= MOST_BLOCKS


def with_row_index(df: DataFrame, order_by: list[str] | None = None, name: str = ROW_INDEX) -> DataFrame:
    """df with the row's 0-based place in the whole dataset as its first column.

    A scan of files: the place in its block, added to the rows of all blocks before it, in the order of paths;
    no shuffle, after a count that reads no column. Other frames: the place in their own order, or in that of order_by (rows that are equal
    in all of it are in any order, but the same one whenever the result is read); see numbered().
    """
    found = _placed(df) if order_by is None else None
    if found:
        placed, zero = found
        own = placed.columns[:-3]
        if zero and len(df.inputFiles()) == 1:
            return placed.select("r", *own).toDF(name, *df.columns)
        # A row for each block.
        before = Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)
        blocks = _blocks(placed).select(F.col("f").alias("f2"), F.col("b").alias("b2"), (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("before"))
        joined = placed.join(F.broadcast(blocks) if _are_few(df) else blocks, (F.col("f") == F.col("f2")) & (F.col("b") == F.col("b2")))
        return joined.select(F.col("before") + F.col("r"), *own).toDF(name, *df.columns)
    path = f"{shared_root(df.sparkSession)}/quern/ordinals-{uuid.uuid4().hex[:12]}"
    if order_by:
        # By place: names that differ only in case would be ambiguous.
        plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
        df = plain.orderBy(*(f"c{df.columns.index(n)}" for n in order_by)).toDF(*df.columns)
    return numbered(df, path, name)


#: A row's number in its partition is below 2 to this; above it is the partition's.
_PLACE_BITS = 33


def numbered(df: DataFrame, path: str, name: str = ROW_INDEX) -> DataFrame:
    """df, stored at path, with the row's place in it as its first column; all in the JVM.

    Partitions are written with each row's partition and place in it; the rows of partitions before are added, a row for each partition. It is
    stored as a frame that is shuffled may have its rows in another order the next time.
    """
    return numbered_stored(stored(df, path), df.columns, name)


def stored(df: DataFrame, path: str) -> DataFrame:
    """df, written to path, with columns by place (c0 and so on) and each row's partition and place in it as m."""
    own = [f"c{i}" for i in range(len(df.columns))]
    df.toDF(*own).select("*", F.monotonically_increasing_id().alias("m")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.toDF(*own).select("*", F.lit(0).cast("long").alias("m")).schema).parquet(path)


def numbered_stored(kept: DataFrame, columns: list[str], name: str = ROW_INDEX, base: int = 0, by: int = 0) -> DataFrame:
    """What stored() gave, under its columns' names, with the row's place in it, from base on, as its first column.

    by: the last columns, so many, order its blocks of rows instead (see with_blocks) and are left out. Where a block's rows don't lie side by
    side in one partition, as after a shuffle, they say nothing of the order within it, and rows stay in that of partitions.
    """
    own = kept.columns[:-1]
    shown, few = len(own) - by, len(kept.inputFiles()) <= MOST_BLOCKS

    def blocks_by(keys: dict) -> DataFrame:
        return kept.groupBy(*(c.alias(k) for k, c in keys.items())).agg(F.count("*").alias("n"), F.min("m").alias("first"), F.max("m").alias("last"))

    keys = {f"k{i}": F.col(c) for i, c in enumerate(own[shown:])}
    if by:
        found = blocks_by(keys).agg(F.count("*").alias("blocks"), F.count_if(F.col("last") - F.col("first") >= F.col("n")).alias("torn")).first()
        few = found.blocks <= MOST_BLOCKS
    if not by or found.torn:
        keys, few = {"k0": F.shiftright("m", _PLACE_BITS)}, len(kept.inputFiles()) <= MOST_BLOCKS
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # Of each block what is to be added to m.
    blocks = blocks_by(keys).select(*keys, (F.coalesce(F.sum("n").over(before), F.lit(0)) + base - F.col("first")).alias("before"))
    same = [c.eqNullSafe(F.col(k)) for k, c in keys.items()]
    joined = kept.join(F.broadcast(blocks) if few else blocks, same)
    return joined.select(F.col("before") + F.col("m"), *own[:shown]).toDF(name, *columns[:shown])


def with_blocks(df: DataFrame) -> tuple[DataFrame, int]:
    """df with columns behind its own that order its blocks (files, or splits of files) by time, path and place, if it is a scan of files; how many.

    Spark gives tasks the larger splits first, so a scan of several files has its rows in another order than its files.
    """
    if not _has(df, "_metadata.file_block_start"):
        return df, 0
    at = {"__time": F.unix_millis("_metadata.file_modification_time"), "__file": F.col("_metadata.file_path"), "__start": F.col("_metadata.file_block_start")}
    return df.select("*", *(c.alias(k) for k, c in at.items())), len(at)


def select_rows(df: DataFrame, start_row: int = 0, max_rows: int | None = None, name: str = ROW_INDEX) -> DataFrame:
    """Rows whose ordinal is in [start_row, start_row + max_rows); max_rows counts rows looked at, usable or not.

    A filter on the ordinal, the same however tasks run.
    """
    out = df.where(F.col(name) >= start_row)
    return out if max_rows is None else out.where(F.col(name) < start_row + max_rows)


def rows_in_range(df: DataFrame, start_row: int = 0, max_rows: int | None = None, name: str = ROW_INDEX) -> DataFrame:
    """select_rows(with_row_index(df), ...), reading only files that the range reaches.

    The blocks' row counts, which are taken first, say which these are; in one Parquet file the range is a filter that reaches the
    reader.
    """
    found = _placed(df) if start_row > 0 or max_rows is not None else None
    if not found or found[1] and len(df.inputFiles()) == 1 or not _are_few(df):
        return select_rows(with_row_index(df, name=name), start_row, max_rows, name)
    stop, total, before, wanted = None if max_rows is None else start_row + max_rows, 0, 0, []
    # A row for each file, of which there are few.
    for x in sorted(_blocks(found[0]).groupBy("f").agg(F.sum("rows").alias("rows")).collect(), key=lambda x: x.f):
        if total + x.rows > start_row and (stop is None or total < stop):
            before = before if wanted else total
            wanted.append(x.f)
        total += x.rows
    if not wanted:
        return with_row_index(df, name=name).where("false")
    some = df.where(F.col("_metadata.file_path").between(wanted[0], wanted[-1]))
    if found[1] and len(wanted) == 1:
        # Bounds of the place in the file itself, so that they reach the reader.
        placed, _ = _placed(some)
        own = placed.columns[:-3]
        return select_rows(placed, start_row - before, max_rows, "r").select(F.col("r") + before, *own).toDF(name, *df.columns)
    numbered = with_row_index(some, name=name)
    plain = numbered.toDF("r", *(f"c{i}" for i in range(len(df.columns))))
    return select_rows(plain.withColumn("r", F.col("r") + before), start_row, max_rows, "r").toDF(*numbered.columns)
