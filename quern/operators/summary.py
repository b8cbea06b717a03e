"""Counts of runs and datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .inference import WRITTEN


def run_summary(statuses: DataFrame) -> DataFrame:
    """One row: how many rows were written and how many skipped, of whatever cause."""
    return statuses.agg(F.count_if(F.col("status") == WRITTEN).alias("written"), F.count_if(F.col("status") != WRITTEN).alias("skipped"))


def status_breakdown(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count("*").alias("rows"))


def skip_causes(statuses: DataFrame, most: int = 20) -> DataFrame:
    """The commonest causes that rows were skipped of: status, error (its first 200 characters), rows. A report of at most so many rows."""
    causes = statuses.where(F.col("status") != WRITTEN).groupBy("status", F.substring("error", 1, 200).alias("error")).agg(F.count("*").alias("rows"))
    return causes.orderBy(F.desc("rows"), "status", "error").limit(most)


#: Causes that are reported, and different ones that are told apart while they are counted (beyond that, their numbers are estimates).
MOST_CAUSES, TRACKED_CAUSES = 20, 10_000


def counted(statuses: DataFrame, seen: Observation) -> DataFrame:
    """statuses, of which seen will know run_summary and the commonest skip_causes when they have been written: no pass of their own.

    Spark adds up what tasks saw that ended well, so a task that is run again counts once.
    """
    written, cause = F.col("status") == WRITTEN, F.concat_ws(": ", "status", F.substring("error", 1, 200))
    top = F.call_function("approx_top_k", F.when(~written, cause), F.lit(MOST_CAUSES), F.lit(TRACKED_CAUSES))
    return statuses.observe(seen, F.count_if(written).alias("written"), F.count_if(~written).alias("skipped"), top.alias("causes"))


def counts_of(seen: Observation) -> tuple[dict[str, int], list[tuple[str, int]]]:
    """(written and skipped, (cause, rows) with the commonest first), once the observed frame has been written."""
    found = seen.get
    causes = [(r["item"], r["count"]) for r in found.get("causes") or [] if r["item"] is not None]
    return {k: found.get(k, 0) for k in ("written", "skipped")}, sorted(causes, key=lambda x: (-x[1], x[0]))


def dataset_profile(df: DataFrame, name: str) -> DataFrame:
    """One row: the dataset's name, its number of rows and its columns. Reads no column."""
    return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows", F.lit(",".join(df.columns)).alias("columns"))
