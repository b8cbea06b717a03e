"""Datasets copied to Parquet once, to be read from there afterwards.

Beside a copy's data is what it was made of: the source's files with their sizes and times, and the schema. While that is so, the
copy isn't made again. A new copy is written beside the old one and then takes its place, so a fetch that is cut short leaves the old one readable; if it was cut
short between the two renames of that, the next fetch puts the old one back first.
"""

from __future__ import annotations

import json
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .datasets import NoDataFiles, find_split, is_registered, read_dataset
from .hadoop import Store

LOG = logging.getLogger("quern.prefetch")
REPORT = "dataset string, split string, status string, rows bigint, columns array<string>, error string"
#: What a copy was made of, in its folder; Spark reads no file of such a name.
ABOUT = "_about.json"


def _source(spark: SparkSession, name: str, split: str, root: str, revision: str | None, schema: str) -> dict | None:
    """What tells whether a source has changed; None if nothing does."""
    if is_registered(name):
        return {"revision": revision, "schema": schema} if revision else None
    path, _ = find_split(spark, root, name, split)
    return {"files": [list(x) for x in Store(spark).files(path)], "schema": schema}


def fetch_dataset(spark: SparkSession, name: str, cache: str, split: str = "train", root: str = "", revision: str | None = None, token: str | None = None) -> tuple[str, int, list[str]]:
    """(cached or unchanged, rows, columns) of one dataset's split, now at <cache>/<name>/<split>."""
    store, final = Store(spark), f"{cache.rstrip('/')}/{name}/{split}"
    new, old = f"{final}.new", f"{final}.old"
    if not store.exists(final) and store.exists(old):
        store.move(old, final)
    df = read_dataset(spark, name, split, root, revision=revision, token=token)
    source = _source(spark, name, split, root, revision, df.schema.json())
    if source and store.exists(f"{final}/{ABOUT}"):
        about = json.loads(store.read(f"{final}/{ABOUT}"))
        if about["source"] == source:
            return "unchanged", about["rows"], df.columns
    df.write.mode("overwrite").parquet(new)
    rows = spark.read.schema(df.schema).parquet(new).count()
    store.write(f"{new}/{ABOUT}", json.dumps({"source": source, "rows": rows}))
    if store.exists(final):
        store.delete(old)
        store.move(final, old)
    store.move(new, final)
    store.delete(old)
    return "cached", rows, df.columns


def prefetch_datasets(spark: SparkSession, datasets: list[str], cache: str, split: str = "train", root: str = "", revision: str | None = None, token: str | None = None, parallel: int = 4) -> DataFrame:
    """Each dataset's split to <cache>/<dataset>/<split>, and a report: dataset, split, status, rows, columns, error.

    parallel: datasets that are fetched side by side. One dataset's failure doesn't stop the others: its status is no_data_files or failed, else cached, or
    unchanged if the copy is of what is there. Without datasets there's a warning and an empty report; one that is named twice is fetched once.
    revision, token: for registered readers, of which an unchanged revision isn't fetched again; files under root have neither.
    """
    if not datasets:
        LOG.warning("no datasets requested")

    def one(name: str) -> tuple:
        try:
            status, rows, columns = fetch_dataset(spark, name, cache, split, root, revision, token)
            LOG.info("%s: %s, %d rows, columns %s", name, status, rows, columns)
            return name, split, status, rows, columns, None
        except NoDataFiles as e:
            LOG.warning("%s", e)
            return name, split, "no_data_files", None, None, str(e)
        except Exception as e:  # whatever one dataset fails of, the others are still fetched
            LOG.exception("%s can't be fetched", name)
            return name, split, "failed", None, None, f"{type(e).__name__}: {str(e)[:300]}"

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return spark.createDataFrame(list(pool.map(one, dict.fromkeys(datasets))), REPORT)
