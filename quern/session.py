"""A Spark session with the settings that plans here are made for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes in an Arrow batch sent to a Python worker; texts can be long, so the default of 10,000 rows is too many.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. In local mode, where that is unset, a temporary one; on a cluster that's an error, as executors would each write to their own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small, from now on in this session: plans look at these settings when they run."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).lower().removesuffix("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that a plan reads."""
    leaves, size = df._jdf.queryExecution().optimizedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        if leaves.apply(i).nodeName().startswith("LogicalRelation"):  # files, whose sizes are known
            size += int(str(leaves.apply(i).stats().sizeInBytes()))
    return size


def session(app: str = "quern", master: str | None = None, **conf: object) -> SparkSession:
    """Adaptive execution with skew joins; UTC; no speculation, which would call a model twice."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.speculation": "false"}
    for k, v in (settings | {k: str(v) for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
