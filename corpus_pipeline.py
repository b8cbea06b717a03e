"""A corpus from raw documents, in five stages, each an operator of quern.llm.

Stages take (spark, docs, sf_dir) and return a DataFrame; each one's rows are written as Parquet and read
again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm._common import by_place, position, stored, table
from quern.llm.line_dedup import drop_lines, line_classes
from quern.llm.mixing import mix
from quern.llm.near_dedup import near_duplicates, text_hash
from quern.llm.packing import cut_documents, pack
from quern.llm.quality import THRESHOLD, fit_quality, score_quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject: those whose score, on the whole text, is THRESHOLD at least.

    The model is fitted to docs and the labels of sf_dir. A null text is scored as an empty one; rows that repeat are scored alike, and
    each is kept or goes. Labels of no document, null ids and other columns are not looked at. An empty table gives no rows.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored, names = score_quality(docs, model), docs.columns
    plain = by_place(scored)
    return plain.where(F.col(plain.columns[-1]) >= THRESHOLD).select(*plain.columns[:-1]).toDF(*names)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or an earlier line of their own, has.

    Null and blank texts stay as they are; a document of which no line is left goes. A null doc_id is the earliest.
    Rows that repeat doc_id and text are each left as one of them would be. An empty table gives no rows.
    """
    return drop_lines(docs, stored(line_classes(docs), "line-classes"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Each row is decided by itself, whatever other rows have its doc_id. Of a group, all rows that have the smallest doc_id
    stay, if it repeats in the group. Rows with a null doc_id go if any row of their group has one; a group
    without any stays whole. Null and empty texts are in no group, and stay. An empty table gives no rows; other columns
    stay as they are, whatever their names.
    """
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("__gone"), F.col("hash").alias("__hash")).distinct()
    d, names = by_place(docs), docs.columns
    id_, text = F.col(f"c{position(docs, 'doc_id')}"), F.col(f"c{position(docs, 'text')}")
    return d.join(gone, id_.cast("long").eqNullSafe(F.col("__gone")) & (text_hash(text) == F.col("__hash")), "left_anti").toDF(*names)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, in whole documents: each as many times as its source's schedule passes over it.

    A pass whose slots take at least half of a document's words gives the document; at most one document of a source
    is taken in part. Documents without words, and those that no slot reaches, are not in the mix. Rows
    that repeat a doc_id appear alike, the rounded mean number of times.
    """
    passes = mix(docs).groupBy("k", "bucket", "n", "passed").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum("words").alias("words"))
    taken = F.sum(F.when((F.col("size") > 0) & (2 * F.col("words") >= F.col("size")), 1).otherwise(0)).alias("times")
    times = passes.groupBy("k", "bucket", "n").agg(F.first("doc_id").alias("__id"), taken).groupBy("__id").agg(F.round(F.avg("times")).cast("int").alias("__times")).where("__times > 0")
    d, names = by_place(docs), docs.columns
    found = d.join(times, F.col(f"c{position(docs, 'doc_id')}").eqNullSafe(F.col("__id")))
    return found.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*d.columns).toDF(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids, with the sequence and the offset that each is packed at.

    A null or empty text is its end id alone. Rows that repeat, and those with a null doc_id, are documents of their own.
    An empty table gives no rows; other columns are not looked at.
    """
    import public_tokenizers

    pieces = stored(cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json")), "pieces")
    return pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("line_dedup", lines), ("near_dedup", near), ("mix", mixed), ("pack", packed)]

#: SQL has no classifier and no tokenizer: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
