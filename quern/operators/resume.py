"""Rows that earlier runs have not written, without looking at what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter for each known key, and its bits at least and at most (32 MB, which is broadcast).
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28


def key_filter(known: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap): a Bloom filter with one hash of the known keys, in rows of 4 KB."""
    at = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return known.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))


def without_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't among those of known (of the same name). A null key is never known.

    Rows that the filter says are surely new are not shuffled; the others, which are the known ones and a few besides, meet the keys
    in an anti-join. The rows' plan is run for either part, and each part goes on with its own rows alone.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (known.count() * BITS_PER_KEY).bit_length()))
    bitmaps = F.broadcast(key_filter(known, key, bits))
    own, at = [f"c{i}" for i in range(len(rows.columns))], F.col(f"c{rows.columns.index(key)}")
    place = F.pmod(F.xxhash64(at), F.lit(bits)) + 1
    bit = F.bitmap_bit_position("__at")
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    seen = rows.toDF(*own).withColumn("__at", place).join(bitmaps, F.bitmap_bucket_number("__at") == F.col("bucket"), "left")
    seen = seen.withColumn("__maybe", F.coalesce(F.call_function("getbit", byte, (bit % 8).cast("int")) == 1, F.lit(False)) & at.isNotNull())
    new = seen.where(~F.col("__maybe")).select(*own)
    maybe = seen.where("__maybe").select(*own).join(known.select(F.col(key).alias("__known")), at == F.col("__known"), "left_anti")
    return new.unionByName(maybe).toDF(*rows.columns)
