import datetime
import decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.python_str import decimal_str, float_str, timestamp_str
from quern.operators import rows_in_range, select_rows, text_fields, with_row_id, with_row_index, with_source_text
from quern.plans import prepare

S = T.StringType()


def frame(spark, columns, *rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, k) for n, k in columns]))


@pytest.mark.parametrize(
    ("names", "row", "expected"),
    [
        (["text", "content"], (None, "c"), ("content", "c")),
        (["content", "text"], ("c", "t"), ("text", "t")),
        (["text", "title"], (" \t ", "T"), ("title", "T")),
        (["Text", "title"], ("A", "B"), ("Text,title", "A B")),
        (["title", "side", "width", "sentiment", "security"], ("t", "a", "b", "c", "d"), ("title", "t")),
        (["a", "b", "c"], (" x ", None, "y\n\nz"), ("a,c", "x y z")),
        (["url", "lang", "doc_id"], ("u", "l", "d"), (None, None)),
        (["Text", "text"], ("A", "b"), ("text", "b")),
        (["a.b", "c,d", "e`f"], ("1", "2", "3"), ("a.b,c,d,e`f", "1 2 3")),
        (["text"], ('"""%s{}\\"',), ("text", '"""%s{}\\"')),
    ],
)
def test_best_text(spark, names, row, expected):
    found = with_source_text(frame(spark, [(n, S) for n in names], row)).collect()[0]
    assert (found[-2], found[-1]) == expected


def test_only_strings_are_text(spark):
    assert with_source_text(frame(spark, [("text", T.IntegerType()), ("body", S)], (5, "b"))).collect()[0][-2:] == ("body", "b")
    assert with_source_text(frame(spark, [("text", T.ArrayType(S)), ("note", S)], (["x"], "n"))).collect()[0][-2:] == ("note", "n")
    inner = T.StructType([T.StructField("text", S)])
    assert with_source_text(frame(spark, [("nested", inner)], (("t",),))).collect()[0][-2:] == (None, None)
    assert text_fields(T.StructType()).preferred == ()


def test_empty_table(spark):
    assert with_source_text(frame(spark, [("text", S)])).collect() == []


@pytest.mark.parametrize(
    ("kind", "value", "text"),
    [
        (S, "", ""),
        (T.LongType(), 0, "0"),
        (T.BooleanType(), False, "False"),
        (T.DoubleType(), 1e20, "1e+20"),
        (T.BinaryType(), b"ab", "b'ab'"),
        (T.DateType(), datetime.date(2020, 1, 2), "2020-01-02"),
        (T.DecimalType(5, 2), decimal.Decimal("1.50"), "1.50"),
    ],
)
def test_row_id_is_pythons_text(spark, kind, value, text):
    df = frame(spark, [("row_index", T.LongType()), ("id", kind), ("doc_id", T.LongType())], (3, value, 7), (4, None, 7), (5, None, None))
    assert [r[-1] for r in with_row_id(df).orderBy("row_index").collect()] == [text, "7", "5"]


def test_row_id_of_any_float(spark):
    import pandas as pd

    rng = np.random.default_rng(7)
    bits = rng.integers(0, 2**64, 30_000, dtype=np.uint64).view(np.float64)
    some = [0.0, -0.0, 1e16, 1e15, 1e17 + 16, 123456789012345680.0, 9.1e15, 9007199254740993.0, 1e-4, 9.999e-5, 1e-5, 5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan"), 1e23, 8.41e21, 2e-3, 1e22, -2.1493223164041044e18]
    x = np.concatenate([rng.random(5000) * 1e3, np.round(rng.random(5000) * 1e6, 2), 10.0 ** rng.integers(-30, 30, 500), rng.integers(-(9 * 10**17), 9 * 10**17, 5000).astype(float), some])
    found = lambda v: [(r.v, r.s) for r in spark.createDataFrame(pd.DataFrame({"v": v})).select("v", float_str(F.col("v")).alias("s")).collect()]
    assert [(v, s) for v, s in found(x) if s != str(v)] == []
    wrong = [(v, s) for v, s in found(bits) if s != str(v)]
    assert len(wrong) <= 6 and all(float(s) == v and len(s) == len(str(v)) for v, s in wrong)
    assert [r.s for r in spark.createDataFrame([(0.1,), (1e10,), (None,)], "f float").select(float_str(F.col("f")).alias("s")).collect()] == [str(float(np.float32(0.1))), "10000000000.0", None]
    df = spark.range(3).select(F.col("id").alias("row_index"), (F.col("id") * 1e20).alias("id"))
    assert "Python" not in with_row_id(df)._jdf.queryExecution().executedPlan().toString()


def test_row_id_of_decimals_and_times(spark):
    from datetime import datetime
    from decimal import Decimal

    values = [Decimal(x) for x in ("0", "1", "-1.5", "0.0000001", "-0.00000012", "0.000001", "123456789.1234567890", "0.0000000001")]
    for scale in (0, 2, 6, 7, 10):
        df = spark.createDataFrame([(v,) for v in values], "d decimal(30,10)").coalesce(1).select(F.col("d").cast(f"decimal(28,{scale})").alias("d"))
        assert [r.s for r in df.select(decimal_str(F.col("d"), scale).alias("s")).collect()] == [str(v.quantize(Decimal(1).scaleb(-scale)) + 0) for v in values]
    times = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert all(r.s == str(r.t) for r in df.select("t", timestamp_str(F.col("t")).alias("s")).collect())


def test_ordinal_of_frames_that_are_no_files(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 37 % 1000).alias("Id"), (F.col("id") % 10).alias("id"))
    found = with_row_index(df, ["Id"])
    assert sorted((r[0], r[1]) for r in found.collect()) == [(i, i) for i in range(1000)] and found.columns == ["row_index", "Id", "id"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan
    own = with_row_index(df)
    assert [r[1] for r in sorted(own.collect())] == [r[0] for r in df.collect()]
    ties = with_row_index(df, ["id"])
    assert sorted(ties.collect()) == sorted(ties.collect()) and [r[2] for r in sorted(ties.collect())] == [i // 100 for i in range(1000)]
    assert with_row_index(df.where("false"), ["Id"]).collect() == []


def test_ordinal_over_files(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id as string) as text")
    for k in range(3):
        df.where(f"id div 34 = {k}").coalesce(1).write.parquet(f"{tmp_path}/p/k={k}")
    rows = with_row_index(spark.read.parquet(f"{tmp_path}/p")).collect()
    assert sorted((r.row_index, r.id) for r in rows) == [(i, i) for i in range(100)]


@pytest.mark.parametrize("kind", ["parquet", "json", "csv", "orc"])
def test_ranges_over_files(spark, tmp_path, kind):
    spark.range(300).selectExpr("id", "cast(id as string) as Text").repartitionByRange(6, "id").sortWithinPartitions("id").write.format(kind).save(f"{tmp_path}/f")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")  # files are split, and several files are in a task
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = spark.read.schema("id long, Text string").format(kind).load(f"{tmp_path}/f")
        assert sorted((r.row_index, r.id, r.Text) for r in with_row_index(df).collect()) == [(i, i, str(i)) for i in range(300)]
        for start, most in ((0, None), (0, 5), (100, 7), (40, 200), (-5, 20), (295, None), (300, 3), (10, 0), (10, -3), (10**9, None)):
            stop = 300 if most is None else start + most
            assert sorted((r.row_index, r.id) for r in rows_in_range(df, start, most).collect()) == [(i, i) for i in range(max(0, start), min(300, stop))]
        plan = with_row_index(df)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ExistingRDD" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_skip_files(spark, tmp_path):
    spark.range(300).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(f"{tmp_path}/f")
    df = rows_in_range(spark.read.parquet(f"{tmp_path}/f"), 120, 3)
    assert [r.id for r in df.collect()] == [120, 121, 122]
    execution = df._jdf.queryExecution()
    plan = execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(_tmp_metadata_row_index" in plan and "LessThan(_tmp_metadata_row_index" in plan
    scan = execution.executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    execution.executedPlan().execute().count()
    assert scan.metrics().get("numFiles").get().value() == 1


def test_ordinal_of_other_frames(spark, tmp_path):
    spark.range(10).coalesce(2).selectExpr("cast(9 - id as string) as text").write.text(f"{tmp_path}/t")
    rows = with_row_index(spark.read.text(f"{tmp_path}/t").withColumnRenamed("value", "text"), ["text"]).collect()
    assert [(r.row_index, r.text) for r in sorted(rows)] == [(i, str(i)) for i in range(10)]


def test_ordinal_with_clashing_names(spark, tmp_path):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        frame(spark, [("Text", S), ("text", S)], ("A", "b")).write.parquet(f"{tmp_path}/c")
        df = spark.read.parquet(f"{tmp_path}/c")
        assert prepare(df).collect()[0].source_text == "b"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize(("start", "most", "expected"), [(0, None, range(10)), (0, 0, []), (5, 3, [5, 6, 7]), (-5, 8, [0, 1, 2]), (5, -1, []), (10**9, None, [])])
def test_row_range(spark, tmp_path, start, most, expected):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/r")
    found = select_rows(with_row_index(spark.read.parquet(f"{tmp_path}/r")), start, most)
    assert sorted(r.row_index for r in found.collect()) == list(expected)


def test_range_reaches_the_scan(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/r")
    plan = select_rows(with_row_index(spark.read.parquet(f"{tmp_path}/r")), 2, 3)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [GreaterThanOrEqual(_tmp_metadata_row_index,2), LessThan(_tmp_metadata_row_index,5)]" in plan
