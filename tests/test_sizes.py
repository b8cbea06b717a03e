"""What a task holds doesn't grow with the tables."""

import os

import pytest

from quern import queries
from quern.queries import QUERIES

SF = os.environ.get("QUERN_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", ["parse_qa", "run_summary", "status_breakdown"])
def test_replies_are_parsed_in_small_batches(spark, name):
    keys = [f"spark.sql.execution.arrow.{x}" for x in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "10000")
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert int(spark.conf.get(keys[0])) <= 1000 and int(spark.conf.get(keys[1])) <= 16 << 20
        assert "ArrowEvalPython" in plan
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["row_ordinal_json", "row_range_json", "row_ordinal_many_files", "row_range_many_files"])
def test_files_of_large_tables_are_more(spark, name, tmp_path, monkeypatch):
    """One task writes a file, so there are more of them, not larger ones; ordinals go through all."""
    monkeypatch.setattr(queries, "_folder", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "FILE_BYTES", 1 + os.path.getsize(f"{SF}/documents.parquet") // 12, raising=False)
    found = QUERIES[name](spark, SF).orderBy("row_index").collect()
    assert len([x for d in tmp_path.iterdir() for x in d.glob("part-*")]) == 12
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id").collect()
    rows = [(i, r.doc_id) for i, r in enumerate(docs)]
    assert [(r.row_index, r.doc_id) for r in found] == (rows if "ordinal" in name else rows[30:141])


def test_ordered_parts_of_large_tables_are_more(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_folder", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "FILE_BYTES", 1 + os.path.getsize(f"{SF}/documents.parquet") // 12, raising=False)
    found = queries.records_in_order(spark, SF).orderBy("position").collect()
    assert len(list((tmp_path / "ordered").glob("part-*"))) == 12
    lines = [r.line for r in queries.generate_offline(spark, SF).orderBy("row_index").collect()]
    assert [(r.position, r.line) for r in found] == list(enumerate(lines))


def test_quality_is_fitted_off_the_driver(spark, monkeypatch):
    """The driver holds no chunks: its own fit is never called."""
    quality = pytest.importorskip("quern.llm.quality")
    monkeypatch.setattr(quality.ByteConv, "fit", None)
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    assert quality.fit_quality(docs, labels).tables.any()


def test_stream_files_of_large_tables_are_more(spark, tmp_path, monkeypatch):
    """Written side by side, yet in the order of rows by their times."""
    monkeypatch.setattr(queries, "_folder", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "FILE_BYTES", 1 + os.path.getsize(f"{SF}/documents.parquet") // 12, raising=False)
    found = sorted(r.line for r in queries.stream_row_range(spark, SF).collect())
    files = sorted((tmp_path / "stream/in").glob("part-*"), key=lambda x: x.stat().st_mtime)
    assert len(files) == 12 and files == sorted(files) and len({x.stat().st_mtime for x in files}) == 12
    assert found == sorted(r.line for r in queries.generate_offline(spark, SF).where("row_index >= 100 and row_index < 250").collect())
    texts = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert [r.text for x in files for r in spark.read.parquet(str(x)).collect()] == [r.text for r in texts]
