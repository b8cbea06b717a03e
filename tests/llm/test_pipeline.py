"""The corpus pipeline, stage by stage against brute force, and what the subpackage's queries register."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import by_force, distance, roots
from test_outputs import BYTE, force_targets, library

import corpus_pipeline
from quern.llm import quality
from quern.llm._common import stored
from quern.llm.line_dedup import DISTANCE, LEAST_CHARS
from quern.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and gave."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        found = stored(stage(spark, docs, SF), name)
        out[name] = (docs, found)
        docs = found
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_keep_the_columns(stages):
    names = list(stages)
    assert names == ["quality", "line_dedup", "near_dedup", "mix", "pack"]
    for name in names[:-1]:
        given, found = stages[name]
        assert found.columns == given.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert [f.dataType for f in found.schema.fields] == [f.dataType for f in given.schema.fields]


def test_quality_stage(spark, stages):
    given, found = stages["quality"]
    model = quality.fit_quality(given, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = rows(given)
    scores = quality.Scorer(model).probabilities([r["text"].encode() for r in texts])
    assert sorted(r["doc_id"] for r in rows(found)) == sorted(r["doc_id"] for r, p in zip(texts, scores) if p >= 0.7)


def test_line_stage(stages):
    given, found = (sorted(rows(x), key=lambda r: r["doc_id"]) for x in stages["line_dedup"])
    places = [(r["doc_id"], n, x) for r in given for n, x in enumerate(r["text"].split("\n")) if x.strip(" \t\n\v\f\r")]
    distinct = sorted({x for *_, x in places}, key=len)
    near = []
    for a, x in enumerate(distinct):
        for b in range(a - 1, -1, -1):
            if len(x) - len(distinct[b]) > DISTANCE:
                break
            y = distinct[b]
            # A quick test that no near pair fails: most of one half of a line is in the other.
            if len(y) >= LEAST_CHARS and any(y[i : i + len(y) // 3] in x for i in (0, len(y) // 3, 2 * (len(y) // 3))) and distance(x, y) <= DISTANCE:
                near.append((a, b))
    root, first, drop = dict(zip(distinct, roots(len(distinct), near))), {}, set()
    for i, n, x in places:
        if first.setdefault(root[x], (i, n)) != (i, n):
            drop.add((i, n))
    wanted = []
    for r in given:
        text = "\n".join(x for n, x in enumerate(r["text"].split("\n")) if (r["doc_id"], n) not in drop)
        if text.strip() or not r["text"].strip():
            wanted.append(r | {"text": text, "n_chars": len(text) if text != r["text"] else r["n_chars"]})
    assert found == wanted


def test_near_stage(stages):
    given, found = (sorted(rows(x), key=lambda r: r["doc_id"]) for x in stages["near_dedup"])
    kept = {i for i, *_, keep in by_force([(r["doc_id"], r["text"]) for r in given]) if keep}
    assert found == [r for r in given if r["doc_id"] in kept]


def test_near_stage_decides_row_by_row(spark):
    """Ids that repeat with other texts, and null ids."""
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    given = [(1, a), (2, a + " more"), (2, b), (None, a.upper()), (None, "alone without an id"), (None, None), (3, b + " more"), (3, ""), (4, "two of"), (4, "two of"), (None, "twins"), (None, "Twins")]
    found = corpus_pipeline.near(spark, spark.createDataFrame(given, "doc_id long, text string"), SF)
    gone = [(2, a + " more"), (None, a.upper()), (3, b + " more")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted((r for r in given if r not in gone), key=str)


def test_mix_stage(stages):
    given, found = (rows(x) for x in stages["mix"])
    known, times, size = {r["doc_id"]: r for r in given}, Counter(r["doc_id"] for r in found), {}
    assert all(known[r["doc_id"]] == r for r in found) and max(times.values()) <= 3
    got = Counter()
    for r in given:
        n = len(r["text"].split())
        size[r["source"]] = size.get(r["source"], 0) + n
        got[r["source"]] += n * times[r["doc_id"]]
    longest = max(len(r["text"].split()) for r in given)
    for s, target in force_targets(size).items():
        assert abs(got[s] - target) <= 3 * 64 + longest / 2


def test_pack_stage(stages):
    given, found = (rows(x) for x in stages["pack"])
    ids, pieces = library(BYTE), Counter()
    wanted = Counter()
    for r in given:
        wanted[r["doc_id"], len(ids(r["text"])) + 1] += 1
    for r in found:
        pieces[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert {k: n * k[1] for k, n in wanted.items()} == dict(pieces)
    filled = Counter()
    for r in found:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and np.mean(list(filled.values())) > 0.9 * 2048


NAMES = ["doc_id", "text", "lang", "source", "n_chars", "Kept", "hash", "__id", "c0", "size", "key", "TEXT2"]


@pytest.fixture(scope="module")
def odd(spark):
    """The small documents and rows with nulls in each column, repeated ids and rows, blank and long texts; columns whose names clash with those in use."""
    text = " ".join(f"wort{i % 97} {i % 7}" for i in range(4000))
    rows = [(None, None, None, None, None), (900_001, None, "en", "a", 0), (900_002, "", "en", None, None), (900_003, " \n\t\n", None, "a", 4), (900_004, text, "en", "b", None), (900_004, text, "en", "b", None), (900_004, text + "\nanother line of this document, and more", "en", "b", 7), (None, "a text without an id, as short as this", "de", "b", 1), (None, "a text without an id, as short as this", "de", "b", 1)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    every = docs.unionByName(extra.select(*(F.col(f.name).cast(f.dataType) for f in docs.schema.fields)))
    return stored(every.select("*", *(F.lit(i).alias(n) for i, n in enumerate(NAMES[5:]))), "odd")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_odd_rows(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    found = stage(spark, odd, SF)
    if name == "pack":
        pieces, ids, wanted = Counter(), library(BYTE), Counter()
        for r in found.collect():
            pieces[r.doc_id, r.doc_tokens] += r.length
        for r in rows(odd):
            n = len(ids(r["text"])) + 1
            wanted[r["doc_id"], n] += n
        assert pieces == wanted
    else:
        assert found.columns == odd.columns == NAMES and found.schema.simpleString() == odd.schema.simpleString()
        given, got = Counter(map(str, odd.drop("text", "n_chars").collect())), Counter(map(str, found.drop("text", "n_chars").collect()))
        assert got.keys() <= given.keys() and all(n <= (3 if name == "mix" else 1) * given[k] for k, n in got.items())
        if name in ("line_dedup", "near_dedup"):
            ids = [r["doc_id"] for r in rows(found)]
            assert {900_001, 900_002, 900_003, 900_004} <= set(ids)
    assert stage(spark, odd.where("false"), SF).collect() == []


def test_run_is_the_stages_one_by_one(spark, stages):
    key = lambda r: str(sorted(r.items()))
    assert sorted(rows(corpus_pipeline.run(spark, SF)), key=key) == sorted(rows(stages["pack"][1]), key=key)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_against_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    wanted = c.sql(ORACLE_SQL[name])
    found = QUERIES[name](spark, SF)
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    at = [wanted.columns.index(x) for x in columns]
    assert sorted(map(str, (tuple(r[x] for x in columns) for r in found.collect()))) == sorted(map(str, (tuple(r[i] for i in at) for r in wanted.fetchall())))


def test_all_are_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() <= found.keys() and "pipeline" in found
    assert __spark_entry__.oracle_sql().keys() >= ORACLE_SQL.keys()


@pytest.mark.parametrize(("name", "label", "recalls"), [("op1_toxicity", "toxic", (0.99, 0.85)), ("op10_quality", "quality", (0.97, 0.98))])
def test_classifier_queries(spark, name, label, recalls):
    """Of held-out documents with either label, how many are found; and how many of those called 1 are."""
    sf = "/root/testdata/sf0.1"
    every = QUERIES[name](spark, sf)
    rows = every.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label), "doc_id").where("held_out").collect()
    for value, least in enumerate(recalls):
        own = [r for r in rows if r[label] == value]
        assert len(own) > 100 and sum(r.predicted == value for r in own) / len(own) >= least
    called = [r for r in rows if r.predicted]
    assert sum(r[label] for r in called) / len(called) >= 0.98
    assert every.where(~F.col("score").between(0, 1)).count() == 0 and all(r.predicted == (r.score >= 0.7) for r in rows)
