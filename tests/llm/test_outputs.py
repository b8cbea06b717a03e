"""Token files, packing, archives, neighbours and mixing: round trips and brute force."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quern.llm import neighbours, packing, token_output, tokenizing, warc
from quern.llm._common import scratch, stored
from quern.llm.mixing import MOST_TIMES, mix, source_targets, taken
from quern.llm.queries import QUERIES

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])
WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).select("doc_id", "text", "source", *(F.lit(i).alias(c) for i, c in enumerate(("ids", "start", "Size", "k", "piece", "target"))))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["some", "words", "are", "Common,", "other's", "rare%d" % rng.randint(0, 999), "né!"]) for _ in range(rng.choice([3, 40, 900]))), rng.choice("aaab") + rng.choice(["", "é"])) for i in range(150)]
    return [*rows, (150, None, None), (151, "", "a"), (152, " \n", None), (153, "x " * 9000, None), (154, "same", "a"), (154, "same", "a"), (None, "no id  here", "b")]


def library(path):
    t = Tokenizer.from_file(path)
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


ODD = st.lists(st.sampled_from([*"ab AB',.!1 \n\t\r\x1c\x85é×ß“́😀Ġ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "longer than sixteen".replace(" ", ""), "n't", "  "]), max_size=40).map("".join)


@pytest.mark.parametrize(("path", "white_space"), [(WORD, "drop"), (BYTE, "lead")])
def test_ids_are_the_librarys(path, white_space):
    ours, theirs = tokenizing.Ids(path, white_space), library(path)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(ODD, max_size=5))
    def check(texts):
        assert ours.of([t.encode() for t in texts]) == [np.array(theirs(t), "<u4").tobytes() for t in texts]

    check()


def test_ids_when_memory_turns_over(monkeypatch):
    monkeypatch.setattr(tokenizing, "REMEMBERED", 30)
    ours, theirs, rng = tokenizing.Ids(WORD, "drop"), library(WORD), random.Random(1)
    for _ in range(40):
        texts = [" ".join(f"w{rng.randint(0, 60)}x{'y' * rng.choice([1, 99])}" for _ in range(9)) for _ in range(3)]
        assert ours.of([t.encode() for t in texts]) == [np.array(theirs(t), "<u4").tobytes() for t in texts]


def test_table_of_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 40, (60_000, 2), np.uint64) * np.uint64(1 << 20), axis=0)
    table = tokenizing.Table(64)
    for i in range(0, len(keys), 7000):
        table.add(keys[i : i + 7000, 0], keys[i : i + 7000, 1], np.arange(i, min(len(keys), i + 7000), dtype=np.int32))
    assert (table.find(keys[:, 0], keys[:, 1]) == np.arange(len(keys))).all()
    assert (table.find(keys[:, 1], keys[:, 0])[keys[:, 0] != keys[:, 1]] == -1).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=30))
def test_variable_length_coding(numbers):
    control, data = token_output.encode_numbers(np.array(numbers, np.uint32))
    assert len(control) == -(-len(numbers) // 4) and len(data) == sum(max(1, (x.bit_length() + 7) // 8) for x in numbers)
    assert token_output.decode_numbers(control, data, len(numbers)).tolist() == numbers


@pytest.mark.parametrize("shard", [4_000_000, 500])
def test_token_files(spark, corpus, shard, monkeypatch):
    monkeypatch.setattr(token_output, "SHARD_NUMBERS", shard)
    folder, encode = scratch(spark, "t"), library(WORD)
    encoded = token_output.encode_texts(frame(spark, corpus), WORD)
    index = token_output.write_token_files(encoded, folder)
    found = token_output.read_token_files(index, folder).collect()
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found if r.doc_id is not None) == sorted((i, [*encode(t), 2]) for i, t, _ in corpus if i is not None)
    ordered = sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id, r.start))
    at = 0
    for r in ordered:
        assert r.start == at
        at += len(r.ids) // 4
    ranks = np.frombuffer((Path(folder.removeprefix("file://")) / "ranks").read_bytes(), "<u4")
    counts = {}
    for r in found:
        for x in np.frombuffer(r.ids, "<u4").tolist():
            counts[x] = counts.get(x, 0) + 1
    assert ranks.tolist() == sorted(counts, key=lambda x: (-counts[x], x))
    digest = token_output.digest(token_output.read_token_files(index, folder)).collect()
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in digest} == {(r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in found}


def test_token_files_of_nothing(spark):
    folder = scratch(spark, "t")
    index = token_output.write_token_files(token_output.encode_texts(frame(spark, []), WORD), folder)
    assert token_output.read_token_files(index, folder).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_first_fit_decreasing(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 20)
    free: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        k = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if k == len(free):
            free.append(20)
        assert (bins[i], offsets[i]) == (k, 20 - free[k])
        free[k] -= lengths[i]


@pytest.mark.parametrize("group_rows", [4096, 20])
def test_packing(spark, corpus, group_rows):
    encode = library(BYTE)
    pieces = stored(packing.cut_documents(frame(spark, corpus), BYTE, with_ids=True), "p")
    found = packing.pack(pieces, group_rows=group_rows).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * 2048
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    ids = {}
    for i, t, _ in corpus:
        ids.setdefault(i, []).append([*encode(t), 1])
    assert by_doc.keys() == ids.keys()
    for i, own in by_doc.items():
        own.sort(key=lambda r: (r.start, r.piece))
        if len(ids[i]) == 1:
            assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids[i][0] and {r.doc_tokens for r in own} == {len(ids[i][0])}
            assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        else:
            assert len(own) == len(ids[i])
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and sum(r.length for r in own) <= 2048
    assert packing.pack(stored(packing.cut_documents(frame(spark, []), BYTE), "p")).collect() == []
    again = packing.pack(stored(packing.cut_documents(frame(spark, corpus), BYTE, with_ids=True), "p"), group_rows=group_rows)
    assert len(again.collect()) == len(found)


PAGES = [(5, "http://a", "<p>x</p>"), (3, "http://b", "<p>x</p>"), (9, None, "<p>x</p>"), (4, "http://c\r\nX: y", "é" * 5000), (1, "u", None), (2, "u", ""), (None, "n", "alone"), (None, "n", "<p>x</p>"), (7, "r", "again"), (7, "r", "again"), (8, "l", "\r\n\r\nWARC/1.1\r\n" * 20_000)]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit(1)).withColumn("Offset", F.lit(2)).withColumn("first", F.lit(3))


@pytest.mark.parametrize(("file_bytes", "gap", "least"), [(32 << 20, 64 << 10, 0), (1, 0, 0), (32 << 20, 0, 6)])
def test_archives(spark, file_bytes, gap, least, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(warc, "GAP_BYTES", gap)
    index = warc.write_archives(pages(spark, PAGES), scratch(spark, "w"), least)
    found = warc.read_archives(index).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    wanted = []
    for i, u, h in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= least and first.get(h or "", i) != i
        wanted.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None, None if again else raw))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    for r in index.collect():
        raw = Path(r.file.removeprefix("file://")).read_bytes()[r.offset : r.offset + r.length]
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
    one = warc.read_archives(index.where("page_id = 4")).collect()
    assert [r.page_id for r in one] == [4]


def test_archives_of_nothing(spark):
    assert warc.read_archives(warc.write_archives(pages(spark, []), scratch(spark, "w"))).collect() == []


def test_coalescing():
    assert warc.coalesced([(0, 5), (5, 5), (30, 5), (36, 100)], gap=10, most=50) == [(0, 10, [0, 1]), (30, 35, [2]), (36, 136, [3])]


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((3000, 16)) + rng.integers(0, 5, (3000, 1))
    vectors[500:900] = vectors[500]  # a hot vector, with ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [float("inf")] + [1.0] * 15), (3400, [None] + [1.0] * 15), (None, [1.0] * 16), (3500, [1.0, 2.0]), (3501, [1.0, 2.5]), (3600, [3.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("Rank", F.lit(2)).withColumn("dim", F.lit(3))
    found = {}
    for r in neighbours.nearest_neighbours(df, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 3000, 100):
        d = neighbours.distances(vectors, vectors[q])
        wanted = [int(i) for i in np.lexsort((np.arange(3000), d)) if i != q][:10]
        got = sorted(found[q])
        assert [r for r, *_ in got] == list(range(1, 11)) and [(s, v) for _, v, s in got] == sorted((s, v) for _, v, s in got)
        assert all(s == d[v] for _, v, s in got)
        hits += len(set(wanted) & {v for _, v, _ in got})
        if q in range(500, 900):
            assert [v for _, v, _ in got] == wanted
    assert hits / 300 >= 0.95
    assert found[3500] == [(1, 3501, 0.5)] and not {3000, 3100, 3200, 3300, 3400, 3600} & found.keys()
    assert neighbours.nearest_neighbours(df.where("false"), F.col("vec_id") == 0).collect() == []


def test_neighbours_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_BYTES", 8 * 8 * 100)
    monkeypatch.setattr(neighbours, "PART_QUERIES", 7)
    vectors = np.random.default_rng(1).standard_normal((500, 8)) * 1e200  # squares would overflow in part
    vectors[:400] /= 1e200
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=3).collect()
    hits = 0
    for q in range(0, 400, 20):
        d = neighbours.distances(vectors[:400], vectors[q])
        wanted = [int(i) for i in np.lexsort((np.arange(400), d)) if i != q][:3]
        hits += len(set(wanted) & {r.vec_id for r in found if r.query_id == q})
    assert len(found) == 75 and hits / 60 >= 0.95


def force_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, over, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9:
        free = [s for s in names if s not in over]
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in free:
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                over.add(s)
    return target


def test_targets(spark):
    for sizes in ({"a": 10, "b": 10, "c": 1000, None: 3, "é": 500}, {"a": 5}, {"a": 0, "b": 9}, {"a": 7, "b": 1, "c": 1, "d": 1, None: 900}):
        got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        assert got == pytest.approx(force_targets(sizes))


def test_mixing(spark, corpus):
    df = frame(spark, corpus)
    found = taken(mix(df)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id, r["size"], r.source) for r in found if r.doc_id is not None and r.source is not None) == sorted((i, size(t), s) for i, t, s in corpus if i is not None and s is not None)
    sizes = {}
    for _, t, s in corpus:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets, got = force_targets(sizes), dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source]) and 0 <= r.taken <= MOST_TIMES * r["size"]
        got[r.source] += r.taken
    for s in sizes:
        assert abs(got[s] - targets[s]) <= 3 * 64 + 0.01 * targets[s]
    assert sorted((r.doc_id or -1, r.taken) for r in found) == sorted((r.doc_id or -1, r.taken) for r in taken(mix(df.repartition(5))).collect())
    assert taken(mix(frame(spark, []))).collect() == []


def test_schedule_is_even_in_every_prefix(spark, corpus):
    slots = mix(frame(spark, corpus)).where("slot is not null").select("slot", "source", "target").distinct().orderBy("slot").collect()
    total = sum({r.source: r.target for r in slots}.values())
    seen = {}
    for i, r in enumerate(slots, 1):
        seen[r.source] = seen.get(r.source, 0) + 1
        assert abs(seen[r.source] - (r.slot + 1) * r.target / total) <= 4 + math.log2(i + 1)


def test_mixing_plan_is_native(spark, corpus):
    plan = taken(mix(frame(spark, corpus)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("table", ["sf0.1", "check_s"])
def test_collisions_tell_what_is_near(table):
    """Measured on all queries of the table's first 10,000 vectors: few vectors are verified, and nearly all neighbours found."""
    rows = pq.read_table(f"/root/testdata/{table}/embeddings.parquet", columns=["vec_id", "embedding"]).slice(0, 10_000)
    ids, vectors = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_pylist()).astype(float)
    at = np.flatnonzero(ids % 100 == 0)
    arrays, found = neighbours.Arrays(ids, vectors), 0
    for i, (near, _) in zip(at, arrays.nearest(ids[at], vectors[at], 10)):
        d = np.where(ids == ids[i], np.inf, neighbours.distances(vectors, vectors[i]))
        found += len(set(near) & set(ids[np.argsort(d, kind="stable")[:10]]))
    assert found / 10 / len(at) >= 0.98 and arrays.verified / len(at) / len(ids) <= 0.36


@needs_tables
def test_op4_query(spark):
    encode, at, wanted = library(WORD), 0, []
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()):
        ids = [*encode(r.text), 2]
        wanted.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = QUERIES["op4_token_output"](spark, SF)
    assert found.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and sorted(tuple(r)[:4] for r in found.collect()) == wanted


@needs_tables
def test_op7_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    first: dict = {}
    for r in sorted(pages):
        first.setdefault(r.html or "", r.page_id)
    wanted = []
    for r in pages:
        raw, of = (r.html or "").encode(), first[r.html or ""]
        wanted.append((r.page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if of == r.page_id else "revisit", None if of == r.page_id else of))
    found = QUERIES["op7_warc"](spark, SF)
    assert found.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and sorted(map(str, (tuple(r)[:5] for r in found.collect()))) == sorted(map(str, wanted))


@needs_tables
def test_op9_query(spark):
    encode, pieces, filled = library(BYTE), {}, {}
    found = QUERIES["op9_packing"](spark, SF)
    assert found.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for r in found.collect():
        pieces.setdefault(r.doc_id, []).append(r)
        filled.setdefault(r.sequence_id, []).append(r)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(pieces) == len(docs)
    for d in docs:
        ids, own = np.array([*encode(d.text), 1], "<u4"), sorted(pieces[d.doc_id], key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids) for r in own)
    for own in filled.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and sum(r.length for r in own) <= 2048
    assert sum(r.length for own in filled.values() for r in own) > 0.95 * 2048 * len(filled)


def test_a_repeated_attempt_replaces_no_file(spark, corpus, tmp_path):
    """Files are named by the attempt that wrote them, so those that the index names stay as they are."""
    folder = f"file://{tmp_path}/t"
    index = token_output.write_token_files(token_output.encode_texts(frame(spark, corpus), WORD), folder)
    before = {p.name: p.read_bytes() for p in (tmp_path / "t").iterdir()}
    token_output.write_token_files(token_output.encode_texts(frame(spark, corpus).where("doc_id < 20"), WORD), folder)
    assert all((tmp_path / "t" / k).read_bytes() == v for k, v in before.items() if k != "ranks")
    assert index.count() == len(before) - 1


def test_token_files_are_read_in_many_tasks(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "SHARD_NUMBERS", 300)
    folder = f"file://{tmp_path}/many"
    index = token_output.write_token_files(token_output.encode_texts(frame(spark, corpus), WORD), folder)
    read = token_output.read_token_files(index, folder).select("doc_id", F.spark_partition_id().alias("p"))
    files, tasks = index.count(), read.select("p").distinct().count()
    assert files > 8 and tasks > files // 2


def test_very_long_texts(spark):
    """Ten megabytes each: of words, of one word, and of marks."""
    rng = random.Random(3)
    long = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(1_700_000)), "ab" * 5_000_000, "-=" * 50_000 + "x " * 4_900_000]
    rows = [(i, t, "s") for i, t in enumerate(long)] + [(3, "short", "s")]
    docs = spark.createDataFrame(rows[:1] + rows[2:], DOCS)
    encode = library(BYTE)
    pieces = stored(packing.cut_documents(docs, BYTE), "long").groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r.doc_id: (r.n, r.t) for r in pieces} == {i: (len(encode(t)) + 1,) * 2 for i, t, _ in rows[:1] + rows[2:]}
    found = taken(mix(spark.createDataFrame(rows, DOCS))).collect()
    assert {r.doc_id: r["size"] for r in found} == {i: len(t.split()) for i, t, _ in rows}
    index = warc.write_archives(spark.createDataFrame([(i, "u", t) for i, t, _ in rows], "page_id long, url string, html string"), scratch(spark, "w"))
    assert {r.page_id: r.payload_bytes for r in warc.read_archives(index, with_payload=False).collect()} == {i: len(t) for i, t, _ in rows}
    folder, encode = scratch(spark, "long-tokens"), library(WORD)
    found = token_output.digest(token_output.read_token_files(token_output.write_token_files(token_output.encode_texts(docs, WORD), folder), folder)).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(encode(t)) + 1 for i, t, _ in rows[:1] + rows[2:]}
