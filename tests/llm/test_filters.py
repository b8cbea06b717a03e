"""Toxicity, quality, and the word hashing and samples beneath them."""

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import quality, toxicity
from quern.llm._common import held_out
from quern.llm.labelled import sample_of
from quern.llm.words import NO_LETTER, Words, shingles

WORDS = [a + b for a in ("ta", "re", "mo", "li", "su", "ne", "ka") for b in ("ren", "lo", "min", "sa", "der", "tu")]


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with labels: toxic ones hold two or more words of a small list, bad ones are shouted or full of marks."""
    rng, docs, labels = random.Random(9), [], []
    for i in range(600):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "en"]) for _ in range(rng.randint(20, 150))]
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumph", "blarg", "snotwich"]))
        text = " ".join(words)
        docs.append((i, text if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string").cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def test_held_out_is_crc32_of_the_text(spark):
    rows = spark.range(200).select("id", held_out(F.col("id"), 3, 1).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.id).encode()) % 3 == 1 for r in rows]


def accuracy(found, labels, label):
    both = found.join(labels, "doc_id").where("held_out").collect()
    assert both
    return sum(r.predicted == r[label] for r in both) / len(both)


def test_toxicity_on_held_out_documents(spark, corpus):
    docs, labels = corpus
    model = toxicity.fit_toxicity(docs, labels)
    found = toxicity.score_toxicity(docs, model, "score").withColumn("held_out", held_out(F.col("doc_id"), 3, 1)).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
    assert accuracy(found, labels, "toxic") > 0.97
    one = toxicity.score_toxicity(spark.createDataFrame([("x " * 50 + "Grumph blarg! snotwich " + "y " * 50,)], "text string"), model).first()
    assert [("x " * 50 + "grumph blarg! snotwich " + "y " * 50)[p.begins : p.ends] for p in one.passages] == ["grumph blarg! snotwich"]


def test_labels_outside_the_folds_are_not_learnt_from(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id"), 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit_toxicity(docs, x) for x in (labels, flipped))
    assert (a.hashes == b.hashes).all() and (a.weights == b.weights).all() and (a.scale, a.shift) == (b.scale, b.shift)


def segments_by_force(weights):
    """All maximal segments, by their definition: the best segment, then those of what is left on either side."""
    if not weights or max(weights) <= 0:
        return []
    best = max(((sum(weights[i:j]), -(j - i), -i) for i in range(len(weights)) for j in range(i + 1, len(weights) + 1)))
    i = -best[2]
    j = i - best[1]
    return segments_by_force(weights[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in segments_by_force(weights[j:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-0.5, -0.5, -0.5, 1.25, 0.75, 2.0, 3.0]), max_size=14))
def test_maximal_segments(weights):
    found = toxicity.maximal_segments(np.array(weights, float))
    total = lambda x: sum(weights[x[0] : x[1]])
    wanted = segments_by_force(weights)
    assert sorted(s for *_, s in found) == pytest.approx(sorted(s for *_, s in wanted))
    assert all(s == pytest.approx(total((a, b))) for a, b, s in found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -2.0, -1.25, 1.0, 1.5, 2.0, 4.0]), max_size=16))
def test_maximal_segments_of_falling_totals(weights):
    found = toxicity.maximal_segments(np.array(weights, float))
    assert sorted(s for *_, s in found) == pytest.approx(sorted(s for *_, s in segments_by_force(weights)))
    assert [a for a, *_ in found] == sorted(a for a, *_ in found)


def test_search_is_linear():
    import time

    def seconds(weights):
        began = time.perf_counter()
        toxicity.maximal_segments(weights)
        return time.perf_counter() - began

    rng = np.random.default_rng(1)
    for pattern in (np.array([1.0, -2.0]), np.array([1.0, -0.5]), rng.choice([1.0, -1.0, -2.0, 3.0], 5000), np.repeat([1.0, -1.5, 2.0, -2.5], 999)):
        seconds(np.resize(pattern, 10_000))
        assert seconds(np.resize(pattern, 2_000_000)) < 8


def test_tokens_of_few_documents_have_no_odds():
    there = np.array([[900.0, 300.0], [910.0, 280.0]])
    n = toxicity._fewest(there)
    assert n > 1
    for m in range(1, n):
        y1 = np.arange(m + 1.0)
        assert not any(toxicity.log_odds(m - y1, y1, *t).any() for t in (there.sum(0), *(there.sum(0) - there)))


def test_law():
    rate = toxicity.law_rate(np.array([0.01, 0.99]), np.array([3.0, -0.5]))
    assert 0.01 * math.exp(3 * rate) + 0.99 * math.exp(-0.5 * rate) == pytest.approx(1, abs=1e-6)
    assert toxicity.surprise([], 100, 1.0) == 0 and toxicity.surprise([9.0, 9.0], 100, 1.0) > toxicity.surprise([9.0], 100, 1.0) > 0


def test_surprise_takes_all_segments():
    scores = [float(s) for s in range(9, 300)]
    best, total = 0.0, 0.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        total += s - math.log(50)
        if total > 0:
            best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))
    assert toxicity.surprise(scores, 50, 1.0) == pytest.approx(best)
    assert toxicity.surprise([5.0] * 200, 50, 1.0) > toxicity.surprise([5.0] * 100, 50, 1.0)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=20))
def test_lower_case_keeps_places(text):
    assert [len(x) for x in toxicity.lowered([text, text + "İẞΣ"])] == [len(text.encode()), len((text + "İẞΣ").encode())]
    assert toxicity.lowered(["Größe ÉTÉ"]) == ["größe été".encode()]


def test_weights_of_words():
    words = Words([b"slur fine slur", b"slur other"], NO_LETTER)
    h = words.hashes()
    order = np.argsort(h[[0, 1]])
    model = toxicity.Odds(h[[0, 1]][order], np.array([4.0, -2.0])[order], 1.0)
    assert (model.of(words) + toxicity.DRIFT).tolist() == [4.0, -2.0, 2.0, 4.0, 0.0]
    stem = Words([b"slurring slur"], NO_LETTER)
    model = toxicity.Odds(stem.prefixes(4)[:1], np.array([3.0]), 1.0)
    assert (model.of(stem) + toxicity.DRIFT).tolist() == [3.0, 0.0]


def test_log_odds():
    odds = toxicity.log_odds(np.array([0.0, 0, 0, 45, 400]), np.array([0.0, 1, 40, 5, 0]), 900.0, 100.0)
    assert odds[0] == 0 and 0 <= odds[1] < 1 < odds[2] and odds[3] == 0 >= odds[4] and toxicity.log_odds(np.array([600.0]), np.array([5.0]), 900.0, 100.0)[0] < 0


def test_quality_on_held_out_documents(spark, corpus):
    docs, labels = corpus
    model = quality.fit_quality(docs, labels)
    found = quality.score_quality(docs, model, "score").withColumn("held_out", held_out(F.col("doc_id"), 4, 2)).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
    assert accuracy(found, labels, "quality") > 0.95


def test_convolution_against_loops():
    model = quality.ByteConv.fresh()
    rng = np.random.default_rng(1)
    model.bias = rng.standard_normal(quality.FILTERS).astype(np.float32)
    texts = [b"", b"a", bytes(rng.integers(1, 256, 700, np.uint8)), bytes(rng.integers(1, 256, 2048, np.uint8)), b"end"]
    found = quality.Scorer(model).logits(texts)
    for t, x in zip(texts, found):
        n = max(1, -(-len(t) // quality.BLOCK)) * quality.BLOCK
        raw = t.ljust(n, b"\0") + b"\0" * quality.WIDTH
        answers = np.array([sum(model.tables[j][raw[p + j]] for j in range(quality.WIDTH)) for p in range(n)])
        chunks = [answers[s : s + quality.CHUNK].max(0) for s in quality.chunk_starts(len(t))]
        wanted = np.mean([np.maximum(c + model.bias, 0) @ model.dense + model.offset for c in chunks])
        assert x == pytest.approx(wanted, abs=1e-3)
        covered = set().union(*(range(s, s + quality.CHUNK) for s in quality.chunk_starts(len(t))))
        assert set(range(len(t))) <= covered


def test_quality_score_depends_on_the_text_alone(spark, corpus):
    model = quality.ByteConv.fresh()
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(1, 256, n, np.uint8)) for n in (0, 1, 122, 123, 127, 128, 129, 511, 512, 4000, 100_000)]
    scorer = quality.Scorer(model)
    alone = [float(scorer.logits([t])[0]) for t in texts]
    assert scorer.logits(texts).tolist() == alone and scorer.logits(texts[::-1]).tolist() == alone[::-1]
    docs, labels = corpus
    model = quality.fit_quality(docs, labels)
    a, b = ({r.doc_id: r.p for r in quality.score_quality(docs.repartition(n), model, "p").collect()} for n in (2, 7))
    assert a == b


def test_quality_sample_is_bounded_by_bytes(spark, corpus):
    docs, labels = corpus
    for most in (60_000, 0):  # one chunk of each document at least
        few = quality.fit_quality(docs, labels, most_bytes=most)
        assert few.scale > 0 and len({r.p for r in quality.score_quality(docs, few, "p").collect()}) > 100
    assert quality._most_chunks(np.array([1, 5, 100]), 16 * quality.PIECE) == 10
    pieces = quality._pieces(spark.createDataFrame([(1, "a" * 5000 + "z"), (2, ""), (3, "b")], "doc_id bigint, text string"), {1, 2}, 3).collect()
    assert {r.doc_id: len(r.pieces) // quality.PIECE for r in pieces} == {1: 3, 2: 1} and b"z" in max(pieces, key=lambda r: len(r.pieces)).pieces
    assert quality.fit_quality(docs.where("false"), labels).scale == 0
    assert quality.fit_quality(docs, labels.where("quality = 1")).scale == 0


def test_one_long_text_takes_no_other_out_of_the_sample(spark, corpus):
    docs, labels = corpus
    first = labels.where("quality = 1").join(docs, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).orderBy(F.xxhash64("doc_id")).first().doc_id
    long = docs.withColumn("text", F.when(F.col("doc_id") == first, F.expr("repeat(concat(text, ' '), cast(40000000 / length(text) as int))")).otherwise(F.col("text")))
    found = []
    for d in (docs, long):
        model = quality.fit_quality(d, labels)
        assert model.scale > 0
        rows = quality.score_quality(docs, model, "p").join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).select("p", "quality").collect()
        found.append([np.mean([(r.p >= quality.THRESHOLD) == kind for r in rows if r.quality == kind]) for kind in (0, 1)])
    assert np.abs(np.subtract(*found)).max() <= 0.06, found  # one of the fold's 19 poor documents is 0.053


ODD = [(1, None), (2, ""), (2, ""), (None, "some text"), (3, "wörd " * 30_000), (4, " \n\t ")]


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    odd = spark.createDataFrame(ODD, "doc_id long, text string").select("doc_id", "text", F.lit(1).alias("TEXT2"), F.lit(2).alias("score"), F.lit(3).alias("Score"))
    for model, score in ((quality.fit_quality(docs, labels), quality.score_quality), (toxicity.fit_toxicity(docs, labels), toxicity.score_toxicity)):
        rows = score(odd, model, "p").collect()
        assert len(rows) == len(ODD) and all(0 <= r.p <= 1 for r in rows)
        assert score(odd.where("false"), model, "p").collect() == []


def test_without_labels(spark, corpus):
    docs, labels = corpus
    none = labels.where("false")
    assert {r.quality_score for r in quality.score_quality(docs, quality.fit_quality(docs, none)).collect()} == {0.5}
    assert {r.toxicity for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()} == {0.5}


def test_fits_on_too_little(spark, corpus):
    """An empty table of documents, labels of one kind only, and a handful of each."""
    docs, labels = corpus
    for d, l in ((docs.where("false"), labels), (docs, labels.where("toxic = 1")), (docs, labels.where("toxic = 0"))):
        assert len({r.toxicity for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(d, l)).collect()}) == 1
    few = labels.where("doc_id < 12")
    for rows, name in ((toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, few)), "toxicity"), (quality.score_quality(docs, quality.fit_quality(docs, few)), "quality_score")):
        assert all(0 <= r[name] <= 1 for r in rows.collect())
    twice = docs.unionByName(docs)
    assert quality.fit_quality(twice, labels).shift == quality.fit_quality(docs, labels).shift


def test_sample_is_bounded_and_consistent(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.LongType())])
    rows = [(i, i % 2) for i in range(300)] + [(0, 1), (None, 1), (301, None), (302, 7)]
    sample, counts = sample_of(spark.createDataFrame(rows, schema), "toxic", 20, 3, 1)
    got = sample.collect()
    assert len(got) == 40 and 0 not in {r.doc_id for r in got} and not any(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)
    assert sum(counts.values()) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(1, 300))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t,7" + "x" * 3, max_size=60), max_size=6))
def test_words_and_shingles(texts):
    raw = [t.encode() for t in texts]
    w = Words(raw)
    got = [[w.data[s : s + n] for s, n in zip(w.start[a:b], w.length[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [t.split() for t in raw]
    h = w.hashes()
    flat = [x for t in raw for x in t.split()]
    assert len({x: y for x, y in zip(flat, h)}) == len(set(flat)) == len(set(h.tolist()))
    s, runs = shingles(w)
    sets = [[tuple(x[i : i + 5]) for i in range(len(x) - 4)] or ([tuple(x)] if x else []) for x in got]
    assert runs.tolist() == [len(x) for x in sets]
    pairs = {(x, int(y)) for x, y in zip([x for z in sets for x in z], s)}
    assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
    letters = Words(raw, NO_LETTER)
    assert letters.counts.sum() == sum(len([p for p in t.replace(",", " ").split()]) for t in texts)
