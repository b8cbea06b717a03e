"""Exact, line and near duplicates against brute force."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import line_dedup, links, near_dedup
from quern.llm.exact_dedup import exact_duplicates
from quern.llm.line_dedup import drop_lines, line_classes, within

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def docs(spark, rows):
    """With columns whose names clash with those in use, and in other cases."""
    plain = spark.createDataFrame(rows, DOCS).repartition(3)
    clash = ("kept", "Name", "key", "hash", "component", "group_size", "row", "n")
    return plain.select("doc_id", "text", *(F.lit(i).alias(c) for i, c in enumerate(clash)))


def az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(rng, n):
    return " ".join(rng.choice("lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt".split()) + str(rng.randint(0, 30)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows, base = [], words(rng, 300)
    for i in range(40):
        rows.append((i, words(rng, rng.randint(1, 80))))
    for i in range(40, 100):  # a large group of near copies, in which not all pairs are near
        w = base.split()
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append((i, " ".join(w)))
    rows += [(i, rows[i % 40][1].upper()) for i in range(100, 120)] + [(i, rows[7][1]) for i in range(120, 150)]
    rows += [(150, None), (151, ""), (152, ""), (153, "one two"), (154, "One  TWO"), (155, "É lone"), (156, "é lone"), (157, " \n\t"), (158, "long " * 9000 + "x"), (159, "long " * 9000 + "y"), (160, "LONG " * 9000 + "x")]
    rows += [(160, "LONG " * 9000 + "x"), (None, "one two"), (None, "alone with a null id")]
    return rows


@pytest.mark.parametrize("block", [16 << 10, 64, 7])
def test_exact(spark, corpus, block):
    rows = corpus if block > 1000 else [r for r in corpus if len(r[1] or "") < 1000]
    by = {}
    for doc_id, text in rows:
        by.setdefault(az(text), []).append(doc_id)
    found = exact_duplicates(docs(spark, rows), block).collect()
    top = {t: max(ids, key=lambda i: -1 if i is None else i) for t, ids in by.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in by}
    assert sorted((r.doc_id or -1, r.text_sha256) for r in found) == sorted((i or -1, hashlib.sha256(az(t).encode()).hexdigest()) for i, t in rows)
    for r in found:
        t = sha[r.text_sha256]
        assert r.group_size == len(by[t]) and r.keep_id == top[t] and (not r.kept or r.doc_id == r.keep_id)
    assert sum(r.kept for r in found) == len(by)
    assert exact_duplicates(docs(spark, []), block).collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


@settings(max_examples=1500, deadline=None)
@given(st.text("abé", max_size=12), st.text("abé", max_size=12), st.integers(0, 4))
def test_within(a, b, most):
    assert within(a, b, most) == (distance(a, b) <= most)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=30, max_size=60), st.lists(st.tuples(st.integers(0, 59), st.sampled_from("ix-")), max_size=3))
def test_within_edited(a, edits):
    b = list(a)
    for at, kind in edits:
        at %= max(1, len(b))
        if kind == "i":
            b.insert(at, "c")
        elif kind == "x" and b:
            b[at] = "c"
        elif b:
            del b[at]
    assert within(a, "".join(b)) == (distance(a, "".join(b)) <= 2)


@settings(max_examples=300, deadline=None)
@given(st.text("abé😀", min_size=4, max_size=30), st.lists(st.tuples(st.integers(0, 59), st.sampled_from("ix-")), max_size=3), st.integers(0, 3))
def test_near_lines_share_a_key(a, edits, most):
    b = list(a)
    for at, kind in edits[:most]:
        at %= max(1, len(b))
        if kind == "i":
            b.insert(at, "c")
        elif kind == "x" and b:
            b[at] = "c"
        elif b:
            del b[at]
    short, long = sorted((a, "".join(b)), key=len)
    if len(short) > most:
        indexed = line_dedup.index_keys(["other line", short, "é"], most)[1]
        assert set(indexed.tolist()) & set(line_dedup.probe_keys([long, "x" * 99], most)[0].tolist())


def roots(n, linked):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return [top(i) for i in range(n)]


@pytest.fixture(scope="module")
def line_docs():
    rng = random.Random(8)
    lines = [words(rng, rng.randint(1, 9)) for _ in range(60)]
    chain = "the quick brown fox jumps over the lazy dog again and again"
    for i in range(12):  # each is within two edits of the next, but not of those further on
        chain = chain[: 3 * i] + "#" + chain[3 * i + 1 :]
        lines.append(chain)
    for _ in range(60):
        x = list(rng.choice(lines))
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(len(x))] = rng.choice("zq ")
        lines.append("".join(x))
    rows = [(i, "\n".join(rng.choice([*lines, "", "  ", "short"]) for _ in range(rng.randint(1, 7)))) for i in range(80)]
    return [*rows, (80, None), (81, ""), (82, "\n\n"), (83, rows[3][1]), (83, rows[3][1]), (None, rows[5][1]), (84, "é" * 40 + "\r\n" + "é" * 39 + "e\r\n"), (85, "w " * 20_000)]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_lines(spark, line_docs, most):
    places = [(i, n, x) for i, t in line_docs for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\v\f\r")]
    distinct = sorted({x for *_, x in places})
    near = [(a, b) for a in range(len(distinct)) for b in range(a) if min(len(distinct[a]), len(distinct[b])) >= line_dedup.LEAST_CHARS and abs(len(distinct[a]) - len(distinct[b])) <= most and distance(distinct[a], distinct[b]) <= most]
    root = dict(zip(distinct, roots(len(distinct), near)))
    order = lambda p: (p[0] is not None, p[0], p[1])
    first = {}
    for p in sorted({p[:2]: p for p in places}.values(), key=order):
        first.setdefault(root[p[2]], p[:2])
    wanted = sorted(((i, n, *first[root[x]], (i, n) == first[root[x]]) for i, n, x in places), key=str)
    found = line_classes(docs(spark, line_docs), most).collect()
    assert sorted(((r.doc_id, r.line_no, r.class_doc_id, r.class_line_no, r.kept) for r in found), key=str) == wanted


def test_dropping_lines(spark, line_docs):
    given = docs(spark, line_docs).withColumn("n_chars", F.length("text").cast("long"))
    classes = line_classes(given)
    kept = {(r.doc_id, r.line_no): r.kept for r in classes.collect()}
    found = drop_lines(given, classes)
    assert found.columns == given.columns and found.schema.simpleString() == given.schema.simpleString()
    wanted = []
    for i, t in line_docs:
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if kept.get((i, n), True))
        if t is None or not t.strip() or left.strip():
            wanted.append((i, left, None if left is None else len(left)))
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in found.collect()), key=str) == sorted(wanted, key=str)
    assert line_classes(docs(spark, [])).collect() == [] and drop_lines(docs(spark, []), line_classes(docs(spark, []))).collect() == []


def test_lines_are_dropped_in_linear_time_and_by_document(spark):
    import time

    many = "\n".join(f"line number {i} of a text of very many lines" for i in range(100_000))
    rows = [(1, many), (2, many + "\none line of its own that no other text has")]
    given = spark.createDataFrame(rows, DOCS)
    schema = "doc_id bigint, line_no int, kept boolean, text_hash binary"
    hashes = bytearray(hashlib.md5(rows[1][1].encode()).digest())
    classes = spark.createDataFrame([(2, i, i == 100_000, hashes) for i in range(100_001)], schema)
    began = time.perf_counter()
    found = {r.doc_id: r.text for r in drop_lines(given, classes).collect()}
    assert time.perf_counter() - began < 15 and found == {1: many, 2: "one line of its own that no other text has"}
    # Documents without an id don't meet.
    rows = [(None, f"the first line that all of the documents have\nand line {i} of its own, that no other has") for i in range(50)] + [(None, "another line\nthe first line that all of the documents have")]
    classes = line_classes(docs(spark, rows))
    each = classes.where("not kept").groupBy("doc_id", "text_hash").count().collect()
    assert [r["count"] for r in each] == [1]
    assert "another line" in {r.text for r in drop_lines(docs(spark, rows), classes).collect()}


def test_very_long_texts_have_classes(spark):
    """A megabyte each: of words, of one word, and of lines; twice each, and some with an edit."""
    rng = random.Random(8)
    long = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(170_000)), "ab" * 500_000, "\n".join(f"{rng.random()} {rng.random()} {rng.random()}" for _ in range(22_000))]
    rows = [(i, t) for i, t in enumerate(long)] + [(i + 3, t) for i, t in enumerate(long)] + [(6, long[0] + " more"), (7, "short"), (8, long[2] + "\nmore")]
    given = spark.createDataFrame(rows, DOCS)
    assert {r.doc_id: r.keep_id for r in exact_duplicates(given).collect()} == {0: 3, 1: 4, 2: 5, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8}
    near = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(given).collect()}
    assert near == {0: 0, 1: 1, 2: 2, 3: 0, 4: 1, 5: 2, 6: 0, 7: 7, 8: 2}
    kept = {r.doc_id: r.n for r in line_classes(given).groupBy("doc_id").agg(F.count_if("kept").alias("n")).collect()}
    assert kept == {0: 1, 1: 1, 2: 22_000, 3: 0, 4: 0, 5: 0, 6: 1, 7: 1, 8: 1}


def shingles(text):
    w = az(text).replace("\t", " ").replace("\n", " ").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def by_force(rows):
    sets = [shingles(t) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root, least = roots(len(rows), near), {}
    for (doc_id, _), r in zip(rows, root):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(((i, len(s), least.get(r), i == least.get(r)) for (i, _), s, r in zip(rows, sets, root)), key=str)


@pytest.mark.parametrize("cell", [512, 8])
def test_near(spark, corpus, cell, monkeypatch):
    monkeypatch.setattr(links, "CELL", cell)
    found = near_dedup.near_duplicates(docs(spark, corpus)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str) == by_force(corpus)
    assert near_dedup.near_duplicates(docs(spark, [])).collect() == []


def test_buckets_of_unlike_members(spark, monkeypatch):
    """All documents share most buckets, as a poor hash would make them, and two groups are linked only by their middle members."""
    monkeypatch.setattr(links, "CELL", 4)
    members = spark.createDataFrame([(k, i, 0, 29, True, 1) for k in range(2) for i in range(30)], "key long, id long, low long, high long, many boolean, size long")
    real = {(i, i + 3) for i in range(27)}
    asked = []

    def verify(pairs, hubs):
        asked.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where(F.col("b") - F.col("a") == 3)

    def settle(cells):
        rows, out = cells.collect(), []
        for a in rows:
            for b in rows:
                if (a.key, a.row, a.column) == (b.key, b.row, b.column) and a.asks and not b.asks and a.component != b.component:
                    out.append((a.id, b.id))
        return spark.createDataFrame(out, "a long, b long")

    found = {r.id: r.component for r in links.linked_components(members, verify, settle).collect()}
    assert found == {i: i % 3 for i in range(30)} and real <= {tuple(sorted(x)) for x in asked}


@pytest.mark.parametrize("members", [3001, 30_010])
def test_cells_are_linear_where_few_are_strays(spark, members):
    bucket = spark.range(members).select(F.lit(7).cast("long").alias("key"), "id", F.lit(0).alias("low"), F.lit(members).alias("high"), F.lit(True).alias("many"), F.lit(9).alias("size"))
    found = spark.range(members - 2).select("id", F.lit(0).cast("long").alias("component"))
    cells = links._cells(bucket, found)
    assert cells.count() <= 1.1 * members + 2
    each = cells.groupBy("key", "row", "column").count().agg(F.max("count")).first()[0]
    assert each <= 1.3 * links.CELL + 2


def test_shingles_in_common():
    rng = random.Random(5)
    for _ in range(300):
        x = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        y = list(x)
        for _ in range(rng.randint(0, 4)):
            y.insert(rng.randint(0, len(y)), rng.choice("abcd"))
        x, y = " ".join(x), " ".join(y[rng.randint(0, 2) :])
        a, b = shingles(x), shingles(y)
        assert near_dedup.in_common(x.encode(), y.encode()) == (len(a & b), len(a | b))


def test_hubs_are_spread(spark):
    """One id is in all 20,000 pairs: no key that pairs, texts or links are joined by has more than a few hundredths of them."""
    pairs = spark.range(1, 20_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).unionByName(spark.range(20_000).select(F.col("id").alias("a"), F.lit(20_000).cast("long").alias("b"))).distinct()
    seated, hubs = links._seated(pairs)
    assert {r.id: r.copies for r in hubs.collect()} == {0: 64, 20_000: 64} and seated.count() == pairs.count()
    for end in "ab":
        assert seated.groupBy(end, f"s{end}").count().agg(F.max("count")).first()[0] <= 20_000 / 64 * 1.5
    texts = links.with_copies(spark.range(20_001).select("id", F.col("id").cast("string").alias("text")), hubs)
    met = seated.join(texts.toDF("a", "ta", "sa"), ["a", "sa"]).join(texts.toDF("b", "tb", "sb"), ["b", "sb"])
    assert met.where("ta = a and tb = b").count() == pairs.count()
    found = links.components(pairs)
    assert found.agg(F.countDistinct("component"), F.count("*")).first() == (1, 20_001)
    plan = links.join_hot(pairs, pairs.groupBy("a").agg(F.max("b").alias("m"), F.count("*").alias("n")), "a", "n", 40_000)
    assert plan.count() == pairs.count()


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 240)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)]
    found = {r.id: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = roots(300, edges)
    assert found == {i: root[i] for e in edges if e[0] != e[1] for i in e}
    assert links.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bayes_keeps_similar_pairs():
    least = near_dedup.least_matches()
    rng = random.Random(3)
    assert (least[1:] >= least[:-1]).all()
    lost = 0
    import numpy as np

    for _ in range(300):
        a = np.frombuffer(rng.randbytes(near_dedup._K), np.uint8)
        b = np.where(np.array([rng.random() < 0.75 for _ in a]), a, np.frombuffer(rng.randbytes(len(a)), np.uint8))
        lost += not len(near_dedup.may_link(a[None], b[None], least)[0])
    assert lost == 0
