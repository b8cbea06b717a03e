"""Benchmark passages in documents against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import decontamination as dc


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def by_force(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for item_id, item in items:
            k = words(item)
            n = min(len(k), dc.WINDOW)
            wanted = {tuple(k[i : i + n]) for i in range(len(k) - n + 1)} if n else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in wanted] if n else []
            hit.update(i + j for i in at for j in range(n))
            if at and item_id is not None:
                named.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "BETA", "γάμα", "d4", "e", "foo", "bar", "Baz", "q"]) + str(rng.randint(0, 6))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(11, 40))) for i in range(12)] + [(100, text(10)), (9, text(9)), (9, text(4)), (101, "lone"), (None, text(12)), (102, None), (103, ""), (104, " .,- "), (105, items_text := text(15)), (106, items_text.upper()), (107, "a a a a a a a a a a a a"), (108, "long tail " * 20)]
    shared = [x for _, x in items if x]
    docs = []
    for i in range(120):
        parts = [text(rng.randint(0, 30)) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.5:
            w = rng.choice(shared).split()
            a = rng.randrange(len(w)) if w else 0
            parts.insert(rng.randint(0, len(parts)), rng.choice(["?! ", "", "\n"]).join(["", " ".join(w[a : a + rng.randint(1, 40)])]))
        docs.append((i, rng.choice([" ", ". ", "--", "\n\n"]).join(parts)))
    docs += [(200, None), (201, ""), (202, "..."), (None, shared[0]), (None, shared[0]), (203, shared[1]), (203, shared[1]), (203, "other"), (204, "LONE"), (205, "a " * 40), (206, "x " * 60_000 + shared[2] + " y" * 60_000 + " " + shared[2])]
    docs += [(300 + i, shared[3]) for i in range(50)]
    return docs, items


def frame(spark, rows, names):
    plain = spark.createDataFrame(rows, f"{names[0]} bigint, text string").repartition(3)
    clash = ("sha", "Words", "place", "length", "fingerprint", "n_hit", "window", "set", "salt", "items", "run", "at")
    return plain.select(*names, *(F.lit(i).alias(c) for i, c in enumerate(clash)))


@pytest.mark.parametrize("broadcast", [dc.MOST_BROADCAST, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_contamination(spark, seed, broadcast, monkeypatch):
    monkeypatch.setattr(dc, "MOST_BROADCAST", broadcast)
    docs, items = made(seed)
    found = dc.contamination(frame(spark, docs, ("doc_id", "text")), frame(spark, items, ("item_id", "text")))
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_force(docs, items)


def test_without_rows(spark):
    docs, items = made(3)
    f = lambda rows, name: frame(spark, rows, (name, "text"))
    assert dc.contamination(f([], "doc_id"), f(items, "item_id")).collect() == []
    found = dc.contamination(f(docs, "doc_id"), f([], "item_id")).collect()
    assert sorted((tuple(r) for r in found), key=str) == by_force(docs, [])


def test_a_span_of_a_window_shares_a_fingerprint(spark):
    rng = random.Random(5)
    span = [f"w{rng.randint(0, 9)}" for _ in range(dc.WINDOW)]
    texts = [" ".join([*(f"a{rng.randint(0, 9)}" for _ in range(rng.randint(0, 20))), *span, *(f"b{rng.randint(0, 9)}" for _ in range(rng.randint(0, 20)))]) for _ in range(40)]
    found = dc.with_fingerprints(spark.createDataFrame([(t,) for t in texts], "text string"), []).select("words", "prints0").collect()
    assert len({r.prints0[[i for i in range(len(r.words)) if r.words[i : i + dc.WINDOW] == span][0]] for r in found}) == 1
    # Neighbouring windows mostly share one.
    assert all(len(set(r.prints0)) < len(r.prints0) for r in found if len(r.prints0) > 8)


def test_plan_is_native(spark):
    docs, items = made(4)
    plan = dc.contamination(frame(spark, docs, ("doc_id", "text")), frame(spark, items, ("item_id", "text")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
