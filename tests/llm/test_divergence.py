"""Distances of sources and their terms against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import divergence as dv


def terms(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)


def by_force(rows, least, most=50):
    counts, all_counts, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in ((t, g or "", s or "") for t, g, s in rows):
        found = terms(text)
        counts[lang, source].update(found)
        all_counts[lang].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g for g, _ in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = shares(all_counts[lang])
        p = {s: shares(c) for (g, s), c in counts.items() if g == lang}
        for s in p:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in p if o != s]
            told = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", told)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked if part == "pair" else ranked[:most], 1)]
    return sorted(out)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["Foo", "BAR", "baz", "δέλτα", "éa", "x", "été", "alpha", "beta", "gamma", *(f"w{chr(97 + i)}" for i in range(20))]
    text = lambda k: rng.choice([" ", "1", ". ", "\n"]).join(rng.choice(vocabulary[: rng.randint(3, len(vocabulary))]) for _ in range(k))
    rows = [(text(rng.randint(0, 40)), rng.choice(["en", "de"]), rng.choice(["a", "b", "c", "é", "a long name"])) for _ in range(150)]
    rows += [(None, "en", "none"), ("", "en", "empty"), ("12 - 34", "de", "no terms"), ("foo bar", None, None), ("foo", None, "b"), (None, None, None), ("lone words", "xx", "only"), ("rare " * 50_000 + "foo " * 50_000, "en", "a")]
    return rows + [("foo foo bar", "en", "hot")] * 60


def frame(spark, rows):
    plain = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    clash = ("term", "Docs", "n", "item", "value", "rank", "part", "p", "q", "p0", "salt", "v")
    return plain.select("text", "lang", "source", *(F.lit(i).alias(c) for i, c in enumerate(clash)))


@pytest.mark.parametrize(("seed", "least"), [(1, 10), (2, 1), (3, 10_000)])
def test_divergence(spark, seed, least):
    rows = made(seed)
    assert sorted(tuple(r) for r in dv.divergence(frame(spark, rows), least).collect()) == by_force(rows, least)


def test_a_crowded_sketch_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(dv, "sketch_cells", lambda df: 16)
    monkeypatch.setattr(dv, "BLOCK", 8)
    rows = made(4)
    assert sorted(tuple(r) for r in dv.divergence(frame(spark, rows), 20, 7).collect()) == by_force(rows, 20, 7)


def test_of_nothing(spark):
    assert dv.divergence(frame(spark, [])).collect() == []


def test_sketch_never_shows_less(spark):
    rows = made(5)
    docs, cells = Counter(), 64
    for text, lang, _ in rows:
        docs.update({(lang or "", t) for t in terms(text)})
    sketch = dv.document_sketch(frame(spark, rows).select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang"))), cells)
    found = dv.Terms(pa.array([" ".join(sorted({t for _, t in docs}))]))
    names = [x.decode() for x in found.distinct.to_pylist()]
    for lang in ("en", "de", ""):
        at = dv._cells(pa.array([lang]), found, np.arange(len(names)), cells)
        assert all(min(sketch[k, at[k, i]] for k in range(dv.DEPTH)) >= min(255, docs[lang, t]) for i, t in enumerate(names))


@pytest.mark.parametrize("text", ["", None, "a", "Ab,cD", "é1É", "123", "\x7fx\x00y", "日本 語A"])
def test_terms(text):
    found = dv.Terms(pa.array([text, "pad ", text], pa.string()))
    words = [found.distinct.to_pylist()[i].decode() for i in found.number]
    assert [w for w, d in zip(words, found.document) if d == 2] == terms(text) == [w for w, d in zip(words, found.document) if d == 0]
