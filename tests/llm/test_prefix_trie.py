"""The trie of conversations against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import prefix_trie as pt


def by_force(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    made = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(made[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-120, 340), 10**12, 10**12 + 7]:
        for turn in range(rng.randint(1, 9)):
            if c % 100 or rng.random() < 0.8:
                rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["hi", "é", "yes 😀", "no"])))
    rows += [(c, 1, "user", "same start") for c in range(400, 500)] + [(c, 2, "user", f"then {c.bit_length()} {c & 1}") for c in range(400, 500)] + [(c, 3, "user", f"{c}") for c in range(400, 500)]
    rows += [(5, None, "user", "first"), (6, None, None, None), (6, None, None, None), (7, 3, None, "x"), (7, 3, "a", None), (7, 3, "a", "b"), (None, 1, "user", "of none"), (None, None, None, None)]
    rows += [(777, i, "user", f"turn {i % 7}") for i in range(600)] + [(778, i, "user", f"turn {i % 7}") for i in range(500)] + [(700, i, "user", f"turn {i % 7}") for i in range(3)]
    rows += [(901, 0, "user", "long " * 200_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    plain = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    clash = ("place", "Depth", "hash", "chars", "part", "block", "path", "n_convs", "a", "b", "length", "own")
    return plain.select("conv_id", "turn", "role", "text", *(F.lit(i).alias(c) for i, c in enumerate(clash)))


@pytest.mark.parametrize(("block", "hot", "ids"), [(4096, 1000, 4096), (64, 5, 4)])
def test_trie(spark, block, hot, ids, monkeypatch):
    for name, value in (("BLOCK", block), ("HOT", hot), ("IDS", ids)):
        monkeypatch.setattr(pt, name, value)
    rows = made_rows(block)
    assert sorted((tuple(r) for r in pt.prefix_trie(frame(spark, rows)).collect()), key=str) == by_force(rows)


def test_of_nothing(spark):
    assert pt.prefix_trie(frame(spark, [])).collect() == []
    assert pt.prefix_trie(frame(spark, [(None, 1, "user", "x")])).collect() == []


def test_powers():
    places = np.array([0, 1, 2, 399, 10**9])
    assert pt.powers(places).tolist() == [[pow(int(b), int(p), int(m)) for b, m in zip(pt.BASES, pt.PRIMES)] for p in places]
    assert all(all(int(p) % d for d in range(2, 46342)) for p in pt.PRIMES)


def test_light_children_are_few(spark):
    """A full binary tree of 64 conversations: each light child halves the members."""
    rows = [(c, d, "user", str(c >> (5 - d) & 1)) for c in range(10**6, 10**6 + 64) for d in range(6)]
    convs, turns = pt.rebuilt(pt.turns_of(frame(spark, rows)))
    prefixes = pt.named_prefixes(convs, turns)
    nodes = pt._children(prefixes)
    on, paths = pt._paths(convs, prefixes, nodes)
    assert on.count() == on.select(*pt.NODE).distinct().count() == nodes.count()
    assert paths.agg(F.max("lights")).first()[0] <= 6
