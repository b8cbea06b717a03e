"""The prefix trie of conversations, with sums over subtrees by heavy-path decomposition.

A node is a distinct sequence of first turns, (role, text) each; its members are the conversations that begin with it.

1. Turns get their places. Rows are put in one order, ranges of it go to tasks, and a turn's place is its place in its
   range and the conversation's turns in ranges before: a conversation of any length is spread over many tasks.
2. Prefixes get names: the sum of LANES numbers below 2**31 for each turn, made of the turn's SHA-256 and of powers for its place, modulo
   primes. Sums need no order, so they are made in blocks of BLOCK turns, then within a block. Two different
   prefixes of one depth have one name with a chance of about 2**-120.
3. Of a node's children the one with most members is its heavy child (of equals the one with the smallest member). A path of heavy children ends in
   a leaf, and each node is on just one; it is known by the leaf's smallest member, whose turns it lies on.
4. A light child has at most half of its parent's members, so no more than log2(members) light children are above any node.
   Round by round, from paths that have most light children above them, each path's whole sum is attached to the parent of its top.
5. Every node's sum is then the sum of what its path has from there on, itself and what is attached: sums from the end
   along the path, again in blocks.

Scale. No step holds a conversation, a path, a level or a node's members. Conversations are joined by (conversation, block). A node
that very many rows share (the root, a common first turn) is one key: such nodes, of which
there are at most HOT as each has more than one in HOT of all rows, are broadcast, and rows of others meet in a shuffle. A
digest of very many members is a chain over all of them and so one task's, which reads one row for 4096 ids, in order, and holds none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import discard, partitions_for, pick, small_batches, stored, table

#: Turns of a conversation, or nodes of a path, that are summed together.
BLOCK = 4096
#: Nodes that are broadcast at most.
HOT = 1000
#: Numbers that name a prefix: primes below 2**31, and powers of a base for each.
PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.uint64)
BASES = np.array([1103515245, 1566083941, 1812433253, 1664525129], np.uint64)
LANES = [f"x{k}" for k in range(len(PRIMES))]
#: Ids, of a span of so many, that are in one row of a digest; a power of two.
IDS = 4096
NODE = ["depth", "a", "b"]


def powers(places: np.ndarray) -> np.ndarray:
    """Of each place, the power of each base modulo its prime."""
    out, square, left = np.ones((len(places), len(PRIMES)), np.uint64), BASES.copy(), places.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % PRIMES
        square, left = square * square % PRIMES, left >> np.uint64(1)
    return out


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 0, chars, hash), stored: turns in the order of turn, null first, then role and text."""
    small_batches(conversations.sparkSession)
    t = pick(conversations, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("long"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    t = t.where("conv_id is not null")
    # What ranges are cut by is short; turns that agree in it are in one range.
    ordered = t.repartitionByRange(partitions_for(t), "conv_id", "turn", "role", F.substring("text", 1, 40)).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            new = np.concatenate([[ids[0] != last], ids[1:] != ids[:-1]])
            begins = np.flatnonzero(new)
            own = np.arange(len(ids)) - _begins(begins, len(ids), seen)
            last, seen = ids[-1], int(own[-1]) + 1
            yield pa.record_batch({"conv_id": batch.column("conv_id"), "part": pa.array(np.full(len(ids), part)), "own": pa.array(own), "chars": batch.column("chars"), "hash": batch.column("hash")})

    slim = ordered.select("conv_id", F.length("text").cast("long").alias("chars"), F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)).alias("hash"))
    ranged = stored(slim.mapInArrow(run, "conv_id bigint, part bigint, own bigint, chars bigint, hash binary"), "turns")
    # Of each conversation a row for each range that has turns of it.
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return stored(ranged.join(counts, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("own")).alias("place"), "chars", "hash"), "places")


def _begins(begins: np.ndarray, n: int, seen: int) -> np.ndarray:
    """Where each row's conversation begins, for a batch whose first rows go on with the conversation before, of which seen turns are done."""
    bounds = np.append(begins, n)
    return np.concatenate([np.full(bounds[0], -seen), np.repeat(begins, np.diff(bounds))])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows): conv_id and length of each rebuilt conversation; conv_id, depth from 1, chars and hash of each of its turns."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6)
    bases = convs.where(F.col("conv_id") == F.col("base")).select("base", F.col("own").alias("base_turns"))
    # A base has under 200 conversations.
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    convs = stored(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"), "own"), "conversations")
    first = turns.where("place < 5 and conv_id % 100 = 0").select(F.col("conv_id").alias("base"), "place", "chars", "hash")
    borrowed = convs.where("taken > 0").join(first, "base").where("place < taken").select("conv_id", (F.col("place") + 1).alias("depth"), "chars", "hash")
    kept = _by_block(turns.withColumn("block", F.floor(F.col("place") / BLOCK)), convs.select("conv_id", "h", "taken", F.col("own").alias("length")))
    kept = kept.where("place >= h").select("conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "chars", "hash")
    return convs.select("conv_id", "length"), borrowed.unionByName(kept)


def _by_block(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """rows (conv_id, block, ...) with what convs (conv_id, length, ...) has; a long conversation isn't one key."""
    blocks = convs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / BLOCK)))).drop("length")
    return rows.join(blocks, ["conv_id", "block"])


def named_prefixes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, block, depth, a, b, up_a, up_b, chars, ends), stored: each conversation's nodes from the root on, with names and those of parents; ends: the conversation's last node."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            four = np.frombuffer(b"".join(batch.column("hash").to_pylist()), "<u8").reshape(-1, len(PRIMES)) % PRIMES
            found = four * powers(batch.column("depth").to_numpy()) % PRIMES if len(four) else four
            yield pa.record_batch({**{k: batch.column(k) for k in ("conv_id", "depth", "chars")}, **{x: pa.array(found[:, i].astype(np.int64)) for i, x in enumerate(LANES)}})

    kind = "conv_id bigint, depth bigint, chars bigint, " + ", ".join(f"{x} bigint" for x in LANES)
    w = rows.mapInArrow(weigh, kind).withColumn("block", F.floor(F.col("depth") / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    w = stored(w.select("conv_id", "block", "depth", "chars", *LANES, *(F.sum(x).over(inside).alias(f"in_{x}") for x in LANES)), "weighed")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = w.groupBy("conv_id", "block").agg(*(F.sum(x).alias(x) for x in LANES))
    # Sums of 2**32 numbers below 2**31 are exact.
    sums = sums.select("conv_id", "block", *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"to_{x}") for x in LANES))
    upto = [(F.col(f"in_{x}") + F.col(f"to_{x}")) % int(p) for x, p in zip(LANES, PRIMES)]
    up = [(F.col(f"in_{x}") + F.col(f"to_{x}") - F.col(x)) % int(p) for x, p in zip(LANES, PRIMES)]
    two = lambda c, i: F.shiftleft(c[i], 31) + c[i + 1]
    own = w.join(sums, ["conv_id", "block"]).select("conv_id", "block", "depth", two(upto, 0).alias("a"), two(upto, 2).alias("b"), two(up, 0).alias("up_a"), two(up, 2).alias("up_b"), "chars")
    own = _by_block(own, convs.withColumn("last", F.col("length"))).withColumn("ends", F.col("depth") == F.col("last")).drop("last")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("block"), zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"), zero.alias("chars"), (F.col("length") == 0).alias("ends"))
    return stored(own.unionByName(root), "prefixes")


def _with_nodes(rows: DataFrame, nodes: DataFrame, weight: str, total: int) -> DataFrame:
    """rows (NODE, ...) with columns of nodes (NODE, weight, ...). A node meets weight rows at most, and all weights add up to total at most: so fewer than HOT nodes, which are broadcast, have more than one in HOT of it."""
    hot = nodes.where(F.col(weight) * HOT > total).drop(weight)
    rest = nodes.where(F.col(weight) * HOT <= total).drop(weight)
    first = rows.join(F.broadcast(hot), NODE)
    return first.unionByName(rows.join(F.broadcast(hot.select(*NODE)), NODE, "left_anti").join(rest, NODE).select(*first.columns))


def _digests(prefixes: DataFrame) -> DataFrame:
    """(NODE, ends_sha256) of nodes in which conversations end: of their ids in ascending order."""
    ids = prefixes.where("ends").groupBy(*NODE, F.shiftright("conv_id", IDS.bit_length() - 1).alias("group"))
    ids = ids.agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if node == at:
                    digest.update(b"," + ids.encode())
                else:
                    if at is not None:
                        out.append((*at, digest.hexdigest()))
                    at, digest = node, hashlib.sha256(ids.encode())
            yield _digest_rows(out)
        if at is not None:
            yield _digest_rows([(*at, digest.hexdigest())])

    # The numbers of rows follow the nodes; one node's are in one partition.
    dealt = ids.repartition(partitions_for(prefixes), *NODE).sortWithinPartitions(*NODE, "group")
    return dealt.select(*NODE, "ids").mapInArrow(run, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*([pa.int64()] * len(NODE)), pa.string()]
    return pa.record_batch({n: pa.array([r[i] for r in rows], kind) for i, (n, kind) in enumerate(zip([*NODE, "ends_sha256"], kinds))})


def _children(prefixes: DataFrame) -> DataFrame:
    """(NODE, up_a, up_b, conv_id, n_convs, chars, n_children, heavy), stored: all nodes; heavy says whether a node is its parent's heavy child."""
    nodes = stored(prefixes.groupBy(*NODE).agg(F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars")), "nodes")
    up = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
    # A child is known by its smallest member: children of a node share none.
    up = up.agg(F.count("*").alias("n_children"), F.max(F.struct("n_convs", (-F.col("conv_id")).alias("c"))).alias("top"))
    up = stored(up.select(*NODE, "n_children", (-F.col("top.c")).alias("heavy_conv")), "parents")
    counted = nodes.join(up.drop("heavy_conv"), NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    # The heavy child as a node: its member has just one node at that depth.
    chosen = up.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("heavy_conv").alias("conv_id"), F.lit(True).alias("heavy"))
    out = counted.join(chosen, ["depth", "up_a", "up_b", "conv_id"], "left").withColumn("heavy", F.coalesce("heavy", F.lit(False)))
    return stored(out.select(*NODE, "up_a", "up_b", "conv_id", "n_convs", "chars", "n_children", "heavy"), "children")


def _paths(convs: DataFrame, prefixes: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored: (on, paths). on: (NODE, path, block) for each node; paths: (path, top: the depth of its first node, lights: light children on the way to it, length)."""
    leaves = nodes.where("n_children = 0").select("conv_id")
    lengths = stored(leaves.join(convs, "conv_id"), "leaves")
    along = stored(_by_block(prefixes.select("conv_id", "block", *NODE), lengths), "along")
    # As many rows meet a node as it has leaves, at most its members, and all nodes' members are the rows of prefixes.
    flagged = stored(_with_nodes(along, nodes.select(*NODE, "heavy", "n_convs"), "n_convs", prefixes.count()), "flagged")
    tops = flagged.groupBy("conv_id").agg(F.max(F.when(~F.col("heavy"), F.col("depth"))).alias("top"), (F.count_if(~F.col("heavy")) - 1).alias("lights"))
    paths = stored(lengths.join(tops, "conv_id"), "paths")
    on = stored(_by_block(flagged.select("conv_id", "block", *NODE), paths.select("conv_id", "top", "length")).where("depth >= top").select(*NODE, F.col("conv_id").alias("path"), "block"), "on-paths")
    discard(along, flagged)
    return on, paths.withColumnRenamed("conv_id", "path")


def subtree_sums(nodes: DataFrame, on: DataFrame, paths: DataFrame, own: dict[str, Column]) -> DataFrame:
    """(NODE, path, block, and sums over each node's subtree) of what own says of each node."""
    names = list(own)
    valued = stored(on.join(nodes.select(*NODE, "up_a", "up_b", *(c.cast("long").alias(n) for n, c in own.items())), NODE), "valued")
    whole = valued.groupBy("path").agg(*(F.sum(n).alias(n) for n in names))
    tops = valued.select("path", "depth", "up_a", "up_b").join(paths.select("path", F.col("top").alias("depth"), "lights"), ["path", "depth"])
    whole = stored(whole.join(tops, "path").select("path", "lights", (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"), *names), "path-sums")
    deepest = whole.agg(F.max("lights")).first()[0] or 0
    attached, round_ = [], None
    for lights in range(deepest, 0, -1):
        level = whole.where(F.col("lights") == lights)
        if round_ is not None:
            more = round_.groupBy("path").agg(*(F.sum(n).alias(f"more_{n}") for n in names))
            level = level.join(more, "path", "left").select(*NODE, *((F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names))
        sums = level.groupBy(*NODE).agg(*(F.sum(n).alias(n) for n in names))
        round_ = stored(sums.join(on.select(*NODE, "path"), NODE), f"attached-{lights}")
        attached.append(round_.drop("path"))
    if attached:
        more = reduce(DataFrame.unionByName, attached).select(*NODE, *(F.col(n).alias(f"more_{n}") for n in names))
        valued = valued.join(more, NODE, "left").select(*NODE, "path", "block", *((F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names))
    valued = stored(valued.select(*NODE, "path", "block", *names), "with-attached")
    below = Window.partitionBy("path").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = valued.groupBy("path", "block").agg(*(F.sum(n).alias(n) for n in names))
    blocks = blocks.select("path", "block", *(F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"below_{n}") for n in names))
    inside = Window.partitionBy("path", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = valued.select(*NODE, "path", "block", *(F.sum(n).over(inside).alias(n) for n in names))
    return summed.join(blocks, ["path", "block"]).select(*NODE, *((F.col(n) + F.col(f"below_{n}")).alias(n) for n in names))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conversations: conv_id, turn, role, text. A conversation c is rebuilt of the first h turns of conversation c - c % 100 and its own after its first h, where h is crc32
    of its decimal id modulo 6. conv_id is a node's smallest member, parent_conv_id its parent's, null for the root. n_leaves and saved_tokens
    are of the node's subtree: its childless nodes, and what members that share a node's last text save, in code points.
    Turns of a conversation are in the order of turn, null first; equal ones by role, then text; rows that repeat are turns each.
    A null role or text is empty. Rows without a conv_id are no conversation's. An empty table has no root and gives no
    rows; other columns are not looked at.
    """
    convs, rows = rebuilt(turns_of(conversations))
    prefixes = named_prefixes(convs, rows)
    nodes = _children(prefixes)
    on, paths = _paths(convs, prefixes, nodes)
    own = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")}
    sums = subtree_sums(nodes, on, paths, own)
    # Rows meet a parent once for each child.
    parents = nodes.where("n_children > 0").select(*NODE, F.col("conv_id").alias("parent_conv_id"), "n_children")
    up = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"), F.col("a").alias("own_a"), F.col("b").alias("own_b"))
    up = _with_nodes(up, parents, "n_children", nodes.count()).select((F.col("depth") + 1).alias("depth"), F.col("own_a").alias("a"), F.col("own_b").alias("b"), "parent_conv_id")
    out = nodes.join(sums, NODE).join(up, NODE, "left").join(_digests(prefixes), NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


_CRC = "xor(list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda c: [cast(ord(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda s, x: case when x >= 0 then xor(s, x) when s & 1 = 1 then xor(s >> 1, 3988292384) else s >> 1 end), 4294967295)"

OP12_SQL = f"""
with o as (
  select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first, role, text) as turns from conversations where conv_id is not null group by conv_id
), h as (select *, conv_id - conv_id % 100 as base, {_CRC} % 6 as h from o
), c as (
  select h.conv_id, list_concat(coalesce(b.turns[1 : h.h], []), h.turns[h.h + 1 :]) as turns from h left join o b on b.conv_id = h.base
), p as (
  select conv_id, unnest(range(0, len(turns) + 1)) as depth, turns from c
), q as (select conv_id, depth, len(turns) = depth as ends, turns[1 : depth] as node from p
), n as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '') as ids from q group by 1, 2
), k as (select node[1 : depth - 1] as parent, depth - 1 as depth, count(*) as n_children from n where depth > 0 group by 1, 2
), m as (
  select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * case when n.depth = 0 then 0 else length(node[n.depth].t) end as saved
  from n left join k on k.depth = n.depth and k.parent = n.node
), a as (
  select node[1 : d] as node, d as depth, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens from (select *, unnest(range(0, depth + 1)) as d from m) group by 1, 2
)
select m.conv_id, m.depth, u.conv_id as parent_conv_id, m.n_convs, m.n_children, a.n_leaves, cast(a.saved_tokens as bigint) as saved_tokens, sha256(m.ids) as ends_sha256
from m join a on a.depth = m.depth and a.node = m.node left join m u on u.depth = m.depth - 1 and u.node = m.node[1 : m.depth - 1]
"""
