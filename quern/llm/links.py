"""From candidate buckets to connected components, whatever a bucket's size.

Documents that share a bucket may be linked. Components need no more links than join them, so buckets
are worked through in two steps:

1. Each bucket's members are compared with two of its members, the smallest and the largest id: a
   number of pairs that is linear in the bucket. In groups of near copies this joins nearly all.
2. Buckets of over three members that still have several components: the component with most members
   is one side, and only the other members, the strays, are compared with all. Strays and members are dealt to a
   grid of cells, of about CELL of each and no more than about CELL_SIZE of their sizes, so no task holds a large
   bucket whole, and a bucket with few strays has about one row for each member. A cell gives links that join
   components, fewer than it has members.

Every pair that shares a bucket and isn't joined by then has been compared, so no link is lost.

Ids that very many pairs have, hubs, have copies, under which pairs and what is known of the hub (such as its text) meet; ids with
very many links are broadcast where links are joined by id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import HOT, discard, join_hot, stored

#: Members and strays of a bucket that one cell takes, about.
CELL = 512
#: Sizes of a cell's members that are held at once, about, in all.
CELL_SIZE = 2 << 20
#: Copies of an id that very many pairs have, at most.
MOST_COPIES = 64
#: Parts of a bucket when its members are told what it holds, so that a large bucket isn't one task's.
SALTS = 16

Check, Verify = Callable[[DataFrame], DataFrame], Callable[[DataFrame, DataFrame], DataFrame]


def _is_star(edges: DataFrame) -> bool:
    """Whether each a has one edge only and is no edge's b."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("up")), F.struct(F.col("b").alias("v"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    each = ends.groupBy("v").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not each.agg(F.max((F.col("up") > 0) & (F.col("n") > 1)).alias("x")).first().x


def components(links: DataFrame) -> DataFrame:
    """(a, b) to (id, component): the smallest id that is reachable, for each id in a link.

    Alternating large-star and small-star steps: neighbours are hung on the smallest one near, until all edges
    are stars. The number of steps grows with the logarithm of the ids. Each is written to the shared folder.
    """
    # a > b from here on: b is nearer to the root.
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    while not _is_star(edges):
        two = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        nearest = two.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = join_hot(two, nearest, "u", "n", 2 * edges.count()).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, large = edges, stored(large, "large-star")
        near = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        hung = join_hot(large, near, "u", "n", large.count()).select(F.col("v").alias("a"), F.col("m").alias("b"))
        near = near.drop("n")
        edges = stored(hung.unionByName(near.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct(), "small-star")
        discard(before, large)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def linked_components(members: DataFrame, verify: Verify, settle: Check) -> DataFrame:
    """(id, component) of every id with a link.

    members: (key, id, low, high, many, size), stored: the members of each bucket with its smallest and largest id and
    whether it has over three members, one row for each member; other columns are handed on. verify: pairs (a, b, sa, sb), and hubs, to those that
    are links; see _seated and with_copies. settle: cells of unsettled buckets (see _cells), stored, to pairs (a, b) that join all that the
    cell's links join; they are verified.
    """
    ends = F.array(F.struct(F.col("low").alias("a"), F.col("id").alias("b")), F.struct(F.col("id").alias("a"), F.col("high").alias("b")))
    pairs = members.select(F.explode(ends).alias("p")).select("p.a", "p.b").where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    seated, hubs = _seated(pairs)
    found = stored(components(verify(seated, hubs)), "components")
    discard(pairs, hubs)
    cells = stored(_cells(members, found), "cells")
    if cells.isEmpty():
        return found
    more = stored(settle(cells).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "settled")
    if more.isEmpty():
        return found
    # What is joined so far counts as links too.
    joined = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    discard(cells)
    seated, hubs = _seated(more)
    last = stored(components(verify(seated, hubs).select("a", "b").unionByName(joined)), "components")
    discard(more, hubs, found)
    return last


def _seated(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs with sa and sb, hubs). hubs, stored: (id, copies) of ids that more than one in HOT of all pairs has at one end, so fewer than 2 * HOT. sa and sb: which copy of a hub the pair meets, else 0."""
    total = pairs.count()
    n = [pairs.groupBy(F.col(end).alias("id")).agg(F.count("*").alias("n")).where(F.col("n") * HOT > total) for end in ("a", "b")]
    copies = F.least(F.lit(MOST_COPIES), F.ceil(F.max("n") * HOT / total)).cast("int") if total else F.lit(1)
    hubs = stored(n[0].unionByName(n[1]).groupBy("id").agg(copies.alias("copies")), "hubs")
    for end, other in (("a", "b"), ("b", "a")):
        pairs = pairs.join(F.broadcast(hubs.toDF("hub", "copies")), F.col(end) == F.col("hub"), "left")
        pairs = pairs.withColumn(f"s{end}", F.coalesce(_part(other, F.col("copies"), 4), F.lit(0))).drop("hub", "copies")
    return pairs, hubs


def with_copies(df: DataFrame, hubs: DataFrame) -> DataFrame:
    """df (id, ...) with copy, a row for each copy of a hub, and one for other ids."""
    found = df.join(F.broadcast(hubs), "id", "left")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")


def _part(of: str, parts: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(of, F.lit(seed)), parts).cast("int")


def _cells(members: DataFrame, found: DataFrame) -> DataFrame:
    """Of buckets with several components, what each of their cells holds: key, row and column of the cell, the member, its size and component.

    asks: the row is a stray that is to be compared with the cell's members (rows that don't ask). stray: the member isn't in the
    bucket's largest component. Each stray asks in all cells of its row, each member answers in all of its column,
    so there are strays * (members / CELL) and members * (strays / CELL) rows, both rounded up.
    """
    named = members.where("many").join(found, "id", "left").drop("low", "high", "many").withColumn("component", F.coalesce("component", "id"))
    counts = named.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    buckets = counts.groupBy("key").agg(F.max(F.struct("n", (-F.col("component")).alias("c"))).alias("top"), F.sum("n").alias("members"), F.sum("size").alias("size"), F.count("*").alias("components")).where("components > 1")
    mean = F.col("size") / F.col("members")
    cells = lambda n: F.greatest(F.lit(1), F.ceil(n / CELL), F.ceil(n * mean / CELL_SIZE)).cast("int")
    buckets = buckets.select("key", (-F.col("top.c")).alias("largest"), cells(F.col("members")).alias("columns"), cells(F.col("members") - F.col("top.n")).alias("rows"))
    buckets = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = named.withColumn("salt", _part("id", F.lit(SALTS), 1)).join(buckets, ["key", "salt"]).drop("salt")
    left = left.withColumn("stray", F.col("component") != F.col("largest")).drop("largest")
    own = left.withColumn("column", _part("id", F.col("columns"), 2)).withColumn("row", _part("id", F.col("rows"), 3))
    seats = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: F.struct(F.lit(False).alias("asks"), r.alias("row"), F.col("column").alias("column")))
    asked = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda c: F.struct(F.lit(True).alias("asks"), F.col("row").alias("row"), c.alias("column")))
    seated = own.withColumn("at", F.explode(F.when(F.col("stray"), F.concat(seats, asked)).otherwise(seats)))
    return seated.drop("rows", "columns", "row", "column").select("*", "at.asks", "at.row", "at.column").drop("at")


def by_cell(cells: DataFrame, schema: str, of: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """What a function gives for each cell's rows."""
    place = ["key", "row", "column"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            where = [held.column(k).to_numpy() for k in place]
            starts = [0, *(np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in where])) + 1).tolist()]
            for a, b in zip(starts[:-1], starts[1:]):
                yield of(held.slice(a, b - a))
            held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield of(held)

    # The number of partitions follows the rows.
    return cells.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, schema)


class Joined:
    """Components that are joined as links are found."""

    def __init__(self, component: list[int]) -> None:
        self.component, self.root = component, {c: c for c in component}

    def top(self, i: int) -> int:
        root, x = self.root, self.component[i]
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, i: int, j: int) -> None:
        self.root[self.top(i)] = self.top(j)
