"""Approximate nearest neighbours by collision counting over query-centred windows.

Vectors are projected on PROJECTIONS random directions, each a sorted array. A query opens a window
around its own place in every array, and widens all windows together, round by round, each
time looking only at what is new (virtual rehashing: wider windows are unions of the narrower). A
vector that is in FRACTION of the windows has collided often enough, and its distance is measured in
full. The search ends when a vector as far as the k-th best would have collided often enough by now with
probability SURE, so what is still unseen is hardly nearer. Windows begin at a width that is fitted to a bounded sample of the part's own vectors, and grow
slowly where it matters, so that few vectors collide often enough without being near.

Scale. Rows and queries are dealt to a grid: parts of rows (PART_BYTES each) by parts of queries. A cell
builds its arrays in memory and answers its queries; the k best of all cells of a query are merged by a
window whose rows are limited before they are shuffled. Nothing is broadcast; every row is indexed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import pick, stored, table

PROJECTIONS = 160
#: Of the projections: a vector that is near in so many is measured.
FRACTION = 0.82
#: Windows grow by this from round to round, and faster while no vector has NEAR of the collisions that it needs.
GROWTH, GROWTH_FAR, NEAR = 1.05, 1.3, 0.8
SURE = 0.98
#: The bounded sample of a part's vectors that the first width is fitted to, by distances to all others; FITTED_Z is where a normal law has 60 % within.
FITTED, FITTED_K, FITTED_Z = 32, 10, 0.8416
#: Counts of collisions that are held at once: queries times vectors.
HELD = 8 << 20
#: Of a part's vectors, in double precision, about; queries of a part.
PART_BYTES = 32 << 20
PART_QUERIES = 500
SEED = 3


def _enough(p: float, m: int, least: int) -> float:
    """The probability of at least so many successes in m trials, by the normal law with a continuity correction."""
    if p <= 0 or p >= 1:
        return float(p >= 1)
    return 0.5 * math.erfc((least - 0.5 - m * p) / math.sqrt(2 * m * p * (1 - p)))


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean, with squares summed from the first component to the last."""
    return np.sqrt(np.cumsum((vectors - query) ** 2, 1)[:, -1])


class Arrays:
    """The sorted projections of a part's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS) -> None:
        self.ids, self.vectors, self.m = ids, vectors, projections
        #: Vectors whose distance was measured, over all queries so far.
        self.verified = 0
        self.least = max(1, math.ceil(FRACTION * projections))
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], projections))
        # Very large components would overflow in sums of squares; a common scale changes no order.
        self.scale = float(np.abs(vectors).max()) or 1.0
        scaled = vectors / self.scale
        places = scaled @ self.directions
        self.order = np.argsort(places, 0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(places.T, self.order, 1)
        spread = float(self.sorted[:, -1].max() - self.sorted[:, 0].min())
        self.first = max(self._first_width(scaled), spread / 100, 1e-300)

    def _first_width(self, scaled: np.ndarray) -> float:
        """Where windows begin: at a width that a vector as far as the FITTED_K-th nearest is in with probability FITTED_P, for the nearest of FITTED of the part's own vectors."""
        n = len(scaled)
        some = np.unique(np.linspace(0, n - 1, FITTED).astype(int))
        k = min(FITTED_K, n - 1)
        if k < 1:
            return 0.0
        return FITTED_Z * min(float(np.partition(distances(scaled, scaled[i]), k)[k]) for i in some)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query, ids and Euclidean distances of the k nearest found other than its own id, nearest first, ties to the smaller id."""
        step = max(1, HELD // len(self.ids))
        return [x for i in range(0, len(queries), step) for x in self._some(query_ids[i : i + step], queries[i : i + step], k)]

    def _some(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n, places = len(self.ids), (queries / self.scale) @ self.directions
        counts, seen = np.zeros((len(queries), n), np.int16), self.ids[None, :] == query_ids[:, None]
        most = np.minimum(k, (~seen).sum(1))
        found = [np.empty(0, np.int64) for _ in queries]
        far = [np.empty(0) for _ in queries]
        low = np.stack([np.searchsorted(s, p) for s, p in zip(self.sorted, places.T)], 1)
        high, width = low.copy(), self.first
        reach = np.maximum(np.abs(places - self.sorted[:, 0]), np.abs(places - self.sorted[:, -1])).max(1)
        open_ = np.flatnonzero(most > 0)
        while len(open_):
            # The ends of all open queries' windows, array by array.
            ends = [(np.searchsorted(s, p - width, "left"), np.searchsorted(s, p + width, "right")) for s, p in zip(self.sorted, places[open_].T)]
            a, b = (np.stack(x, 1) for x in zip(*ends))
            left = []
            for row, q in enumerate(open_):
                new, begins = [], width == self.first
                if begins and 2 * int((b[row] - a[row]).sum()) > n * self.m:
                    # Windows that begin with more than half of all count what they leave out.
                    counts[q] = self.m - np.bincount(np.concatenate([x for order, a0, b0 in zip(self.order, a[row].tolist(), b[row].tolist()) for x in (order[:a0], order[b0:])]), minlength=n)
                    low[q], high[q] = a[row], b[row]
                for order, a0, a1, b0, b1 in zip(self.order, a[row].tolist(), low[q].tolist(), high[q].tolist(), b[row].tolist()):
                    if a0 < a1:
                        new.append(order[a0:a1])
                    if b0 < b1:
                        new.append(order[b0:b1])
                if new:
                    counts[q] += np.bincount(np.concatenate(new), minlength=n).astype(np.int16)
                low[q], high[q] = np.minimum(a[row], low[q]), np.maximum(b[row], high[q])
                at = np.flatnonzero((counts[q] >= self.least) & ~seen[q])
                if len(at):
                    seen[q, at] = True
                    self.verified += len(at)
                    ids, d = np.concatenate([found[q], at]), np.concatenate([far[q], distances(self.vectors[at], queries[q])])
                    best = np.lexsort((self.ids[ids], d))[: most[q]]
                    found[q], far[q] = ids[best], d[best]
                if width < reach[q] and not (len(found[q]) == most[q] and self._sure(float(far[q][-1]) / self.scale, width)):
                    left.append(q)
            # Far from any vector that has collided often enough, windows grow fast.
            near = len(left) and int(counts[left].max()) >= NEAR * self.least
            open_, width = np.array(left, np.int64), width * (GROWTH if near else GROWTH_FAR)
        return [(self.ids[x], d) for x, d in zip(found, far)]

    def _sure(self, kth: float, width: float) -> bool:
        """Whether a vector as far as the k-th best would have collided often enough by now."""
        return kth == 0 or _enough(math.erf(width / (kth * math.sqrt(2))), self.m, self.least) >= SURE


def _usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Of each query: query_id, rank (from 1), vec_id, score (Euclidean distance, in double precision).

    Queries are the rows of vectors for which is_query (of vec_id and vector) holds; candidates all rows
    but those of the query's own id. Vectors that are null, zero, or hold null or non-finite components
    take no part, nor do rows without an id; vectors of another length than the query's are no candidates. A query whose id
    comes back is the one of its smallest vector; candidates that repeat are candidates each. With fewer than k candidates
    all are returned; an empty table gives no rows.
    """
    rows = pick(vectors, id_column, vector_column).toDF("vec_id", "vector")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")).where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    rows = stored(rows.select("vec_id", "vector", F.size("vector").alias("dim")), "vectors")
    queries = rows.where(is_query).groupBy("vec_id", "dim").agg(F.min("vector").alias("vector"))
    queries = stored(queries.groupBy("vec_id").agg(F.min(F.struct("dim", "vector")).alias("q")).select("vec_id", "q.dim", "q.vector"), "queries")
    counts = rows.groupBy("dim").agg(F.count("*").alias("n")).join(queries.groupBy("dim").agg(F.count("*").alias("q")), "dim")
    parts = stored(counts.select(F.col("dim").alias("d"), F.ceil(F.col("n") * F.col("dim") * 8 / PART_BYTES).cast("int").alias("parts"), F.ceil(F.col("q") / PART_QUERIES).cast("int").alias("q_parts")), "parts")

    def spread(df: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        """Each row in its own part, once for each part of the other side."""
        df = df.join(parts, F.col("dim") == F.col("d")).withColumn("own", F.pmod(F.xxhash64("vec_id", "vector"), F.col(own)).cast("int"))
        df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        part, q_part = ("other", "own") if query else ("own", "other")
        return df.select("dim", F.col(part).alias("part"), F.col(q_part).alias("q_part"), F.lit(query).alias("query"), "vec_id", "vector")

    grid = spread(rows, "parts", "q_parts", False).unionByName(spread(queries, "q_parts", "parts", True))

    def answer(cell: pa.Table) -> pa.Table:
        query = cell.column("query").to_numpy()
        ids = cell.column("vec_id").to_numpy()
        dim = cell.column("dim")[0].as_py()
        every = cell.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        out: list[tuple] = []
        if query.any() and not query.all():
            # Rows come in any order; sorted by id, equal runs give equal results.
            at = np.flatnonzero(~query)
            at = at[np.argsort(ids[at], kind="stable")]
            arrays = Arrays(ids[at], every[at])
            asked = np.flatnonzero(query)
            for i, (v, d) in zip(asked, arrays.nearest(ids[asked], every[asked], k)):
                out += [(ids[i], *x) for x in zip(v, d)]
        return pa.table({"query_id": pa.array([x[0] for x in out], pa.int64()), "vec_id": pa.array([x[1] for x in out], pa.int64()), "score": pa.array([x[2] for x in out], pa.float64())})

    found = grid.groupBy("dim", "part", "q_part").applyInArrow(answer, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x != 0)) > 0
), p as (
  select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (c.e[i] - q.e[i]) * (c.e[i] - q.e[i])), lambda a, b: a + b)) as score from v q join v c on q.vec_id % 100 = 0 and q.vec_id != c.vec_id and len(q.e) = len(c.e)
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score, vec_id) as rank from p) where rank <= 10
"""
