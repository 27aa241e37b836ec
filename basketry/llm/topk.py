"""Exact top-k inner products by aggregation of sorted lists without random access.

Vectors lie in blocks of bounded size, and every block of queries meets every block of vectors.
A block keeps one list per dimension, sorted by value, that all its queries share: a positive
component reads its list from the top, a negative one from the bottom. All lists are read side by
side to growing depth, for many queries at once. A vector's upper bound takes, for each list that has not
shown it yet, the list's current value; so the bounds of all pairs are two matrix products, of the
lists' values as far as they are read. The leading vectors are read to the end, so their lower bounds are their scores;
the k-th best of these rules out every vector whose upper bound lies below it. Reading stops when
few are left, and what is left is resolved to exact scores. Nothing else than the bounds decides, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm.ship import ship


@dataclass(frozen=True)
class TopSettings:
    """Results per query, rows of a block of vectors and of queries, depths to which the lists are
    read (as shares of their length), share of the vectors that may be left for resolving early."""

    k: int = 5
    rows: int = 4096
    queries: int = 512
    depths: tuple[float, ...] = (1 / 2, 3 / 4, 7 / 8)
    few: float = 1 / 4


class SortedLists:
    """A block of vectors with one sorted list for each dimension."""

    TILE = 64  # queries whose bounds are held at once

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        self.exact = values.astype(np.float64)
        self.ranked = np.sort(self.exact, axis=0)  # each list from its bottom to its top

    def top(self, queries: np.ndarray, own: np.ndarray, settings: TopSettings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the k best rows, without the query's own, best first."""
        weights = queries.astype(np.float64)
        reach = np.abs(weights).sum(axis=1) * float(np.abs(self.exact).max(initial=0))
        for lo in range(0, own.size, self.TILE):
            tile = slice(lo, lo + self.TILE)
            live = self.ids != own[tile, None]
            sure = reach[tile] < 2**52  # else sums are not exact in doubles, and all rows are resolved as integers
            live[sure] = self._left(weights[tile][sure], live[sure], settings)
            for q, rows, exact in zip(range(lo, lo + live.shape[0]), map(np.flatnonzero, live), sure):
                scores = (self.exact[rows] @ weights[q]).astype(np.int64) if exact else self.values[rows] @ queries[q]
                k = min(settings.k, rows.size)
                if 0 < k < rows.size:
                    best = scores >= np.partition(scores, rows.size - k)[rows.size - k]
                    rows, scores = rows[best], scores[best]
                best = np.lexsort((self.ids[rows], -scores))[:k]
                yield self.ids[rows[best]], scores[best]

    def _left(self, weights: np.ndarray, live: np.ndarray, settings: TopSettings) -> np.ndarray:
        """Of each query the rows that may be among the k best once the lists are read deep enough."""
        n = self.ids.size
        leaders = min(2 * settings.k, n)
        k = min(settings.k, leaders)
        todo = np.flatnonzero(live.sum(axis=1) > settings.k)
        for depth in settings.depths:
            if not todo.size:
                break
            end = max(int(n * depth), 1)
            w = weights[todo]
            # What has been seen counts as it is, all else as the value where its list stands now.
            from_top = np.maximum(self.exact, self.ranked[n - end])
            from_bottom = np.minimum(self.exact, self.ranked[end - 1])
            high = np.maximum(w, 0) @ from_top.T + np.minimum(w, 0) @ from_bottom.T
            high[~live[todo]] = -np.inf
            # The leaders' lower bounds are their scores, as they are read to the end.
            lead = np.argpartition(high, n - leaders, axis=1)[:, n - leaders :]
            score = np.einsum("qld,qd->ql", self.exact[lead], w)
            score[np.isinf(np.take_along_axis(high, lead, axis=1))] = -np.inf
            kth = np.partition(score, leaders - k, axis=1)[:, leaders - k]
            live[todo] &= high >= kth[:, None]
            todo = todo[live[todo].sum(axis=1) > max(settings.k, settings.few * n)]
        return live


def integers(vector: Column) -> Column:
    """floor(256 x) of each component, x as double; null if any is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good & vector.isNotNull(), F.transform(wide, lambda x: F.floor(x * 256).cast("long")))


SCORES = "query_id long, vec_id long, score long"


def _block(settings: TopSettings):
    def run(key: tuple, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            lists = SortedLists(np.asarray(vectors.column("vec_id")), _matrix(vectors.column("v")))
            asked = np.asarray(queries.column("vec_id"))
            for own, (ids, scores) in zip(asked, lists.top(_matrix(queries.column("v")), asked, settings)):
                out.append((np.full(ids.size, own), ids, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return np.asarray(lists.flatten()).reshape(len(lists), -1)


def top_inner_products(
    vectors: DataFrame, every: int = 50, vector: str = "embedding", settings: TopSettings = TopSettings()
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows for each query.

    Queries are the rows whose vec_id is divisible by `every`; candidates are all rows but those of
    the query's own vec_id. The score is the inner product of floor(256 x); equal scores go by
    smaller vec_id, and rows that share a vec_id are one vector. A vector that is null or holds a
    null or a component that is not finite takes no part, nor does a row without vec_id; vectors
    are compared with those of their own length. Fewer than k candidates give fewer rows. Extra
    columns are ignored; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col(vector)).alias("v"))
    rows = rows.filter("vec_id is not null and v is not null").dropDuplicates(["vec_id"])
    rows = rows.withColumn("d", F.size("v")).filter("d > 0")
    count = vectors.count()
    blocks = max(-(-count // settings.rows), 1)
    groups = max(-(-count // (settings.queries * every)), 1)
    place = F.xxhash64("vec_id")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.filter(F.col("vec_id") % every == 0)
    left = rows.select("vec_id", "v", "d", F.pmod(place, F.lit(blocks)).cast("int").alias("c"), numbers(groups).alias("q"))
    right = queries.select("vec_id", "v", "d", numbers(blocks).alias("c"), F.pmod(place, F.lit(groups)).cast("int").alias("q"))
    keys = ("d", "c", "q")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block(settings), SCORES)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= settings.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
