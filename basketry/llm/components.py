"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.scratch import Scratch

#: Parts that the links of one node are dealt to, so that a hub does not fill a single task.
PARTS = 8
#: Links that a task holds or so; a graph of few links is done by few tasks.
LINKS = 100_000
_LINK = "u long, v long"


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _hung(greater_only: bool):
    """Hang the neighbours of each node on the least of them and itself.

    Reads a partition sorted by (u, v), in which the first neighbour of a node is the least; only
    the node that a batch ends with is remembered. With `greater_only`, neighbours above the node
    are hung, else all; the node itself is hung too, which keeps its parts together.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, least = None, None
        for batch in batches:
            u, v = (np.asarray(batch.column(c)) for c in ("u", "v"))
            if not u.size:
                continue
            new = np.ones(u.size, bool)
            new[1:] = u[1:] != u[:-1]
            new[0] = node is None or u[0] != node
            start = np.maximum.accumulate(np.where(new, np.arange(u.size), -1))
            low = np.where(start >= 0, np.minimum(u, v[start]), -1 if least is None else least)
            node, least = int(u[-1]), int(low[-1])
            own = new & (low < u)
            others = (v > u) if greater_only else (v != low)
            others &= v != low
            pairs = np.unique(np.stack([np.concatenate([u[own], v[others]]), np.concatenate([low[own], low[others]])]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    return run


def _by_node(links: DataFrame, tasks: int) -> DataFrame:
    """Sorted by node; the links of one node lie in a few partitions, equal ones in the same."""
    dealt = links.repartition(F.col("u"), F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    return dealt.coalesce(tasks).sortWithinPartitions("u", "v")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns node and component: the smallest node that each linked node reaches.

    `links` has the columns u and v in either order; nodes without a link do not appear. Each
    round hangs the neighbours of a node on the smallest of them, first the larger ones, then
    the smaller ones, until nothing changes; that takes few rounds even for long chains. A round is
    two shuffles. Only a count and a checksum reach the driver. The links of a node with very many
    are dealt to several parts, each with a least neighbour of its own; the node's link to that
    brings the parts together in the next step.
    """
    greater = F.greatest("u", "v").alias("u")
    now = scratch.keep(links.select(greater, F.least("u", "v").alias("v")).filter("u != v"))
    before = _fingerprint(now)
    while before[0]:
        tasks = -(-before[0] // LINKS)
        both = now.union(now.select("v", "u"))
        large = _by_node(both, tasks).mapInArrow(_hung(True), _LINK)
        after = scratch.keep(_by_node(large, tasks).mapInArrow(_hung(False), _LINK))
        seen = _fingerprint(after)
        scratch.drop(now)
        now = after
        if seen == before:
            break
        before = seen
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
