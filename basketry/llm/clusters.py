"""Groups of members that are compared block by block.

Copies of a text share not one bucket but nearly all of theirs, so comparing bucket by bucket would
compare the same members over and over. Buckets that share members are put together to clusters,
and each member is in a cluster once. Should buckets that have little in common hang together to
a cluster that costs more than its buckets do, these are taken one by one instead. Either way all
members of a bucket meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.components import components
from basketry.llm.scratch import Scratch


#: Members that a task looks at or so, and nodes that it remembers.
MEMBERS, NODES = 100_000, 1 << 18


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the members of each bucket, of a partition sorted by bucket. Members that the
    task has joined before, by whatever buckets, are not linked again, so that a group of copies
    makes about as many links as it has members and not as its buckets have."""
    last: tuple[int, int] | None = None
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    for batch in batches:
        entry, key = (np.asarray(batch.column(c)) for c in ("entry", "key"))
        if not entry.size:
            continue
        new = np.concatenate([[last is None or entry[0] != last[0]], entry[1:] != entry[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(entry.size), -1))
        hub = np.where(start >= 0, key[start], last[1] if last else 0)
        last = (int(entry[-1]), int(hub[-1]))
        fresh = []
        for u, v in np.unique(np.stack([key, hub]), axis=1).T.tolist():
            one, two = root(u), root(v)
            if one != two:
                above[max(one, two)] = min(one, two)
                fresh.append((u, v))
        if len(above) > NODES:
            above.clear()
        columns = list(zip(*fresh)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v"])


def grouped(members: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """Columns cluster, key, component: each key once per group, of `members` with the columns
    entry (the bucket), key and component."""
    hubs = scratch.keep(members.groupBy("entry").agg(F.min("key").alias("hub"), F.count("key").alias("n")))
    tasks = -(-(hubs.agg(F.sum("n")).first()[0] or 1) // MEMBERS)
    dealt = members.select("entry", "key").repartition("entry").coalesce(tasks)
    edges = dealt.sortWithinPartitions("entry", "key").mapInArrow(_edges, "u long, v long")
    named = scratch.keep(components(edges.distinct(), scratch).select(F.col("node").alias("key"), F.col("component").alias("cluster")))
    in_clusters = scratch.keep(members.select("key", "component").distinct().join(named, "key"))

    def cost(n):
        return n * F.ceil(n / F.lit(float(block)))

    whole = in_clusters.groupBy("cluster").agg(cost(F.count("key")).alias("whole"))
    apart = hubs.join(named.withColumnRenamed("key", "hub"), "hub").groupBy("cluster").agg(F.sum(cost(F.col("n"))).alias("apart"))
    loose = scratch.keep(whole.join(apart, "cluster").filter("whole > apart").select("cluster"))
    out = in_clusters.join(loose, "cluster", "left_anti").select("cluster", "key", "component")
    if loose.isEmpty():
        return out
    buckets = members.select("entry", "key", "component").join(named, "key").join(loose, "cluster")
    return out.union(buckets.select(F.col("entry").alias("cluster"), "key", "component").distinct())


def cells(own: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """Columns cluster, i, j, key, component, outside: the blocks in which the members outside the
    largest component of a group meet all others of it. A block holds about `block` of each, so a
    group of n members with m outside the largest component makes n * m / block rows or so. `own`
    is a stored result of `grouped`."""
    sizes = own.groupBy("cluster", "component").agg(F.count("key").alias("n"))
    largest = sizes.groupBy("cluster").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most")
    )
    # Stored, so that the join is of two plain tables and Spark can split a large group.
    largest = scratch.keep(largest.filter("most < all"))
    mixed = own.join(largest, "cluster").withColumn("outside", F.col("component") != F.col("main"))
    size = F.lit(float(block))
    rows, columns = F.ceil(F.col("all") / size).cast("int"), F.ceil((F.col("all") - F.col("most")) / size).cast("int")
    place = F.xxhash64("key")
    every = mixed.select(
        "cluster", "key", "component", F.lit(False).alias("outside"), F.pmod(place, rows).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), columns - 1)).alias("j"),
    )
    outer = mixed.filter("outside").select(
        "cluster", "key", "component", "outside", F.explode(F.sequence(F.lit(0), rows - 1)).alias("i"),
        F.pmod(place, columns).cast("int").alias("j"),
    )
    return scratch.keep(every.union(outer.select(every.columns)))
