"""Benchmark decontamination: lookup of the rarest shingles of each item, exact verification.

A document is compared with an item at every place, over as many words as the item has, by the
weighted Jaccard similarity of the multisets of five-word shingles. A place that reaches the
threshold holds most shingles of the item, so of any of them that are one more than it may lack it
holds one. These are taken for each item, those first that fewest items have, and looked up in a
sorted table. Around each shingle that is found the similarity is worked out for all places at
once from running sums. So no place of the threshold or more is left out.

Documents are read once for each block of items, without a shuffle. Items are taken in blocks of
bounded size, so what is sent to the tasks does not grow with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm import words as W
from basketry.llm.scratch import Scratch
from basketry.llm.ship import ship


@dataclass(frozen=True)
class LeakSettings:
    """Threshold as a ratio, and bytes of items at a time."""

    numerator: int = 75
    denominator: int = 100
    block_bytes: int = 4 << 20


class Lookup:
    """Shingles of the items of one block that are cut into shingles of `size` words."""

    def __init__(self, values: list[np.ndarray], items: list[int], settings: LeakSettings) -> None:
        self.items, self.settings = items, settings
        self.total = [v.size for v in values]
        self.sets = [np.unique(v, return_counts=True) for v in values]
        value, count = (np.concatenate(c) for c in zip(*self.sets))
        owner = np.repeat(np.arange(len(items)), [v.size for v, _ in self.sets])
        _, same, common = np.unique(value, return_inverse=True, return_counts=True)
        order = np.lexsort((value, common[same], owner))
        value, count, owner = value[order], count[order], owner[order]
        total = np.array(self.total)
        lacking = total - -(-settings.numerator * total // settings.denominator)
        before = np.cumsum(count) - count
        before -= before[np.searchsorted(owner, owner)]
        chosen = before <= lacking[owner]
        value, owner = value[chosen], owner[chosen]
        order = np.argsort(value, kind="stable")
        self.owner = owner[order]
        self.keys, self.first, self.count = np.unique(value[order], return_index=True, return_counts=True)

    def find(self, values: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, first and last place of the chosen shingles of the item in the text."""
        slot = np.minimum(np.searchsorted(self.keys, values), self.keys.size - 1)
        at = np.flatnonzero(self.keys[slot] == values)
        count = self.count[slot[at]]
        item = self.owner[W.spread(self.first[slot[at]], count)]
        at = np.repeat(at, count)
        text = np.searchsorted(start, at, "right") - 1
        order = np.lexsort((at, item, text))
        text, item, at = text[order], item[order], at[order]
        edge = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        last = np.append(edge[1:], at.size)[: edge.size] - 1
        yield from zip(text[edge].tolist(), item[edge].tolist(), (at[edge] - start[text[edge]]).tolist(), (at[last] - start[text[edge]]).tolist())

    def best(self, values: np.ndarray, k: int, first: int, last: int) -> tuple[float, int] | None:
        """Similarity and place of the best place that holds one of the places `first` to `last`."""
        total, (own, limit) = self.total[k], self.sets[k]
        lo = max(first - total + 1, 0)
        near = values[lo : last + total]
        slot = np.minimum(np.searchsorted(own, near), own.size - 1)
        at = np.flatnonzero(own[slot] == near)
        if at.size * self.settings.denominator < total * self.settings.numerator:
            return None
        slot, at = slot[at], at + lo
        order = np.argsort(slot, kind="stable")
        slot, at = slot[order], at[order]
        # One of a shingle's occurrences counts unless as many as the item has come before it.
        earlier = np.arange(at.size) - limit[slot]
        full = earlier >= np.searchsorted(slot, slot)
        since = np.where(full, at[np.maximum(earlier, 0)] + 1, at - total + 1)
        since = np.maximum(since, at - total + 1)
        places = np.arange(lo - total + 1, last + 1)
        edges = np.zeros(places.size + total + 1, np.int64)
        np.add.at(edges, since - places[0], 1)
        np.add.at(edges, at + 1 - places[0], -1)
        both = np.cumsum(edges)[: places.size]
        present = np.minimum(places + total, values.size) - np.maximum(places, 0)
        union = present + total - both
        good = np.flatnonzero(both * self.settings.denominator >= self.settings.numerator * union)
        if not good.size:
            return None
        similarity = both[good] / union[good]
        ties = places[good[similarity == similarity.max()]]
        return float(similarity.max()), int(ties[ties <= 0].max() if (ties <= 0).any() else ties.min())


class Items:
    """Items of one block: a lookup for each size of shingles."""

    def __init__(self, ids: list[int], texts: list[str], settings: LeakSettings) -> None:
        self.ids = ids
        words = W.split_words(pa.array(texts, pa.string()))
        self.size = np.diff(words.start)
        values, cut = W.shingles(words)
        by_size: dict[int, list[int]] = {}
        for k in np.flatnonzero(self.size).tolist():
            by_size.setdefault(min(int(self.size[k]), W.SHINGLE), []).append(k)
        self.lookups = {
            size: Lookup([values[cut[k] : cut[k + 1]] for k in items], items, settings)
            for size, items in sorted(by_size.items())
        }

    def leaks(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, float]]:
        """Text, item, first word, number of words and similarity of the best place of each item."""
        words = W.split_words(texts)
        if not words.hash.size:
            return
        n = np.diff(words.start)
        found = []
        for size, lookup in self.lookups.items():
            values, start = W.shingles(words, size)
            for doc, k, first, last in lookup.find(values, start):
                best = lookup.best(values[start[doc] : start[doc + 1]], k, first, last)
                if best is not None:
                    item, (similarity, place) = lookup.items[k], best
                    lo = max(place, 0)
                    found.append((doc, item, lo, int(min(place + self.size[item], n[doc])) - lo, similarity))
        yield from sorted(found)


LEAKS = "doc_id long, item_id long, first_word long, n_words long, similarity double"


def _run(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for first, part in W.chunks(batch.column("text")):
                rows = [(ids[first + d], items.ids[i], lo, n, s) for d, i, lo, n, s in items.leaks(part)]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.float64())],
                    ["doc_id", "item_id", "first_word", "n_words", "similarity"],
                )

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
    settings: LeakSettings = LeakSettings(),
) -> DataFrame:
    """One row for each document and benchmark item that it holds a near copy of: doc_id, item_id,
    first_word, n_words and similarity of the most similar place, the first of equal ones.

    Null or empty texts and items have no leaks. A document without an id gives rows with a null
    doc_id; rows that repeat give their rows again, and so do repeated items. Extra columns are
    ignored. An item longer than a block is a block of its own, as it is held whole in the tasks.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text rlike '[^\\\\s]'")
    # Long items have a block each; they are few, as there is one row per item of such a size.
    size = F.octet_length("text")
    long = F.col("text").isNotNull() & (size * 2 > settings.block_bytes)
    total = items.filter(~long).agg(F.sum(size)).first()[0]
    blocks = max(-(-(total or 0) * 2 // settings.block_bytes), 1)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    own = [items.filter(~long & (place == b)) for b in range(blocks)]
    digests = items.filter(long).select(F.sha2(F.col("text").cast("binary"), 256).alias("d")).distinct().collect()
    own += [items.filter(long & (F.sha2(F.col("text").cast("binary"), 256) == r.d)) for r in digests]
    out = None
    for block in own:
        rows = block.orderBy("item_id", "text").collect()  # about block_bytes / 2 of items, or one text
        shared = docs.sparkSession.sparkContext.broadcast(Items([r[0] for r in rows], [r[1] for r in rows], settings))
        found = docs.mapInArrow(_run(shared), LEAKS)
        out = found if out is None else out.union(found)
    return out


def without_leaks(docs: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents that hold no item; a document without an id is kept."""
    bad = found.select(F.col("doc_id").alias(id_column)).distinct()
    return docs.join(bad, id_column, "left_anti").select(docs.columns)


def clean(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """The documents without those that hold an item; the leaks are found once."""
    scratch = Scratch(docs.sparkSession, "leaks")
    return without_leaks(docs, scratch.keep(leaks(docs, benchmark, settings=settings)))
