"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Documents with the same set of shingles form a class; one document stands for it. Signatures
are cut into bands, and classes that agree in a whole band share a bucket. Candidates are
compared one batch of hashes after the other, and a pair is dropped as soon as the posterior
probability that it reaches the threshold is below the chosen miss probability. What is left
is verified on the full shingle sets.

A bucket may hold very many classes, so its pairs are never listed. Two of its members serve as
hubs and all others are compared with these. Once the verified links are joined to components,
most buckets lie in one component and need nothing more. The others are put together to clusters,
and the members outside a cluster's largest component are compared with all members of other
components, in blocks of bounded size. So no link between two components is left out but by
banding and by pruning, at the probabilities below.

Banding 32 bands of 4 hashes misses a pair of similarity 0.75 with probability 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm import clusters, sketch, words as W
from basketry.llm.combos import set_key
from basketry.llm.components import components
from basketry.llm.scratch import Scratch, sorted_groups


@dataclass(frozen=True)
class NearSettings:
    """Hashes, bands, hashes compared at a time, threshold as a ratio, miss probability at
    each look, by the posterior; over all four looks a pair of 0.75 is missed with 4.6e-4."""

    hashes: int = 128
    bands: int = 32
    batch: int = 32
    numerator: int = 75
    denominator: int = 100
    miss: float = 1e-4
    block: int = 512


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest of n equal hashes that leave similarity >= threshold a chance of `miss`.

    With a flat prior, P(similarity >= t | m of n) is P(Binomial(n + 1, t) <= m).
    """
    chance = 0.0
    for m in range(n + 1):
        chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if chance >= miss:
            return m
    return n


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(97)
    return (
        random.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1),
        random.integers(0, 2**64, n, dtype=np.uint64),
    )


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(a.size, 2**32 - 1, np.uint64)
    for lo in range(0, values.size, 1024):
        part = values[lo : lo + 1024, None] * a
        part += b
        np.minimum(out, part.min(axis=0) >> np.uint64(32), out=out)
    return out.astype(np.uint32)


def _sketches(id_column: str, text: str, settings: NearSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers(settings.hashes)
        for batch in batches:
            ids, texts = batch.column(id_column), batch.column(text)
            for first, part in W.chunks(texts):
                values, start = W.shingles(W.split_words(part))
                size, keys, sigs = [], [], []
                for lo, hi in zip(start[:-1], start[1:]):
                    own = np.unique(values[lo:hi])
                    size.append(own.size)
                    keys.append(set_key(own))
                    sigs.append(signature(own, a, b).tobytes() if own.size else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(part)),
                        pa.array(size, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(sigs, pa.binary()),
                    ],
                    ["id", "n_shingles", "key", "sig"],
                )

    return run


def _bands(settings: NearSettings):
    rows = settings.hashes // settings.bands

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.random.default_rng(53).integers(0, 2**64, (settings.bands, rows + 1), dtype=np.uint64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                sig = _matrix(part.column("sig"), settings.hashes).astype(np.uint64)
                cut = sig.reshape(-1, settings.bands, rows)
                keys = W.mix((cut * (place[:, :rows] | np.uint64(1))).sum(axis=2, dtype=np.uint64) + place[:, rows])
                own = np.repeat(np.asarray(part.column("key")), settings.bands)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(own, pa.int64())], ["entry", "key"]
                )

    return run


def _matrix(column: pa.Array, hashes: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, hashes)


def _survivors(left: np.ndarray, right: np.ndarray, settings: NearSettings) -> tuple[np.ndarray, np.ndarray]:
    """Rows that pass every batch, and their number of equal hashes."""
    alive = np.arange(left.shape[0])
    matches = np.zeros(left.shape[0], np.int64)
    threshold = settings.numerator / settings.denominator
    for lo in range(0, settings.hashes, settings.batch):
        hi = min(lo + settings.batch, settings.hashes)
        matches = matches + (left[alive, lo:hi] == right[alive, lo:hi]).sum(axis=1)
        stay = matches >= least_matches(hi, threshold, settings.miss)
        alive, matches = alive[stay], matches[stay]
    return alive, matches


def _prune(settings: NearSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                left = _matrix(part.column("sig_a"), settings.hashes)
                right = _matrix(part.column("sig_b"), settings.hashes)
                rows, matches = _survivors(left, right, settings)
                kept = [part.column(c).take(pa.array(rows)) for c in ("a", "b", "small")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(matches, pa.int64())], ["a", "b", "small", "matches"]
                )

    return run


def _verify(settings: NearSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(W.shingle_sets(batch.column("text_a")), W.shingle_sets(batch.column("text_b"))):
                both = np.intersect1d(one, two, assume_unique=True).size
                union = one.size + two.size - both
                linked.append(settings.denominator * both >= settings.numerator * union)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(linked, pa.bool_())) for c in (batch.column("a"), batch.column("b"))], ["u", "v"]
            )

    return run


def _cross(settings: NearSettings):
    """Link the outsiders of each block with members of other components, on the full sets. One
    link from an outsider to a component is enough."""

    def block(keys: np.ndarray, comps: np.ndarray, outside: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        members = np.flatnonzero(~outside)
        flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
        size = np.array([s.size for s in sets])
        start = np.cumsum(size) - size
        mark = np.zeros(int(flat.max(initial=0)) + 1, bool)
        for r in np.flatnonzero(outside):
            others = members[comps[members] != comps[r]]
            rows, _ = _survivors(np.broadcast_to(sigs[r], (others.size, settings.hashes)), sigs[others], settings)
            others = others[rows]
            if not others.size:
                continue
            own = flat[start[r] : start[r] + size[r]]
            mark[own] = True
            hits = np.add.reduceat(mark[flat[W.spread(start[others], size[others])]].astype(np.int64), np.cumsum(size[others]) - size[others])
            mark[own] = False
            linked = others[settings.denominator * hits >= settings.numerator * (size[r] + size[others] - hits)]
            for k in np.unique(comps[linked], return_index=True)[1]:
                yield int(keys[r]), int(keys[linked[k]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["cluster", "i", "j"]):
            cell = np.stack([np.asarray(table.column(c)) for c in ("cluster", "i", "j")])
            cuts = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            keys, comps, outside = (np.asarray(table.column(c)) for c in ("key", "component", "outside"))
            links: list[tuple[int, int]] = []
            for lo, hi in zip([0, *cuts], [*cuts, keys.size]):
                own = slice(lo, hi)
                if not outside[own].any() or outside[own].all():
                    continue
                part = table.slice(lo, hi - lo)
                sets = list(W.shingle_sets(part.column("text")))
                links += block(keys[own], comps[own], outside[own], _matrix(part.column("sig"), settings.hashes), sets)
            columns = list(zip(*links)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v"])

    return run


def _own_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the set asked for, the first of each set in a task."""
    seen: set[int] = set()
    for batch in batches:
        keep = []
        for k, (own, key) in enumerate(zip(W.shingle_sets(batch.column("text")), batch.column("key").to_pylist())):
            if key not in seen and set_key(own) == key:
                seen.add(key)
                keep.append(k)
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in ("key", "text")], ["key", "text"])


PAIRS = "a long, b long, small boolean, matches long"


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: NearSettings = NearSettings()
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is
    at least 75/100, on the full sets. component_id is the smallest id that a document reaches.
    A null or empty text, or one of white space only, has no shingles and no links. A row
    without an id cannot be linked: it is kept, with no component. Rows that share an id are
    the same document, whatever their texts: what one of them links with the others do too.
    Repeated rows are all returned. Extra columns, whatever their names, are ignored.
    An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    measured = scratch.keep(docs.mapInArrow(_sketches("id", "text", settings), "id long, n_shingles long, key long, sig binary"))
    rows = scratch.keep(measured.select("id", "n_shingles", "key"))
    filled = measured.filter("n_shingles > 0 and id is not null")
    owners = scratch.keep(filled.groupBy("key").agg(F.min("id").alias("id")))
    sigs = scratch.keep(filled.select("key", "sig").dropDuplicates(["key"]))
    scratch.drop(measured)

    banded = sigs.mapInArrow(_bands(settings), "entry long, key long")
    shuffled = F.struct(F.xxhash64("key", "entry").alias("h"), F.col("key").alias("i"))
    hubs = (
        banded.groupBy("entry")
        .agg(F.min("key").alias("hub"), F.max("key").alias("top"), F.min(shuffled)["i"].alias("other"), F.count("key").alias("n"))
        .filter("hub < top")
        .select("entry", "hub", "other", "n")
    )
    buckets = scratch.keep(banded.join(hubs, "entry"))
    star = buckets.select(F.col("key").alias("a"), F.explode(F.array("hub", "other")).alias("b"), (F.col("n") <= 3).alias("small"))
    star = star.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "small")
    star = star.groupBy("a", "b").agg(F.max("small").alias("small"))
    pairs = scratch.keep(_with(star, sigs, "sig").mapInArrow(_prune(settings), PAIRS))

    # Texts of all that a comparison may ask for, read once.
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    needed = needed.union(buckets.filter("n > 3 or (n = 3 and hub = other)").select("key")).distinct()
    texts = sketch.rows_of(docs, scratch.keep(needed.join(owners, "key"))).select("key", "text")
    texts = scratch.keep(texts.mapInArrow(_own_texts, "key long, text string"))

    # The best partner of each document first: that joins nearly all that belongs together.
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("matches", -F.col("b"))).alias("b"))
    links = scratch.keep(_verified(best, texts, settings)).union(scratch.keep(_same_id(rows)))
    joined = scratch.keep(components(links, scratch))
    # Then what could still join two components: other hubs in buckets of two or three members,
    # and all members of larger ones.
    rest = _between(pairs.filter("small").join(best, ["a", "b"], "left_anti"), joined)
    other = scratch.keep(_verified(rest, texts, settings))
    across = scratch.keep(_cross_links(buckets, joined, sigs, texts, scratch, settings))
    found = scratch.keep(components(links.union(other).union(across), scratch))
    scratch.drop(buckets, pairs, texts, sigs, joined, owners)

    known = rows.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    linked = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    lowest = known.filter(linked).groupBy("component").agg(F.min("id").alias("component_id"))
    out = known.join(lowest, "component", "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _same_id(rows: DataFrame) -> DataFrame:
    """Links between the sets of rows that share an id; mostly none."""
    own = rows.filter("id is not null and n_shingles > 0")
    several = own.groupBy("id").agg(F.min("key").alias("u"), F.max("key").alias("hi")).filter("u < hi")
    return own.join(several.select("id", "u"), "id").select("u", F.col("key").alias("v")).filter("u != v").distinct()


def _with(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """Pairs with a column of both partners. b may be the hub of very many pairs and is joined
    last, straight before the rows are used up, so that Spark can split it."""
    one = side.select(F.col("key").alias("a"), F.col(column).alias(f"{column}_a"))
    two = side.select(F.col("key").alias("b"), F.col(column).alias(f"{column}_b"))
    return pairs.join(one, "a").join(two, "b")


def _verified(pairs: DataFrame, texts: DataFrame, settings: NearSettings) -> DataFrame:
    return _with(pairs.select("a", "b"), texts, "text").mapInArrow(_verify(settings), "u long, v long")


def _between(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose partners are not in one component yet."""
    one = joined.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    two = joined.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    both = pairs.join(one, "a", "left").join(two, "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _cross_links(
    buckets: DataFrame, joined: DataFrame, sigs: DataFrame, texts: DataFrame, scratch: Scratch, settings: NearSettings
) -> DataFrame:
    """Links between components in buckets of over three members.

    In a smaller bucket the hubs have been compared with everyone; only a bucket of three with
    one hub for two is left, and it is covered here too.
    """
    open_ones = buckets.filter("n > 3 or (n = 3 and hub = other)").select("entry", "key")
    known = open_ones.join(joined.withColumnRenamed("node", "key"), "key", "left")
    known = known.select("entry", "key", F.coalesce("component", "key").alias("component"))
    mixed = known.groupBy("entry").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    members = scratch.keep(known.join(mixed.filter("lo < hi").select("entry"), "entry"))
    met = clusters.cells(scratch.keep(clusters.grouped(members, scratch, settings.block)), scratch, settings.block)
    blocks = met.join(sigs, "key").join(texts, "key").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return blocks.mapInArrow(_cross(settings), "u long, v long")
