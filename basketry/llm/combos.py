"""Join of documents by the Jaccard similarity of their shingles, with token-combination prefixes.

The shingles of a set are put in one order for all sets, rare ones first. Of a set of n shingles a
partner may lack d = n - ceil(t * n) at most, so two partners share one of the first d + 1. Shingles
that few documents hold are indexed alone. Shingles that many hold would make large buckets; they
are indexed in combinations of k, two or three by how frequent they are, and the prefix is
extended instead: of s shingles of one group, a partner that lacks e of them shares a combination
unless s - e < k, so each group adds s - k + 1 to what the prefix must reach, d + 1. Groups are cut
by hash, about as many as the size of a set asks for, so that a set has few combinations for each
shingle of its prefix. Partners are of similar size, so a set is indexed with the groups of all
sizes that a partner may have; these are two at most.

How frequent a shingle is comes from a table of counters of fixed size. Two shingles in one
counter look more frequent than they are, which changes the order and the size of the index but
never the result.

A bucket is cut where the sizes of its sets leave a gap that no pair of partners spans, so most sets
that share a shingle by chance, of which there are more than in proportion in a large table, are in
no bucket; and buckets of the same sets are one. A bucket may hold very many sets, so its pairs are
never listed. Rounds compare all members of a
bucket with one of them, the hub, as long as they are not in its component yet; a hub then leaves
the bucket, and so do buckets of one component. Few buckets are left after that. They are put
together to clusters, and their members meet in blocks of bounded size, those outside the largest
component all of other components. A block holds of each set how many shingles it has, and a sketch
of a bit or so for each, which bounds the similarity of a pair. The pairs that are possible, with a
hub or in a block, are verified on the full sets, so no link between two components is lost. Only
for these are texts shipped: most sets that share a bucket by chance are told apart by the sketches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm import clusters, sketch, words as W
from basketry.llm.components import components
from basketry.llm.scratch import Scratch, sorted_groups


@dataclass(frozen=True)
class JoinSettings:
    """Words of a shingle, threshold as a ratio, counters as a power of two, documents up to which
    a shingle is indexed alone and in pairs (above the mean of a counter), rounds of hubs, and
    members in a block."""

    shingle: int = 4
    numerator: int = 85
    denominator: int = 100
    counters: int = 24
    alone: int = 32
    paired: int = 2048
    rounds: int = 1
    block: int = 512

    def lacking(self, n: int) -> int:
        """How many of n shingles a partner may lack."""
        return n + (-self.numerator * n // self.denominator)


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for _, part in W.chunks(texts):
        values, start = W.shingles(W.split_words(part), size)
        for lo, hi in zip(start[:-1], start[1:]):
            yield np.unique(values[lo:hi])


def set_key(own: np.ndarray) -> int:
    """A number for a set; sets of one number count as equal."""
    if not own.size:
        return 0
    both = np.array([W.mix(own).sum(dtype=np.uint64), np.bitwise_xor.reduce(own)], np.uint64) * W._PLACE[:2]
    return int(W.mix(both.sum(keepdims=True) + np.uint64(own.size)).view(np.int64)[0])


def _measured(settings: JoinSettings):
    """Each row's set as a number and its size, and the counters of the task: one pass for both.
    Sets that the task has had count once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << settings.counters, np.uint8)
        seen: set[int] = set()
        shift = np.uint64(64 - settings.counters)
        for batch in batches:
            keys, sizes, fresh = [], [], []

            def count() -> None:
                place, times = np.unique(np.concatenate(fresh) >> shift, return_counts=True)
                counts[place] = np.minimum(counts[place] + times, 255)
                fresh.clear()

            held = 0
            for own in _sets(batch.column("text"), settings.shingle):
                key = set_key(own)
                keys.append(key)
                sizes.append(own.size)
                if own.size and key not in seen:
                    seen.add(key)
                    fresh.append(own)
                    held += own.size
                    if held > 1 << 18:
                        count()
                        held = 0
            if fresh:
                count()
            none = pa.nulls(len(keys))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), none.cast(pa.int64()), none.cast(pa.binary())],
                ["id", "n", "key", "block", "counts"],
            )
        for block, packed in sketch.block_rows(counts):
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array([block], pa.int64()), pa.array([packed], pa.binary())], ["id", "n", "key", "block", "counts"])

    return run


def frequency_steps(counts: np.ndarray) -> np.ndarray:
    """How frequent the shingles of each counter look, in sixths of a doubling."""
    out = np.empty(counts.size, np.uint8)
    for lo in range(0, counts.size, 1 << 20):
        out[lo : lo + (1 << 20)] = np.minimum(np.round(np.log2(1 + counts[lo : lo + (1 << 20)]) * 6), 254)
    return out


def limits(mean: float, settings: JoinSettings) -> tuple[int, int]:
    """The last step of shingles indexed alone and of those indexed in pairs, by the mean of a counter."""
    return tuple(int(frequency_steps(np.array([3 * mean + x]))[0]) for x in (settings.alone, settings.paired))


@lru_cache(256)
def _choices(n: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def _levels(n: int, settings: JoinSettings) -> range:
    """Powers of two below the sizes that partners of n shingles have."""
    least = -(-settings.numerator * n // settings.denominator)
    most = settings.denominator * n // settings.numerator
    return range(least.bit_length() - 1, most.bit_length())


def signatures(own: np.ndarray, step: np.ndarray, last: tuple[int, int], settings: JoinSettings) -> np.ndarray:
    """The index entries of a set of distinct shingles, whose steps of frequency are given."""
    if settings.denominator * own.size // settings.numerator == own.size:
        return np.zeros(0, np.uint64)  # every partner is the same set
    need = settings.lacking(own.size) + 1
    ranked = np.sort(step.astype(np.uint64) << np.uint64(56) | own >> np.uint64(8))
    rare = int(np.searchsorted(ranked, np.uint64(last[0] + 1) << np.uint64(56)))
    if rare >= need:
        return ranked[:need]
    out = [ranked[:rare]]
    rest = ranked[rare:]
    width = np.where(rest >> np.uint64(56) <= last[1], 2, 3)
    spread = W.mix(rest)
    for level in _levels(own.size, settings):
        groups = max((1 << level) >> 3, 1)
        group = (spread >> np.uint64(32)).astype(np.int64) % groups
        order = np.lexsort((rest, group, width))
        place = width[order] * groups + group[order]
        start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        left = need - rare
        for lo, hi in zip(start, [*start[1:], place.size]):
            k = int(width[order[lo]])
            gain = min(hi - lo - k + 1, left)
            if gain <= 0:
                continue
            tokens = spread[order[lo : lo + gain + k - 1]]
            mixed = (tokens[_choices(tokens.size, k)] * W._PLACE[:k]).sum(axis=1, dtype=np.uint64)
            out.append(W.mix(mixed + np.uint64(level + 1)))
            left -= gain
            if left == 0:
                break
    return np.concatenate(out)


def _index(steps, last: tuple[int, int], settings: JoinSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.frombuffer(steps.value, np.uint8)
        shift = np.uint64(64 - settings.counters)
        seen: set[int] = set()
        for batch in batches:
            entries, keys, sizes, held = [], [], [], 0
            for own in _sets(batch.column("text"), settings.shingle):
                key = set_key(own)
                if not own.size or key in seen:
                    continue
                seen.add(key)
                entry = signatures(own, step[(own >> shift).astype(np.int64)], last, settings)
                entries.append(entry)
                keys.append(np.full(entry.size, key, np.int64))
                sizes.append(np.full(entry.size, own.size, np.int32))
                held += entry.size
                if held > 1 << 18:
                    yield _entries(entries, keys, sizes)
                    entries, keys, sizes, held = [], [], [], 0
            if entries:
                yield _entries(entries, keys, sizes)

    return run


def _entries(entries: list[np.ndarray], keys: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(entries).view(np.int64)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(sizes))],
        ["entry", "key", "n"],
    )


def _texts(settings: JoinSettings):
    """Rows with the number of their text's set, the first of each id and set in a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keep, keys = [], []
            for k, (own, i) in enumerate(zip(_sets(batch.column("text"), settings.shingle), batch.column("id").to_pylist())):
                key = set_key(own)
                if (i, key) not in seen:
                    seen.add((i, key))
                    keep.append(k)
                    keys.append(key)
            rows = pa.array(keep, pa.int64())
            columns = [batch.column("id").take(rows), pa.array(keys, pa.int64()), batch.column("text").take(rows)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "text"])

    return run


def _verify(settings: JoinSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(*(_sets(batch.column(c), settings.shingle) for c in ("text_a", "text_b"))):
                both = np.intersect1d(one, two, assume_unique=True).size
                linked.append(settings.denominator * both >= settings.numerator * (one.size + two.size - both))
            chosen = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(chosen) for c in ("a", "b")], ["u", "v"])

    return run


_LEVELS = (6, 14)  # bits of a sketch as powers of two, from the least to the most


def odd_sketch(own: np.ndarray) -> np.ndarray:
    """Of each place, among about as many as the set has shingles, whether an odd number of them
    fall on it. Each shingle that only one of two sets has turns one place over, so the two sets
    differ in as many shingles at least as their sketches do in places."""
    level = min(max(int(own.size - 1).bit_length(), _LEVELS[0]), _LEVELS[1])
    place = (own & np.uint64((1 << level) - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=1 << level).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, one per row, as those of fewer places: `width` numbers of 64 places each."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _sketches(settings: JoinSettings):
    """Each row's set as a number, its size and its sketch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, packed = [], [], []
            for own in _sets(batch.column("text"), settings.shingle):
                keys.append(set_key(own))
                sizes.append(own.size)
                packed.append(odd_sketch(own).tobytes())
            columns = [batch.column("id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "n", "sketch"])

    return run


def _may_link(total: np.ndarray, apart: np.ndarray, settings: JoinSettings) -> np.ndarray:
    """Whether two sets of so many shingles together may link if so many or more are in one only."""
    return settings.denominator * (total - apart) >= settings.numerator * (total + apart)


def _plausible(settings: JoinSettings):
    """The given pairs that may be partners by their sizes and sketches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(batch.column(c).to_pylist(), object) for c in ("sketch_a", "sketch_b")]
            wide = [np.array([len(p) // 8 for p in side], np.int64) for side in packed]
            total = np.asarray(batch.column("n_a")) + np.asarray(batch.column("n_b"))
            keep = np.zeros(batch.num_rows, bool)
            for widths in set(zip(*(w.tolist() for w in wide))):
                rows = np.flatnonzero((wide[0] == widths[0]) & (wide[1] == widths[1]))
                one, two = (
                    folded(np.frombuffer(b"".join(side[rows]), np.uint64).reshape(rows.size, w), min(widths))
                    for side, w in zip(packed, widths)
                )
                apart = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
                keep[rows] = _may_link(total[rows], apart, settings)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return run


def _possible(settings: JoinSettings):
    """Pairs of each block that may be partners by their sizes and sketches."""

    def block(keys: np.ndarray, comps: np.ndarray, outside: np.ndarray, n: np.ndarray, packed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        wide = np.array([len(p) // 8 for p in packed])
        row, tables = np.zeros(wide.size, np.int64), {}
        for w in np.unique(wide).tolist():
            own = np.flatnonzero(wide == w)
            row[own] = np.arange(own.size)
            tables[w, w] = np.frombuffer(b"".join(packed[own]), np.uint64).reshape(own.size, w)
            for less in np.unique(wide[wide < w]).tolist():
                tables[w, less] = folded(tables[w, w], less)
        members = np.flatnonzero(~outside)
        for r in np.flatnonzero(outside):
            fits = _may_link(n[r] + n[members], np.abs(n[r] - n[members]), settings)
            some = members[fits & (comps[members] != comps[r])]
            for w in np.unique(wide[some]).tolist():
                others, least = some[wide[some] == w], min(w, int(wide[r]))
                differ = tables[w, least][row[others]] ^ tables[int(wide[r]), least][row[r]]
                apart = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
                found = keys[others[_may_link(n[r] + n[others], apart, settings)]]
                yield np.maximum(keys[r], found), np.minimum(keys[r], found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["cluster", "i", "j"]):
            cell = np.stack([np.asarray(table.column(c)) for c in ("cluster", "i", "j")])
            cuts = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            columns = [np.asarray(table.column(c)) for c in ("key", "component", "outside", "n")]
            columns.append(np.array(table.column("sketch").to_pylist(), object))
            for lo, hi in zip([0, *cuts], [*cuts, table.num_rows]):
                found = list(block(*(c[lo:hi] for c in columns)))
                if found:
                    pairs = [pa.array(np.concatenate(c)) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    return run


def _several(settings: JoinSettings):
    """The entries that several sets have, each with each set once, of a partition sorted by entry,
    size and key.

    The sets of an entry are cut where the next larger one is too large for a partner of all before
    it, so that no pair is cut. Copies of a text share nearly all of their entries: each part is
    named by its sets, so that entries of the same sets become one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["entry"]):
            entry, key, n = (np.asarray(table.column(c)) for c in ("entry", "key", "n"))
            fresh = np.ones(entry.size, bool)
            fresh[1:] = (entry[1:] != entry[:-1]) | (key[1:] != key[:-1])
            entry, key, n = entry[fresh], key[fresh], n[fresh]
            opens = np.ones(entry.size, bool)
            opens[1:] = (entry[1:] != entry[:-1]) | (settings.denominator * n[:-1].astype(np.int64) < settings.numerator * n[1:].astype(np.int64))
            start = np.flatnonzero(opens)
            count = np.diff(np.append(start, entry.size))
            named = W.mix(np.add.reduceat(W.mix(key.view(np.uint64)), start) + count.astype(np.uint64)).view(np.int64)
            keep = np.repeat(count > 1, count)
            if keep.any():
                columns = [np.repeat(named, count)[keep], key[keep], n[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["entry", "key", "n"])

    return run


def _shared(entries: DataFrame, settings: JoinSettings) -> DataFrame:
    """The members of buckets that hold several sets, from one shuffle of the index; a bucket stands
    for all entries that the same sets have."""
    ordered = entries.repartition("entry").sortWithinPartitions("entry", "n", "key")
    several = ordered.mapInArrow(_several(settings), entries.schema)
    return several.dropDuplicates(["entry", "key"]).withColumn("component", F.col("key"))


def _with_component(members: DataFrame, joined: DataFrame) -> DataFrame:
    known = members.drop("component").join(joined.withColumnRenamed("node", "key"), "key", "left")
    return known.withColumn("component", F.coalesce("component", "key"))


def _still_mixed(members: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    mixed = members.groupBy("entry").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return members.join(mixed.filter("lo < hi").select("entry"), "entry")


def _size_fits(settings: JoinSettings, a: str, b: str):
    return settings.denominator * F.least(a, b) >= settings.numerator * F.greatest(a, b)


def _linked(pairs: DataFrame, owners: DataFrame, docs: DataFrame, scratch: Scratch, settings: JoinSettings) -> DataFrame:
    """The pairs that are partners on the full sets. Only the texts of these pairs are shipped; the
    one of a set is that of the row that `owners` names."""
    pairs = scratch.keep(pairs)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    needed = scratch.keep(ends.join(owners, "key"))
    texts = sketch.rows_of(docs, needed, then=_texts(settings), schema="id long, key long, text string")
    texts = scratch.keep(texts.dropDuplicates(["id", "key"]).select("key", "text"))  # read twice
    one = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    links = scratch.keep(pairs.join(one, "a").join(two, "b").mapInArrow(_verify(settings), "u long, v long"))
    scratch.drop(pairs, needed, texts)
    return links


def _hub_round(members: DataFrame, numbers: DataFrame, scratch: Scratch, settings: JoinSettings) -> tuple[DataFrame, DataFrame]:
    """Pairs of the hub of each bucket and its members of other components that may be partners by
    their sketches; and the members without the hubs. The hub is the member that shares its buckets
    with most others: of the copies of a text that is the one nearest to all, and the same one in
    all their buckets."""
    sizes = members.groupBy("entry").agg(F.count("key").alias("size"))
    central = members.join(sizes, "entry").groupBy("key").agg(F.sum("size").alias("shared"))
    known = members.join(central, "key")
    hubs = known.groupBy("entry").agg(F.max(F.struct("shared", "key", "n", "component")).alias("hub"))
    both = scratch.keep(members.join(hubs, "entry"))  # read twice
    apart = both.filter(F.col("component") != F.col("hub.component")).filter(_size_fits(settings, "n", "hub.n"))
    pairs = apart.select(F.greatest("key", "hub.key").alias("a"), F.least("key", "hub.key").alias("b")).distinct()
    one, two = (numbers.select(*(F.col(c).alias(f"{c}_{end}") for c in ("n", "sketch")), F.col("key").alias(end)) for end in "ab")
    likely = pairs.join(one, "a").join(two, "b").mapInArrow(_plausible(settings), "a long, b long")
    return likely, both.filter(F.col("key") != F.col("hub.key")).drop("hub")


def _block_pairs(members: DataFrame, numbers: DataFrame, scratch: Scratch, settings: JoinSettings) -> DataFrame:
    """Pairs of sets of different components in the buckets that are still mixed that may be
    partners by their sketches. A set has one sketch, however many clusters it is in."""
    own = scratch.keep(clusters.grouped(members, scratch, settings.block))
    met = clusters.cells(own, scratch, settings.block).join(numbers.select("key", "n", "sketch"), "key")
    blocks = met.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return blocks.mapInArrow(_possible(settings), "a long, b long").distinct()


def similarity_components(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: JoinSettings = JoinSettings()
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents are linked if the Jaccard similarity of their sets of four-word shingles is at
    least 85/100, on the full sets. component_id is the smallest id that a document reaches. A
    text of fewer words is one shingle as a whole. A null or empty text, or one of white space
    only, has no shingles and no links. A row without an id cannot be linked and has no component.
    Rows that share an id are the same document, whatever their texts: what one of them links with
    the others do too. Repeated rows are all returned. Extra columns, whatever their names, are
    ignored. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "combos")
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    measured = scratch.keep(docs.mapInArrow(_measured(settings), "id long, n long, key long, block long, counts binary"))
    rows = scratch.keep(measured.filter("n is not null").select("id", "n", "key"))
    size = 1 << settings.counters
    table, total = sketch.totals(measured.filter("n is null").select("block", "counts"), size, frequency_steps)
    scratch.drop(measured)
    last = limits(total / size, settings)
    steps = docs.sparkSession.sparkContext.broadcast(table)
    named = docs.filter("id is not null")
    entries = scratch.keep(named.mapInArrow(_index(steps, last, settings), "entry long, key long, n int"))
    steps.destroy()

    members = scratch.keep(_shared(entries, settings))
    scratch.drop(entries)
    owners = rows.filter("id is not null and n > 0").groupBy("key").agg(F.min("id").alias("id"))
    owners = scratch.keep(members.select("key").distinct().join(owners, "key"))
    numbers = sketch.rows_of(docs, owners, then=_sketches(settings), schema="id long, key long, n long, sketch binary")
    numbers = scratch.keep(numbers.dropDuplicates(["id", "key"]))

    links = scratch.keep(_same_id(rows))
    for _ in range(settings.rounds):
        pairs, left = _hub_round(members, numbers, scratch, settings)
        links = links.union(_linked(pairs, owners, docs, scratch, settings))
        joined = scratch.keep(components(links, scratch))
        before, members = members, scratch.keep(_still_mixed(_with_component(left, joined)))
        scratch.drop(before)
        if members.isEmpty():
            break
    else:
        pairs = _block_pairs(members, numbers, scratch, settings)
        links = links.union(_linked(pairs, owners, docs, scratch, settings))
        joined = scratch.keep(components(links, scratch))
    scratch.drop(members, numbers, owners)

    known = rows.filter("id is not null").join(joined.withColumnRenamed("node", "key"), "key", "left")
    known = known.withColumn("component", F.coalesce("component", "key"))
    lowest = known.filter("n > 0").groupBy("component").agg(F.min("id").alias("component_id"))
    out = known.join(lowest, "component", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    nameless = rows.filter("id is null").select("id", "n", F.lit(None).cast("long"))
    return out.union(nameless)


def _same_id(rows: DataFrame) -> DataFrame:
    """Links between the sets of rows that share an id; mostly none."""
    own = rows.filter("id is not null and n > 0")
    several = own.groupBy("id").agg(F.min("key").alias("u"), F.max("key").alias("hi")).filter("u < hi")
    return own.join(several.select("id", "u"), "id").select("u", F.col("key").alias("v")).filter("u != v").distinct()
