"""The join of similar documents against a comparison of all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import combos, sketch, words as W
from basketry.llm.combos import JoinSettings
from basketry.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, entry string, key string, n string, component int"
DATA = "/root/testdata/sf0.001"


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=4, limit=85):
    sets = [(i, shingles(t, size)) for i, t, *_ in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= limit * len(a | b):
                u, v = sorted((find(i), find(j)))
                root[v] = u
    return sorted(((i, len(s), None if i is None else find(i) if s else i) for i, s in sets), key=str)


def found(spark, rows, settings=JoinSettings(), parts=5):
    frame = spark.createDataFrame([(i, t, "a", "b", "c", 1) for i, t, *_ in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, combos.similarity_components(frame, settings=settings).collect()), key=str)


def corpus(seed):
    """Copies of all degrees, frequent lines, passages, short, empty and long texts."""
    rnd = random.Random(seed)
    new = lambda n: [f"w{rnd.randrange(4000)}" for _ in range(n)]
    texts = [None, "", " \t", "one", "ONE", "one two", "a b c d e", "a b c d e f", "a b c d e f g h i", "a b c d e f g h i j", "a b c d e f g h i j k l", "a b c d e f g h i j k l m"]
    for size in (12, 30, 90, 200):
        for _ in range(3):
            base = new(size)
            for _ in range(14):
                copy = list(base)
                for _ in range(rnd.randrange(5)):
                    copy[rnd.randrange(size)] = f"x{rnd.randrange(9999)}"
                texts.append(" ".join(copy[: size - rnd.randrange(3)]))
            texts += [" ".join(base)] * 3
    lines = [new(12) for _ in range(10)]
    for _ in range(60):  # little but frequent lines
        texts.append(" ".join(sum(rnd.sample(lines, rnd.randrange(2, 7)), [])))
    long = new(4000)
    texts += [" ".join(long), " ".join(long[:3500]), " ".join(long[:2000]), "spam " * 500, "spam " * 400]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    return [(i, texts[k]) for i, k in enumerate(order)]


#: Shingles mostly alone; frequent ones in triples; few counters; blocks from the start.
SETTINGS = [
    JoinSettings(), JoinSettings(alone=1, paired=3), JoinSettings(counters=8, alone=1, paired=20),
    JoinSettings(rounds=0, alone=2, block=7),
]


@pytest.mark.parametrize("settings", SETTINGS)
def test_components_are_those_of_all_pairs(spark, settings):
    rows = corpus(1)
    assert found(spark, rows, settings) == brute(rows)


def test_other_thresholds(spark):
    rows = corpus(2)
    settings = JoinSettings(shingle=3, numerator=60, denominator=100, alone=2)
    assert found(spark, rows, settings) == brute(rows, 3, 60)


@pytest.mark.parametrize("last", [(254, 254), (0, 254), (0, 0), (3, 6)])
def test_partners_share_an_entry(last):
    rnd = np.random.default_rng(4)
    settings = JoinSettings()
    for n in [*range(1, 40), 77, 150, 901]:
        for _ in range(12):
            own = np.unique(rnd.integers(0, 2**64, n, np.uint64))
            step = lambda s: ((W.mix(s) >> np.uint64(7)) % np.uint64(9)).astype(np.uint8)
            lost, added = rnd.integers(0, settings.lacking(n) + 1, 2)
            other = np.unique(np.concatenate([rnd.permutation(own)[lost:], rnd.integers(0, 2**64, added, np.uint64)]))
            both = np.intersect1d(own, other).size
            if np.array_equal(own, other) or 100 * both < 85 * (own.size + other.size - both):
                continue
            one, two = (combos.signatures(s, step(s), last, settings) for s in (own, other))
            assert np.intersect1d(one, two).size


def test_sketches_bound_the_difference():
    """No fewer places than they differ in, at all sizes; sets with little in common are told apart."""
    rnd = np.random.default_rng(9)
    for n, m in [(1, 1), (1, 3), (40, 47), (64, 65), (200, 230), (700, 1400), (40_000, 33_000)]:
        for both in {0, min(n, m) // 2, min(n, m)}:
            tokens = rnd.permutation(np.unique(rnd.integers(0, 2**64, n + m + 9, np.uint64)))
            one, two = tokens[:n], tokens[n - both : n - both + m]
            a, b = (combos.odd_sketch(np.sort(x))[None] for x in (one, two))
            width = min(a.shape[1], b.shape[1])
            apart = int(np.bitwise_count(combos.folded(a, width) ^ combos.folded(b, width)).sum())
            differ = np.setxor1d(one, two).size
            assert apart <= differ
            if both == 0 and n > 30:
                assert 100 * (n + m - apart) < 85 * (n + m + apart)


def test_a_set_is_measured_once_however_many_buckets_it_is_in(spark, monkeypatch):
    """Sets of frequent lines share many buckets that have little in common with each other."""
    asked = spark.sparkContext.accumulator(0)
    measure = combos._sketches

    def counted(settings):
        def run(batches):
            for batch in batches:
                asked.add(batch.num_rows)
                yield from measure(settings)([batch])

        return run

    monkeypatch.setattr(combos, "_sketches", counted)
    rows = corpus(3)
    settings = JoinSettings(rounds=0, alone=2, block=3)
    assert found(spark, rows, settings) == brute(rows)
    assert 0 < asked.value <= len({t for _, t in rows})


def test_rows_that_share_an_id(spark):
    rnd = random.Random(6)
    a, b = ([f"{c}{rnd.randrange(5000)}" for _ in range(60)] for c in "ab")
    near = lambda w: " ".join([*w[:-1], "zz"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, near(b)), (3, None), (None, near(a)), (None, None)]
    got = found(spark, rows)
    assert [r for r in got if r[1] and r[0] is not None] == [(i, 57, 1) for i in (1, 1, 2, 3, 4)]
    assert [r for r in got if not r[1]] == [(3, 0, 3), (None, 0, None)] and (None, 57, None) in got
    assert found(spark, rows * 2) == sorted(got * 2, key=str)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, None), (6, "")]) == [(5, 0, 5), (6, 0, 6)]


def test_components_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_texts_are_shipped_for_likely_pairs_only(spark, monkeypatch):
    """Sets that share a rare shingle and nothing else are told apart by their sketches."""
    asked = spark.sparkContext.accumulator(0)
    ship = combos._texts

    def counted(settings):
        def run(batches):
            for batch in ship(settings)(batches):
                asked.add(batch.num_rows)
                yield batch

        return run

    monkeypatch.setattr(combos, "_texts", counted)
    rnd = random.Random(4)
    new = lambda i, n: [f"{i}x{rnd.randrange(9000)}" for _ in range(n)]
    rows = [(i, " ".join(new(i, 60) + [f"p{i // 2}", "q", "r", "s"])) for i in range(40)]
    rows += [(100, rows[7][1] + " t"), (101, rows[7][1] + " u")]
    assert found(spark, rows) == brute(rows)
    assert asked.value == 3


def test_a_group_of_copies_makes_few_edges():
    from basketry.llm import clusters

    rnd = np.random.default_rng(2)
    parts = [np.sort(rnd.choice(500, 60, replace=False)) for _ in range(400)]
    entry = np.repeat(np.arange(400), 60)
    batch = clusters.pa.RecordBatch.from_arrays([clusters.pa.array(entry), clusters.pa.array(np.concatenate(parts))], ["entry", "key"])
    made = list(clusters._edges(batch.slice(lo, 1000) for lo in range(0, 24_000, 1000)))
    assert sum(b.num_rows for b in made) == 499


def test_counters_come_to_the_driver_as_bytes_in_parts(spark, monkeypatch):
    """A small table was put into one part, four bytes a counter, by Spark."""
    size = 8 * sketch.BLOCK
    counts = np.random.default_rng(4).integers(0, 256, (2, size)).astype(np.uint8)
    rows = [(b, bytes(c)) for one in counts for b, c in sketch.block_rows(one)]
    frame = type(spark.range(0))
    parts, local = [], frame.toLocalIterator

    def noted(self, *args, **kwargs):
        parts.append([sum(len(r.counts) for r in part) for part in self.rdd.glom().collect()])
        return local(self, *args, **kwargs)

    monkeypatch.setattr(frame, "toLocalIterator", noted)
    table, total = sketch.totals(spark.createDataFrame(rows, sketch.KIND), size, combos.frequency_steps)
    both = counts.astype(np.int64).sum(axis=0)
    assert total == both.sum() and bytes(table) == combos.frequency_steps(both).tobytes()
    assert sum(parts[0]) == size and len(parts[0]) == sketch.PARTS


def test_sets_of_unlike_sizes_do_not_meet_and_equal_buckets_are_one(spark, monkeypatch):
    """Near copies share most of their entries, a short and a long text one by chance."""
    members = []
    keep = Scratch.keep

    def noted(self, df):
        out = keep(self, df)
        if {"entry", "component"} <= set(out.columns):
            members.append([(r.entry, r.n) for r in out.collect()])
        return out

    monkeypatch.setattr(Scratch, "keep", noted)
    rnd = random.Random(8)
    new = lambda n: [f"w{rnd.randrange(90000)}" for _ in range(n)]
    line, base = new(4), new(300)
    rows = [(1, " ".join(base)), (2, " ".join(base[:299] + new(1))), (3, " ".join(line + new(2))), (4, " ".join(line + new(60)))]
    assert found(spark, rows) == brute(rows) == [(1, 297, 1), (2, 297, 1), (3, 3, 3), (4, 61, 4)]
    assert len(members[0]) == 2 and {n for _, n in members[0]} == {297}


def test_a_bucket_is_cut_only_where_no_pair_fits():
    """Sizes that grow by steps stay together; the members of a bucket may lie in several batches."""
    settings, sizes = JoinSettings(), [100, 117, 130, 152, 180, 181, 181]
    rows = [(5, k, n) for k, n in enumerate(sizes)] + [(6, 0, 100), (6, 1, 117), (7, 4, 180), (7, 5, 181), (7, 6, 181), (8, 4, 180), (8, 5, 181), (8, 6, 181)]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32()))], ["entry", "key", "n"])
    for size in (3, 100):
        got = {}
        for batch in combos._several(settings)(table.to_batches(max_chunksize=size)):
            for r in batch.to_pylist():
                got.setdefault(r["entry"], set()).add((r["key"], r["n"]))
        assert sorted(map(sorted, got.values())) == [
            [(0, 100), (1, 117)], [(0, 100), (1, 117), (2, 130), (3, 152)], [(4, 180), (5, 181), (6, 181)],
        ]
