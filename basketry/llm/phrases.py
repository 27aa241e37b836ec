"""Collocations by stripes.

A stripe is a prefix of words with a counter of the words that follow it. Each task counts the
stripes of its texts, stripes of equal prefixes are brought together and added up word by word,
and words below the least count leave them. A prefix that very many words follow is cut into
segments by the following word, each a stripe of its own; the empty prefix, whose stripe is the
vocabulary, is cut the most. One table of stripes then tells all that is asked for: the count of
a phrase is the entry of its last word, its total as a prefix is the same entry one stripe up,
and what its longer phrases leave of it is the largest entry of its own stripe and of the
stripes that hold it behind one more word.

Longer phrases are counted in later passes, and only where all their parts of the length counted
last may be frequent. That is looked up in a bitmap of fixed size: a bit set by another phrase
costs a few more entries in the shuffle, never one less.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm import words as W
from basketry.llm.scratch import Scratch


@dataclass(frozen=True)
class PhraseSettings:
    """Words of the longest phrase, least count, percent of its count that a longer phrase must
    have to replace it, phrases returned per language, and bits of the bitmap as a power of two."""

    longest: int = 5
    least: int = 100
    replaced: int = 100
    top: int = 2000
    bits: int = 26


CHUNK_BYTES = 1 << 22
_BLOCK = 15  # bits of a block of the bitmap, as a power of two
_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True
_GAP |= _BREAK


class Pieces(NamedTuple):
    hash: np.ndarray  # of each word
    piece: np.ndarray  # the piece that each word lies in
    begin: np.ndarray  # first byte of each word
    end: np.ndarray
    raw: np.ndarray  # bytes of all texts, A to Z as a to z


def split(texts: pa.Array) -> Pieces:
    """Words of the texts, in pieces that end at punctuation, line ends and ends of texts."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    none = np.zeros(0, np.int64)
    if raw.size == 0:
        return Pieces(np.zeros(0, np.uint64), none, none, none, raw)
    raw = W._LOWER[raw]
    solid = ~_GAP[raw]
    edge = np.zeros(raw.size + 1, bool)
    edge[at - at[0]] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = W._power_tables(raw.size)
    sums = np.zeros(raw.size + 1, np.uint64)
    np.cumsum(W._BYTE[raw] * up[: raw.size], out=sums[1:])
    hashes = W.mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    # A text may begin at a byte that breaks, so both are counted.
    piece = np.cumsum(_BREAK[raw], dtype=np.int64)[begin] + np.cumsum(edge[:-1], dtype=np.int64)[begin]
    return Pieces(hashes, piece, begin, end, raw)


def _language_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _gram_hash(hashes: np.ndarray, size: int, seed: np.uint64) -> np.ndarray:
    """Of all runs of `size` words, whether in one piece or not."""
    n = max(hashes.size - size + 1, 0)
    out = np.full(n, seed, np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * W._PLACE[k]
    return W.mix(out)


def _strings(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - begin
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    data = raw[W.spread(begin, size)]
    return pa.StringArray.from_buffers(size.size, pa.py_buffer(offsets), pa.py_buffer(data))


def _segments(size: int) -> int:
    """Segments of a stripe whose phrases have so many words."""
    return 4096 if size == 1 else max(256 >> (2 * (size - 1)), 4)


STRIPES = "lang string, size int, prefix string, segment int, following string, counts array<long>"


def _stripe_rows(lang: str, size: int, prefix: pa.Array, segment: np.ndarray, following: pa.Array, counts: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Entries of stripes, ordered by stripe; each stripe begins at an entry of `start`."""
    cuts = np.append(start, counts.size)
    lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), following)
    n = start.size
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, size, np.int32)),
            prefix, pa.array(segment.astype(np.int32)),
            pc.binary_join(lists, " "),
            pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(counts.astype(np.int64))),
        ],
        ["lang", "size", "prefix", "segment", "following", "counts"],
    )


def _counted(lang: str, found: Pieces, sizes: list[int], known: int, bitmap: np.ndarray | None, bits: int) -> Iterator[pa.RecordBatch]:
    """Stripes of the phrases of the given sizes in a chunk of texts of one language."""
    n = found.hash.size
    first, ids = np.unique(found.hash, return_index=True, return_inverse=True)[1:]
    vocabulary = _strings(found.raw, found.begin[first], found.end[first])
    spread = (W.mix(found.hash[first] + np.uint64(1)) >> np.uint64(40)).astype(np.int64)
    seed = _language_hash(lang)
    if bitmap is not None:
        place = (_gram_hash(found.hash, known, seed) >> np.uint64(64 - bits)).astype(np.int64)
        likely = (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
    for size in sizes:
        at = np.arange(max(n - size + 1, 0))
        fits = found.piece[: at.size] == found.piece[size - 1 :][: at.size]
        if bitmap is not None:
            for k in range(size - known + 1):
                fits &= likely[k : k + at.size]
        at = at[fits]
        if not at.size:
            continue
        which, counts = _distinct(found, ids, at, size, seed)
        # By prefix and segment; the words of a prefix tell it, whatever its hash.
        last = ids[which + size - 1]
        segment = spread[last] % _segments(size)
        before = [ids[which + k] for k in range(size - 1)]
        order = np.lexsort((segment, *before[::-1]))
        which, counts, last, segment = which[order], counts[order], last[order], segment[order]
        new = np.ones(which.size, bool)
        new[1:] = segment[1:] != segment[:-1]
        for one in before:
            new[1:] |= one[order][1:] != one[order][:-1]
        start = np.flatnonzero(new)
        words = [vocabulary.take(pa.array(ids[which[start] + k])) for k in range(size - 1)]
        joined = pc.binary_join_element_wise(*words, " ") if words else pa.array([""]).take(pa.array(np.zeros(start.size, np.int64)))
        for lo in range(0, start.size, 50_000):
            hi = min(lo + 50_000, start.size)
            a, b = start[lo], start[hi] if hi < start.size else which.size
            yield _stripe_rows(
                lang, size, joined.slice(lo, hi - lo), segment[start[lo:hi]], vocabulary.take(pa.array(last[a:b])),
                counts[a:b], start[lo:hi] - a,
            )


def _distinct(found: Pieces, ids: np.ndarray, at: np.ndarray, size: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct phrase that begins at one of the places, and its count."""
    if size == 1:
        key = ids[at]
    else:
        key = _gram_hash(found.hash, size, seed)[at]
    _, first, back, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    which = at[first]
    if size > 1 and any((ids[which + k][back] != ids[at + k]).any() for k in range(size)):
        # Two phrases with one hash: rank them word by word, which is exact.
        key = ids[at]
        for k in range(1, size):
            key = np.unique(key, return_inverse=True)[1] * (int(ids.max()) + 1) + ids[at + k]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        which = at[first]
    return which, counts


def _count(sizes: list[int], known: int, bitmap, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        total: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang))
                for _, part in W.chunks(texts, CHUNK_BYTES):
                    found = split(part)
                    total[lang] = total.get(lang, 0) + found.hash.size
                    if found.hash.size:
                        yield from _counted(lang, found, sizes, known, marks, bits)
        if marks is None:
            # The phrase of no words: its count is that of all words.
            for lang, n in total.items():
                if n:
                    none = pa.array([""])
                    yield _stripe_rows(lang, 0, none, np.zeros(1), none, np.array([n]), np.zeros(1, np.int64))

    return run


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes of one prefix and segment added up word by word; entries below `least` leave."""
    key = ["lang", "size", "prefix", "segment"]
    together = stripes.repartition(*key)
    entries = together.select(*key, F.inline(F.arrays_zip(F.split("following", " ").alias("following"), F.col("counts").alias("a"))))
    return (
        entries.groupBy(*key, "following").agg(F.sum("a").alias("a"))
        .filter((F.col("a") >= least) | (F.col("size") == 0)).drop("segment")
    )


def _marks(size: int, bits: int):
    """The bits of frequent phrases, by block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [np.zeros(0, np.int64)]
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                texts = batch.column("phrase").filter(pc.equal(batch.column("lang"), lang))
                hashes = _gram_hash(split(texts).hash, size, _language_hash(lang))[::size]
                places.append((hashes >> np.uint64(64 - bits)).astype(np.int64))
        place = np.unique(np.concatenate(places))
        block = place >> _BLOCK
        for lo, hi in zip(*_groups(block)):
            one = np.zeros(1 << _BLOCK, np.uint8)
            one[place[lo:hi] & ((1 << _BLOCK) - 1)] = 1
            packed = np.packbits(one, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block[lo]]), pa.array([packed], pa.binary())], ["block", "marks"])

    return run


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: values.size])
    return start, np.append(start[1:], values.size) if values.size else start


def _united(table: pa.Table) -> pa.Table:
    out = np.zeros(1 << (_BLOCK - 3), np.uint8)
    for marks in table.column("marks"):
        out |= np.frombuffer(marks.as_py(), np.uint8)
    return pa.table({"block": [table.column("block")[0].as_py()], "marks": pa.array([out.tobytes()], pa.binary())})


def _bitmap(frequent: DataFrame, size: int, bits: int):
    """A broadcast bitmap of 2 ** bits bits of the frequent phrases of one size."""
    own = frequent.filter(F.col("size") == size).select("lang", _phrase().alias("phrase"))
    kind = "block long, marks binary"
    blocks = own.mapInArrow(_marks(size, bits), kind).groupBy("block").applyInArrow(_united, kind)
    out = np.zeros(1 << max(bits - 3, 0), np.uint8)
    for row in blocks.toLocalIterator():
        part = np.frombuffer(row.marks, np.uint8)
        lo = row.block << (_BLOCK - 3)
        out[lo : lo + part.size] = part[: out.size - lo]
    return frequent.sparkSession.sparkContext.broadcast(out.tobytes())


def _phrase() -> Column:
    return F.when(F.col("size") == 1, F.col("following")).otherwise(F.concat_ws(" ", "prefix", "following"))


def frequent_phrases(
    docs: DataFrame, text: str, lang: str, scratch: Scratch, settings: PhraseSettings = PhraseSettings()
) -> DataFrame:
    """Entries of all stripes that reach the least count, with size 0 for all words: lang, size,
    prefix, following, a."""
    own = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")
    ).filter("text is not null")
    passes = [[1, 2], *[list(range(s, min(s + (2 if s > 3 else 1), settings.longest + 1))) for s in (3, *range(4, settings.longest + 1, 2)) if s <= settings.longest]]
    bitmap, known, out = None, 0, None
    for sizes in passes:
        stripes = own.mapInArrow(_count(sizes, known, bitmap, settings.bits), STRIPES)
        entries = scratch.keep(_merged(stripes, settings.least))
        out = entries if out is None else out.union(entries)
        known = sizes[-1]
        if sizes != passes[-1]:
            bitmap = _bitmap(entries, known, settings.bits)
    return out


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", settings: PhraseSettings = PhraseSettings()
) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score, cut.

    Texts are lower-cased from A to Z and cut into pieces at . , ; : ! ? and line ends, and these
    into words at spaces and tabs. n counts all words of a language, f(phrase) all places of a
    phrase within pieces. A phrase of 2 to 5 words and a = f(phrase) of 100 or more is cut into
    two parts of counts l and r; its score is the least floor(1000 * a * n / (l * r)), at the
    first such cut. A phrase goes if a longer one that holds it has its whole count. Phrases are
    ranked by score, count and their bytes. All numbers are exact; counts may have 16 digits.

    Rows without a text count as empty, and rows without a language belong to `und`. Repeated rows
    all count. An empty table, or one without a frequent phrase, gives no rows. Extra columns,
    whatever their names, are ignored.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    found = frequent_phrases(docs, text, lang, scratch, settings)
    totals = found.filter("size = 0").select("lang", F.col("a").alias("n"))
    counts = found.filter("size > 0").select("lang", "size", _phrase().alias("phrase"), "a")

    # What is left of a phrase by its extensions: entries of its stripe, and words before it.
    longer = found.filter("size > 2").withColumn("phrase", _phrase())
    behind = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    extended = longer.select("lang", F.explode(F.array("prefix", behind)).alias("phrase"), "a")
    extended = extended.groupBy("lang", "phrase").agg(F.max("a").alias("most"))

    words = F.split("phrase", " ")
    cuts = counts.filter("size > 1").join(totals, "lang").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "n", "cut", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("right"),
    )
    one = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    two = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    parts = cuts.join(one, ["lang", "left"]).join(two, ["lang", "right"])
    whole = {c: F.col(c).cast("decimal(16,0)") for c in "anlr"}
    product = parts.withColumns({
        "_up": F.lit(1000).cast("decimal(4,0)") * whole["a"] * whole["n"], "_down": whole["l"] * whole["r"],
    })
    scored = product.withColumn("score", F.expr("_up div _down"))
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("best")
    )
    kept = best.join(extended, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("most") < settings.replaced * F.col("best.a"), F.lit(True))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    flat = kept.select("lang", "phrase", "best.*")
    ranked = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= settings.top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut"
    )
