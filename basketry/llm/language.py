"""Language of web pages by Bayesian evidence fusion.

The likelihood of a page's text under each language comes from counts of letter triples in
labelled documents, all of them, summed up in tables of fixed size. It is combined with the
language that the markup declares, by how often each declaration goes with each language, and
with the prior of the page's host, which is drawn to that of its address suffix and this one to
that of all pages. These tables come from grouped sums over all pages, where a page counts for a
language that its text alone makes nearly sure.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm import words as W
from basketry.llm.extract import main_text
from basketry.llm.scratch import Scratch
from basketry.llm.urls import host_of

_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)


@dataclass(frozen=True)
class LanguageSettings:
    """Table size, most languages, weight of the text's log-likelihood (its triples overlap),
    share of certainty from which a text counts for its language, weight of the wider prior."""

    buckets: int = 8192
    languages: int = 500
    temper: float = 0.2
    sure: float = 0.9
    prior: float = 5.0


def triples(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every run of three bytes, A to Z as a to z, white space as one kind; the first
    of each text and the end of the last."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at -= at[0]
    low = W._LOWER[raw].astype(np.uint32)
    low[W._SPACE[raw]] = 32
    if low.size < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    code = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    code = (code * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(buckets)
    count = np.maximum(np.diff(at) - 2, 0)
    return code.astype(np.int64)[W.spread(at[:-1], count)], np.concatenate([[0], np.cumsum(count)])


def _count(settings: LanguageSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, part in W.chunks(batch.column("text")):
                code, start = triples(part, settings.buckets)
                own = langs[first : first + len(part)]
                for lang in set(own):
                    rows = np.array([x == lang for x in own])
                    keep = np.repeat(rows, np.diff(start))
                    counts = np.bincount(code[keep], minlength=settings.buckets)
                    total[lang] = total.get(lang, 0) + counts
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * used.size, pa.string()), pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())],
                ["lang", "bucket", "n"],
            )

    return run


@dataclass(frozen=True)
class Profiles:
    """Log probability of each bucket in each language; a fixed size."""

    languages: list[str]
    log_p: np.ndarray


def fit(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> Profiles:
    """Count all documents with a text and a language (columns text and lang)."""
    Scratch(docs.sparkSession, "language")
    rows = docs.select("lang", "text").filter("lang is not null and text is not null")
    several = rows.agg(F.count_distinct("lang")).first()[0]
    if several > settings.languages:
        raise ValueError(f"{several} languages; the table is made for {settings.languages}")
    counts = rows.mapInArrow(_count(settings), "lang string, bucket long, n long")
    # At most languages x buckets rows.
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    names = sorted(set(found["lang"]))
    table = np.full((len(names), settings.buckets), 0.5)
    place = {name: i for i, name in enumerate(names)}
    table[[place[x] for x in found["lang"]], found["bucket"]] += found["n"]
    return Profiles(names, np.log(table / table.sum(axis=1, keepdims=True)) if names else table)


def _likelihoods(shared, html: str, settings: LanguageSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles: Profiles = shared.value
        for batch in batches:
            names = [c for c in batch.schema.names if c != html]
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                pages = [h or "" for h in rows.column(html).to_pylist()]
                declared = [m[1].lower() if (m := _DECLARED.search(p)) else None for p in pages]
                texts = pa.array([main_text(p) for p in pages], pa.string())
                out = np.zeros((len(pages), len(profiles.languages)))
                for first, part in W.chunks(texts):
                    code, start = triples(part, settings.buckets)
                    for k, log_p in enumerate(profiles.log_p):
                        sums = np.concatenate([[0], np.cumsum(log_p[code])])
                        out[first : first + len(part), k] = np.diff(sums[start])
                out *= settings.temper
                lists = pa.array(list(out), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in names], pa.array(declared, pa.string()), lists],
                    [*names, "declared", "_log"],
                )

    return run


def _posterior(log: Column) -> Column:
    """The weights e^x, divided by their sum."""
    top = F.array_max(log)
    weights = F.transform(log, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _smoothed(counts: Column, wider: Column, weight: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, wider, lambda n, p: (n + weight * p) / (total + weight))


def identify(
    pages: DataFrame, profiles: Profiles, url: str = "url", html: str = "html",
    settings: LanguageSettings = LanguageSettings(),
) -> DataFrame:
    """The pages without their html, with declared, lang and confidence.

    The declared language is that of the html element, in lower case without its region, else
    null and no evidence. A null or empty page, or one without text, goes by the other evidence.
    Equal posteriors go to the language first in the alphabet. Without profiles lang is null and
    the confidence 0. Columns of the given names are replaced; all rows stay.
    """
    scratch = Scratch(pages.sparkSession, "language")
    size = len(profiles.languages)
    base = pages.drop("declared", "lang", "confidence")
    plain = base.drop(html)
    if not size:
        return _declared_only(base, plain, html)
    shared = pages.sparkSession.sparkContext.broadcast(profiles)  # languages x buckets numbers
    schema = plain.withColumn("declared", F.lit(None).cast("string")).withColumn("_log", F.lit(None).cast("array<double>")).schema
    rows = base.mapInArrow(_likelihoods(shared, html, settings), schema)
    rows = rows.withColumn("_host", host_of(F.col(url)))
    rows = scratch.keep(rows.withColumn("_suffix", F.element_at(F.split("_host", "[.]"), -1)))

    alone = _posterior(F.col("_log"))
    sure = rows.select("_host", "_suffix", "declared", alone.alias("p")).filter(F.array_max("p") >= settings.sure)
    sure = sure.withColumn("l", F.array_position("p", F.array_max("p")).cast("int"))
    per = F.array(*[F.count_if(F.col("l") == i + 1).cast("double") for i in range(size)])
    hosts = sure.groupBy("_host", "_suffix").agg(per.alias("n"))
    sums = F.array(*[F.sum(F.col("n")[i]) for i in range(size)])
    suffixes = hosts.groupBy("_suffix").agg(sums.alias("s"))
    totals = suffixes.agg(F.array(*[F.coalesce(F.sum(F.col("s")[i]), F.lit(0.0)) for i in range(size)])).first()[0]
    even = np.array(totals) + 1
    world = F.array(*[F.lit(float(x)) for x in even / even.sum()])
    suffixes = suffixes.select("_suffix", _smoothed(F.col("s"), world, settings.prior).alias("_wide"))
    hosts = hosts.join(suffixes, "_suffix").select("_host", _smoothed(F.col("n"), F.col("_wide"), settings.prior).alias("_prior"))
    said = sure.filter("declared is not null").groupBy("declared").agg(per.alias("n"))
    of_each = F.array(*[F.lit(float(x)) for x in even])
    # A declaration never seen with a language still has a small chance with it.
    said = said.select("declared", F.zip_with("n", of_each, lambda n, t: (n + 0.1) / (t + 1)).alias("_said"))

    # The priors have one row per host, suffix or declaration.
    out = rows.join(hosts, "_host", "left").join(suffixes, "_suffix", "left").join(said, "declared", "left")
    prior = F.coalesce("_prior", "_wide", world)
    told = F.coalesce("_said", F.array_repeat(F.lit(1.0), size))
    log = F.zip_with(F.zip_with("_log", prior, lambda a, b: a + F.log(b)), told, lambda a, b: a + F.log(b))
    out = out.withColumn("_p", _posterior(log))
    names = F.array(*[F.lit(x) for x in profiles.languages])
    best = F.array_max("_p")
    return out.select(
        *[F.col(f"`{c}`") for c in plain.columns], "declared",
        F.get(names, (F.array_position("_p", best) - 1).cast("int")).alias("lang"), best.alias("confidence"),
    )


def _declared_only(base: DataFrame, plain: DataFrame, html: str) -> DataFrame:
    declared = F.lower(F.regexp_extract(F.col(html), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", 1))
    return base.select(
        *[F.col(f"`{c}`") for c in plain.columns], F.nullif(declared, F.lit("")).alias("declared"),
        F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
    )
