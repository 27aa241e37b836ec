"""Document quality by regularised quadratic discriminant analysis.

Each text is turned into a few statistics, which are transformed so that they spread evenly
(logarithms of sizes, log odds of shares). For each class the mean and covariance come from
sums worked out where the rows are; only these sums reach the driver. A covariance is drawn
towards the mean of both classes and towards a multiple of the unit matrix. A score is the
posterior probability of class 1 from the difference of the log densities.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm import words as W
from basketry.llm.ship import ship

FEATURES = (
    "log_words", "word_size", "letters", "capitals", "marks", "no_letter", "odd_end",
    "distinct", "repeats", "commonest",
)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in b"#$%&*|!@^~_=+<>{}[]\\/`"]] = True
_PLAIN_END = _LETTER.copy()
_PLAIN_END[[b for b in b".,;:?)'\"0123456789"]] = True


def log_odds(part: np.ndarray, whole: np.ndarray, usual: float) -> np.ndarray:
    """Of a share, drawn to the usual share as if five more had been seen; so a short text is
    not far off for its shortness alone."""
    return np.log((part + 5 * usual) / (whole - part + 5 * (1 - usual)))


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; an empty text has no words and the usual shares."""
    w = W.split_words(texts)
    n = np.diff(w.start)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at -= at[0]

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])

    def per_words(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[w.start])

    letter = _LETTER[raw]
    letters, capitals, marks = per_text(letter), per_text(_CAPITAL[raw]), per_text(_MARK[raw])
    begin = w.begin + np.repeat(at[:-1], n)
    before = np.concatenate([[0], np.cumsum(letter)])
    bare = before[begin + w.size] == before[begin]
    odd = ~_PLAIN_END[raw[begin + w.size - 1]] if begin.size else np.zeros(0, bool)
    repeat = np.zeros(w.hash.size, bool)
    repeat[1:] = w.hash[1:] == w.hash[:-1]
    repeat[w.start[:-1][n > 0]] = False
    distinct, most = np.zeros(n.size), np.zeros(n.size)
    for i in np.flatnonzero(n):
        own = np.sort(w.hash[w.start[i] : w.start[i + 1]])
        edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        distinct[i], most[i] = edge.size - 1, np.diff(edge).max()
    size = per_words(w.size)
    return np.stack(
        [
            np.log1p(n), np.log1p(size / np.maximum(n, 1)), log_odds(letters, size, 0.97),
            log_odds(capitals, letters, 0.02), log_odds(marks, size, 0.005),
            log_odds(per_words(bare), n, 0.01), log_odds(per_words(odd), n, 0.01),
            log_odds(distinct, n, 0.8), log_odds(per_words(repeat), n, 0.01),
            log_odds(np.maximum(most - 1, 0), n, 0.05),
        ],
        axis=1,
    )


def _rows(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    for first, part in W.chunks(texts.fill_null("")):
        yield first, len(part), statistics(part)


def features(docs: DataFrame, text: str = "text", column: str = "features") -> DataFrame:
    """The frame with its text replaced by the statistics, array<double>."""
    ship(docs.sparkSession)
    base = docs.drop(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if c != text]
            for first, n, values in _rows(batch.column(text)):
                rows = batch.slice(first, n)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], lists], [*names, column])

    kept = base.drop(text)
    return base.mapInArrow(run, kept.withColumn(column, F.lit(None).cast("array<double>")).schema)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors of the covariances and log prior odds of two classes."""

    means: np.ndarray
    factors: np.ndarray
    offset: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1; the log odds are divided by the number of statistics, since
        these overlap, which changes neither the order nor the side of 0.5."""
        odds = np.full(len(x), self.offset)
        for sign, mean, factor in zip((-1, 1), self.means, self.factors):
            odds -= sign * 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds / x.shape[1], -500, 500)))


def fit(labelled: DataFrame, column: str = "features", label: str = "label", shrink: float = 0.1) -> Discriminant:
    """Fit to rows with statistics and a label of 0 or 1; others are left out. `shrink` is the
    share of the common covariance and, again, of the unit matrix. Without rows of both
    classes the score of every text is the smoothed share of class 1."""
    d = len(FEATURES)
    item = [F.col(column)[i] for i in range(d)]
    sums: list[Column] = [F.sum(c).alias(f"s{i}") for i, c in enumerate(item)]
    sums += [F.sum(item[i] * item[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = {
        r["_label"]: r
        for r in labelled.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("_label"))
        .agg(F.count(F.lit(1)).alias("n"), *sums).collect()  # two rows at most
    }
    count = np.array([found[c]["n"] if c in found else 0 for c in (0, 1)], float)
    prior = np.log((count[1] + 1) / (count[0] + 1))
    if not count.all():
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), prior * d)
    means = np.array([[found[c][f"s{i}"] for i in range(d)] for c in (0, 1)]) / count[:, None]
    moments = np.zeros((2, d, d))
    for c in (0, 1):
        for i in range(d):
            for j in range(i + 1):
                moments[c, i, j] = moments[c, j, i] = found[c][f"p{i}_{j}"]
    own = moments / count[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (own * count[:, None, None]).sum(axis=0) / count.sum()
    factors, offset = [], prior
    for c, sign in ((0, -1), (1, 1)):
        cov = (1 - shrink) * own[c] + shrink * pooled
        cov = (1 - shrink) * cov + shrink * np.eye(d) * max(np.trace(cov) / d, 1e-6)
        root = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(root))
        offset -= sign * np.log(np.diag(root)).sum()
    return Discriminant(means, np.array(factors), offset)


def score_features(rows: DataFrame, model: Discriminant, column: str = "features", score: str = "score") -> DataFrame:
    """The frame with its statistics replaced by the score."""
    ship(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if c != column]
            x = np.asarray(batch.column(column).flatten()).reshape(-1, len(FEATURES))
            scores = pa.array(model.scores(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], scores], [*names, score])

    base = rows.drop(score)
    return base.mapInArrow(run, base.drop(column).withColumn(score, F.lit(0.0)).schema)


def keep_good(docs: DataFrame, model: Discriminant, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text scores at least `least`, with all their columns, in one pass without
    a shuffle. A null text is scored as an empty one."""
    ship(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, values in _rows(batch.column(text)):
                yield batch.slice(first, n).filter(pa.array(model.scores(values) >= least))

    return docs.mapInArrow(run, docs.schema)


def training_labels(labels: DataFrame, id_column: str = "doc_id", label: str = "quality") -> DataFrame:
    """One label, 0 or 1, for each id outside the held-out third; of differing labels the smaller."""
    ids = F.col(id_column).cast("long")
    rows = labels.filter(F.col(label).isin(0, 1) & ~held_out(ids)).select(ids.alias("id"), F.col(label).alias("label"))
    return rows.groupBy("id").agg(F.min("label").alias("label"))


def held_out(ids: Column) -> Column:
    """Ids never learnt from; a null id is never learnt from but not held out either."""
    return F.coalesce(F.crc32(ids.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(stored: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on all labelled rows of a table of ids and features."""
    return fit(stored.join(training_labels(labels), "id"))
