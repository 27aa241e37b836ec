"""Whitening of embedding vectors.

Vectors are put on a grid of whole numbers, so that equal ones can be told and sums are exact.
The fit list holds each distinct grid vector once. Each task turns its centred rows into a
triangle, block after block, by QR; triangles are stacked and made one again, a few at a time,
until a single one is left. Its singular values and right vectors, from `singular`, are the
square roots of the covariance's eigenvalues (but for n) and the whitening directions. No matrix
of products is ever formed, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.scratch import Scratch
from basketry.llm.singular import right_vectors


@dataclass(frozen=True)
class WhitenSettings:
    """Grid steps per unit, what is added to a grid number, components, triangles made one at a
    time, rows in a block, and the share of the largest eigenvalue below which one counts as none."""

    scale: int = 64
    offset: int = 1_000_000
    components: int = 16
    fan: int = 16
    block: int = 4096
    flat: float = 1e-13


@dataclass(frozen=True)
class Whitening:
    """n vectors of the fit list, exact sums of their grid numbers without the offset, the
    eigenvalues found, the trace, and the directions as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    trace: float
    directions: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of equally long lists of whole numbers."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def on_grid(vectors: DataFrame, embedding: str, settings: WhitenSettings) -> tuple[DataFrame, int]:
    """Rows with a usable vector, with its grid numbers without the offset in `_y`, and the
    dimension. Vectors that are null, empty, or hold null or non-finite entries are left out; of
    several lengths the most frequent counts (of equally frequent ones the longest)."""
    x = F.col(embedding)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    usable = vectors.filter(x.isNotNull() & (F.size(x) > 0)).filter(~bad)
    common = usable.groupBy(F.size(x).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return usable.withColumn("_y", F.lit(None).cast("array<bigint>")), 0
    y = F.transform(x, lambda c: F.floor(c.cast("double") * settings.scale).cast("bigint"))
    return usable.filter(F.size(x) == common.d).withColumn("_y", y), common.d


def _triangles(mean: np.ndarray, settings: WhitenSettings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, mean.size))
        for batch in batches:
            for lo in range(0, batch.num_rows, settings.block):
                rows = _matrix(batch.column("y").slice(lo, settings.block)) - mean
                r = np.linalg.qr(np.vstack([r, rows]), mode="r")
        if r.size:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    return run


def _stacked(dimension: int):
    def run(table: pa.Table) -> pa.Table:
        r = np.zeros((0, dimension))
        for raw in table.column("r"):
            part = np.frombuffer(raw.as_py()).reshape(-1, dimension)
            r = np.linalg.qr(np.vstack([r, part]), mode="r")
        return pa.table({"r": pa.array([r.tobytes()], pa.binary())})

    return run


def fit(distinct: DataFrame, dimension: int, scratch: Scratch, settings: WhitenSettings = WhitenSettings()) -> Whitening | None:
    """The whitening of a stored table of distinct grid vectors, column y; None if it is empty.

    What reaches the driver is one row of sums and one triangle of the dimension."""
    y = F.col("y")
    totals = distinct.agg(F.count(F.lit(1)).alias("n"), *[F.sum(y[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimension)]).first()
    n = totals["n"] if dimension else 0
    if not n:
        return None
    sums = tuple(int(totals[f"s{i}"]) for i in range(dimension))
    mean = np.array([float(Fraction(s, n)) for s in sums])
    parts = scratch.keep(distinct.mapInArrow(_triangles(mean, settings), "r binary"))
    count = parts.count()
    while count > 1:
        groups = -(-count // settings.fan)
        dealt = parts.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(groups)))
        merged = scratch.keep(dealt.groupBy("g").applyInArrow(_stacked(dimension), "r binary"))
        scratch.drop(parts)
        parts, count = merged, merged.count() if groups > 1 else 1
    r = np.frombuffer(parts.first()["r"]).reshape(-1, dimension)
    scratch.drop(parts)
    square = np.zeros((dimension, dimension))
    square[: r.shape[0]] = r
    trace = float((square**2).sum()) / n
    values, directions = right_vectors(square, min(settings.components, dimension))
    values = values[: directions.shape[1]] / n
    solid = values > settings.flat * max(values[0], 0) if trace > 0 else np.zeros(values.size, bool)
    return Whitening(n, sums, values[solid], trace, directions[:, solid])


def _project(rows: np.ndarray, model: Whitening) -> np.ndarray:
    return (rows - model.mean) @ model.directions / np.sqrt(model.values)


def _moments(model: Whitening):
    """Sums of products of the whitened rows of a task, once over."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.values.size
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _project(_matrix(batch.column("y")), model)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        places = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.reshape(-1))], ["place", "value"])

    return run


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened fit list, less the identity."""
    k = model.values.size
    if k == 0:
        return 0.0
    sums = distinct.mapInArrow(_moments(model), "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros((k + 1) * k)
    for row in sums.collect():  # (components + 1) x components numbers
        total[row.place] = row.value
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def _whitened(model: Whitening, error: float, dimension: int, given: str):
    k = model.values.size
    explained = model.values / model.trace if model.trace else model.values

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows = _matrix(part.column("_y"))
                far = float(np.abs(rows - model.mean).max(initial=0.0)) * model.n
                if far * far * dimension < 2.0**61:
                    off = rows * model.n - sums.astype(np.int64)
                    deviation = (off * off).sum(axis=1)
                else:  # beyond 64 bits on the way; a result beyond them ends in an error
                    off = rows.astype(object) * model.n - sums
                    deviation = (off * off).sum(axis=1)
                columns = [
                    part.column(given).take(pa.array(np.repeat(np.arange(part.num_rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                    pa.array(np.full(part.num_rows * k, model.n, np.int64)),
                    pa.array(np.repeat(deviation, k).tolist(), pa.int64()),
                    pa.array(_project(rows, model).reshape(-1)),
                    pa.array(np.tile(explained, part.num_rows)),
                    pa.array(np.full(part.num_rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, NAMES)

    return run


NAMES = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
RESULT = "id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", embedding: str = "embedding", settings: WhitenSettings = WhitenSettings()
) -> DataFrame:
    """One row per usable vector and component: the id column, component, n, deviation, whitened,
    explained, identity_error.

    The grid number of an entry c is floor(scale * c) + offset. Components are unit eigenvectors
    of the covariance (divisor n) of the n distinct grid vectors, by falling eigenvalue, up to
    `components` of them; directions without variance, as in a table of one vector only, are none.
    deviation is the sum over the dimensions of (n * x - S)^2, exact, where S are the sums of the
    fit list; beyond 64 bits it is an error. Vectors that are null, empty, or hold null or
    non-finite entries, and such of another length than the most frequent, are left out. Repeated
    rows and null ids are kept as they are, and an empty table gives no rows. Extra columns, whatever
    their names, are ignored.
    """
    scratch = Scratch(vectors.sparkSession, "whiten")
    rows, dimension = on_grid(vectors.select(F.col(id_column).alias("id"), F.col(embedding).alias("v")), "v", settings)
    kind = rows.schema["id"].dataType.simpleString()
    distinct = scratch.keep(rows.select(F.col("_y").alias("y")).distinct())
    model = fit(distinct, dimension, scratch, settings)
    if model is None or not model.values.size:
        scratch.drop(distinct)
        return vectors.sparkSession.createDataFrame([], RESULT.format(kind)).withColumnRenamed("id", id_column)
    error = identity_error(distinct, model)
    scratch.drop(distinct)
    out = rows.select("id", "_y").mapInArrow(_whitened(model, error, dimension, "id"), RESULT.format(kind))
    return out.withColumnRenamed("id", id_column)
