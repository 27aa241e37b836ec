"""Tables of a fixed number of counters, counted in tasks and added up in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm import words as W

BLOCK = 1 << 15
PARTS = 16  # in which a table comes to the driver, one after the other
KIND = "block long, counts binary"


def block_rows(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blocks of a table of bytes that hold a count."""
    for block in range(-(-counts.size // BLOCK)):
        own = counts[block * BLOCK : (block + 1) * BLOCK]
        if own.any():
            yield block, own.tobytes()


def _added(reduce: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The blocks of a task together are never more than the table.
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                own = np.frombuffer(counts.as_py(), np.uint8).astype(np.int64)
                total[block] = own + total[block] if block in total else own
        for block, counts in total.items():
            columns = [pa.array([block], pa.int64()), pa.array([reduce(counts).tobytes()], pa.binary()), pa.array([int(counts.sum())], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "counts", "total"])

    return run


def totals(blocks: DataFrame, size: int, reduce: Callable[[np.ndarray], np.ndarray]) -> tuple[bytearray, int]:
    """Of the sums of all tasks' tables of `size` counters, what `reduce` makes of each, a byte; and
    the sum of all. Nothing else reaches the driver, some blocks at a time: the number of parts is
    given, as Spark would put those of a small table into one."""
    out, total = bytearray(size), 0
    added = blocks.repartition(PARTS, "block").mapInArrow(_added(reduce), f"{KIND}, total long")
    for row in added.toLocalIterator():
        out[row.block * BLOCK : row.block * BLOCK + len(row.counts)] = row.counts
        total += row.total
    return out, total


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (W.mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _marked(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << bits, bool)
        for batch in batches:
            marks[_places(np.asarray(batch.column(0)), bits)] = True
        for block, packed in block_rows(np.packbits(marks, bitorder="little")):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([packed], pa.binary())], ["block", "counts"])

    return run


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, marks in zip(batch.column("block").to_pylist(), batch.column("counts")):
            own = np.frombuffer(marks.as_py(), np.uint8)
            total[block] = own | total[block] if block in total else own
    for block, marks in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([marks.tobytes()], pa.binary())], ["block", "counts"])


def _likely(marks, column: str, bits: int, then: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None):
    def likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(marks.value, np.uint8)
        for batch in batches:
            ids = batch.column(column)
            place = _places(np.asarray(ids.fill_null(0)), bits)
            found = (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            if found.any():
                yield batch.filter(pa.array(found))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return likely(batches) if then is None else then(likely(batches))

    return run


def rows_of(
    rows: DataFrame, ids: DataFrame, column: str = "id", bits: int = 24,
    then: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, schema: str | None = None,
) -> DataFrame:
    """The rows whose whole number in `column` is in the table `ids`, which names each once.

    `then` makes batches of `schema` of the rows in the same pass, so that a task needs one Python
    worker; these are joined by all columns that they share with `ids`.

    Rows that are surely not wanted are left out before the shuffle, by a bitmap of fixed size; the
    others are told by a join, so the result is that of the join alone.
    """
    blocks = ids.select(column).mapInArrow(_marked(bits), KIND).repartition("block").mapInArrow(_united, KIND)
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in blocks.toLocalIterator():
        own = np.frombuffer(row.counts, np.uint8)
        out[row.block * BLOCK : row.block * BLOCK + own.size] = own
    marks = rows.sparkSession.sparkContext.broadcast(out.tobytes())
    likely = rows.mapInArrow(_likely(marks, column, bits, then), schema or rows.schema)
    return likely.join(ids, column if then is None else [c for c in ids.columns if c in likely.columns])
