"""Keyed tables on plain files, fed by micro-batches.

A metric query sends a window again each time it changes. Each micro-batch is written to its own
folder, parted by the day of its windows, and counts once its commit line is there; a batch that
is half written is not seen by anyone, and one that is repeated is not written again. The row of
the latest batch is the value of a key.

Batches are folded into days: the days that the batches since the last fold have touched are
merged with what the table holds of them and written anew, sorted by key; all other days stay as
they are. A manifest then names the folder of each day. What a fold has replaced is removed when a
grace time has passed, so a reader that took the state before may finish. So a table has one
folder per day, and the batches since the last fold.

    log/upsert_run=R/upsert_batch=B/window_day=D    rows of a batch
    _commits/R-B.json                               its commit line
    days/window_day=D/fold=N                        rows of a day
    _folds/N.json                                   a manifest
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from basketry.operators.ranking import latest_per_key
from basketry.sources.files import delete_folder, folder_names, read_small_files, write_small_file
from basketry.streaming.runs import Run, open_run

ORDER = ("upsert_run", "upsert_batch")
DAY = "window_day"
#: The day of tables that have no windows.
NO_DAY = "all"


@dataclass(frozen=True, order=True)
class Commit:
    """A batch that is there as a whole: the days of its windows and the newest window."""

    run: int
    batch: int
    days: tuple[str, ...] = field(default=(), compare=False)
    newest: str | None = field(default=None, compare=False)


@dataclass(frozen=True)
class State:
    """What a table holds at one moment: the fold of each day, up to which batch folds go, and the
    batches after it. It stays readable for the grace time of folds."""

    fold: int = 0
    upto: tuple[int, int] = (0, -1)
    days: Mapping[str, int] = field(default_factory=dict)
    commits: tuple[Commit, ...] = ()
    newest: str | None = None


def state_of(spark: SparkSession, table: str) -> State:
    """The table as committed now. Two listings and some small files are read, no rows."""
    root = table.rstrip("/")
    # Commits first: a fold in between then finds them in its manifest, and not the other way round.
    lines = [json.loads(t) for t in read_small_files(spark, f"{root}/_commits").values()]
    folds = [json.loads(t) for t in read_small_files(spark, f"{root}/_folds").values()]
    last = max(folds, key=lambda f: f["fold"], default={"fold": 0, "upto": [0, -1], "days": {}, "newest": None})
    upto = tuple(last["upto"])
    commits = sorted(Commit(c["run"], c["batch"], tuple(c["days"]), c["newest"]) for c in lines)
    after = tuple(c for c in commits if (c.run, c.batch) > upto)
    newest = max(filter(None, [last["newest"], *[c.newest for c in after]]), default=None)
    return State(last["fold"], upto, last["days"], after, newest)


def write_batch(rows: DataFrame, batch_id: int, table: str, run: Run) -> None:
    """One micro-batch and its commit line. The rows are computed once; a batch that is already
    committed stays as it is."""
    spark, root = rows.sparkSession, table.rstrip("/")
    now = state_of(spark, table)
    if (run.number, batch_id) <= now.upto or Commit(run.number, batch_id) in now.commits:
        return
    seen, watched = Observation(), rows
    day = F.lit(NO_DAY)
    if "window_start" in rows.columns:
        day = F.coalesce(F.date_format("window_start", "yyyy-MM-dd"), F.lit(NO_DAY))
        watched = rows.observe(seen, F.date_format(F.max("window_start"), "yyyy-MM-dd HH:mm:ss").alias("newest"))
    folder = f"{root}/log/upsert_run={run.number}/upsert_batch={batch_id}"
    watched.withColumn(DAY, day).write.mode("overwrite").partitionBy(DAY).parquet(folder)
    days = [name.removeprefix(f"{DAY}=") for name in folder_names(spark, folder) if name.startswith(f"{DAY}=")]
    newest = seen.get["newest"] if "window_start" in rows.columns else None
    line = {"run": run.number, "batch": batch_id, "days": sorted(days), "newest": newest}
    write_small_file(spark, f"{root}/_commits/{run.number}-{batch_id}.json", json.dumps(line))


def upsert_stream(
    metric: DataFrame,
    table: str,
    checkpoint: str,
    trigger: str | None = None,
    mode: str = "update",
    name: str | None = None,
    also: Callable[[DataFrame, int], None] | None = None,
    keys: Sequence[str] = (),
    fold_every: int | None = None,
    grace_seconds: int = 600,
) -> StreamingQuery:
    """Start a metric query into a keyed table.

    `also` gets each batch too (to publish it elsewhere); the batch is then kept in memory or
    on disk between the two uses. With `keys`, the table is folded after every `fold_every`
    batches.
    """
    run = open_run(metric.sparkSession, table, checkpoint)
    schema = metric.schema

    def sink(rows: DataFrame, batch_id: int) -> None:
        if also is None:
            write_batch(rows, batch_id, table, run)
        else:
            rows.persist()
            try:
                write_batch(rows, batch_id, table, run)
                also(rows, batch_id)
            finally:
                rows.unpersist()
        if keys and fold_every and batch_id % fold_every == fold_every - 1:
            fold(rows.sparkSession, table, schema, keys, grace_seconds=grace_seconds)

    writer = metric.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def read_table(
    spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], state: State | None = None,
    first_day: dt.date | None = None,
) -> DataFrame:
    """The rows of a state, by default the one committed now; with `first_day`, only windows from
    that day on, and no other folders are listed."""
    state = state_of(spark, table) if state is None else state
    rows = _rows(spark, table, schema, state, lambda day: first_day is None or day >= str(first_day))
    return latest_per_key(rows, keys, ORDER).select(*schema.fieldNames())


def fold(
    spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], run: int | None = None,
    batch: int | None = None, grace_seconds: int = 600,
) -> None:
    """Fold the committed batches, by default all of them, into the days that they touch."""
    root, state = table.rstrip("/"), state_of(spark, table)
    upto = (run, batch) if run is not None and batch is not None else (1 << 31, 0)
    taken = tuple(c for c in state.commits if (c.run, c.batch) <= upto)
    if not taken:
        return
    touched = {day for c in taken for day in c.days}
    number = state.fold + 1
    part = State(state.fold, state.upto, state.days, taken)
    rows = latest_per_key(_rows(spark, table, schema, part, touched.__contains__), keys, ORDER)
    rows = rows.select(*schema.fieldNames(), DAY, F.lit(number).alias("fold")).hint("rebalance", DAY)
    rows.sortWithinPartitions(DAY, *keys).write.mode("overwrite").partitionBy(DAY, "fold").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(f"{root}/days")
    replaced = [_day_folder(day, n) for day, n in state.days.items() if day in touched]
    replaced += [_batch_folder(c) for c in taken] + [f"_commits/{c.run}-{c.batch}.json" for c in taken]
    newest = max(filter(None, [state.newest, *[c.newest for c in taken]]), default=None)
    days = {**state.days, **{day: number for day in touched}}
    manifest = {
        "fold": number, "upto": [taken[-1].run, taken[-1].batch], "days": days, "newest": newest,
        "at": time.time(), "replaced": replaced,
    }
    write_small_file(spark, f"{root}/_folds/{number}.json", json.dumps(manifest))
    sweep(spark, table, grace_seconds)


def sweep(spark: SparkSession, table: str, grace_seconds: int = 600) -> None:
    """Remove what folds older than the grace time have replaced."""
    root = table.rstrip("/")
    folds = sorted((json.loads(t) for t in read_small_files(spark, f"{root}/_folds").values()), key=lambda f: f["fold"])
    latest = time.time() - grace_seconds
    for manifest in [f for f in folds if f["at"] <= latest]:
        for place in manifest["replaced"]:
            delete_folder(spark, f"{root}/{place}")
        if manifest is not folds[-1]:
            delete_folder(spark, f"{root}/_folds/{manifest['fold']}.json")


def common_window(states: Mapping[str, State]) -> dt.datetime | None:
    """The newest window that all of these tables have reached."""
    newest = [s.newest for s in states.values()]
    return None if None in newest or not newest else dt.datetime.fromisoformat(min(newest))


def _batch_folder(c: Commit) -> str:
    return f"log/upsert_run={c.run}/upsert_batch={c.batch}"


def _day_folder(day: str, fold: int) -> str:
    return f"days/{DAY}={day}/fold={fold}"


def _rows(
    spark: SparkSession, table: str, schema: StructType, state: State, wanted: Callable[[str], bool]
) -> DataFrame:
    """All rows of the wanted days that may be current, with run, batch and day. Folded rows are
    older than those of any batch after the fold."""
    root = table.rstrip("/")
    places = StructType([*schema.fields, StructField(DAY, StringType())])
    numbered = [StructField(ORDER[0], IntegerType()), StructField(ORDER[1], LongType())]
    columns = [*schema.fieldNames(), *ORDER, DAY]
    out = spark.createDataFrame([], StructType([*places.fields, *numbered])).select(*columns)
    days = [_day_folder(day, n) for day, n in sorted(state.days.items()) if wanted(day)]
    if days:
        read = spark.read.schema(places).option("basePath", f"{root}/days")
        folded = read.parquet(*[f"{root}/{d}" for d in days])
        folded = folded.withColumns({ORDER[0]: F.lit(0), ORDER[1]: F.lit(-1).cast("bigint")})
        out = out.unionByName(folded.select(*columns))
    batches = [f"{root}/{_batch_folder(c)}/{DAY}={day}" for c in state.commits for day in c.days if wanted(day)]
    if batches:
        read = spark.read.schema(StructType([*places.fields, *numbered])).option("basePath", f"{root}/log")
        out = out.unionByName(read.parquet(*batches).select(*columns))
    return out
